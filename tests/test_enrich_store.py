"""Stored enrichment: no call twice, a bound per run, and runs that break off."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from gramledger.operators.enrich import enrich_stored, read_store

QUICK = {"pause": 0.0, "quota_wait": 0.0, "busy_wait": 0.0}


def rows(spark, n):
    frame = spark.range(n).select(F.col("id").alias("k"), F.concat(F.lit("p"), (F.col("id") % 6).cast("string")).alias("p"))
    return frame.unionAll(spark.createDataFrame([(99, None)], "k long, p string"))


def logged(path, fails=()):
    def generate(prompt):
        with open(path, "a") as log:
            log.write(prompt + "\n")
        if prompt in fails:
            raise RuntimeError("refused")
        return f" {prompt}! "

    return generate


def test_each_prompt_once_and_none_again(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    first = enrich_stored(rows(spark, 20), "p", logged(log, fails={"p4"}), store, **QUICK).collect()
    assert sorted(log.read_text().split()) == [f"p{i}" for i in range(6)]
    assert all(r["ai_explanation"] == (None if r["p"] in (None, "p4") else f"{r['p']}!") for r in first)
    assert {r["p"]: r["status"] for r in first} == {**{f"p{i}": "ok" for i in range(6)}, "p4": "failed", None: None}
    log.write_text("")
    again = enrich_stored(rows(spark, 20), "p", logged(log), store, **QUICK).collect()
    assert log.read_text().split() == ["p4"] and len(again) == 21
    log.write_text("")
    assert enrich_stored(rows(spark, 20), "p", logged(log), store, **QUICK).where("status = 'ok'").count() == 20
    assert log.read_text() == ""


def test_bound_per_run(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")
    for calls, pending in ((2, 4), (4, 2), (6, 0), (6, 0)):
        found = enrich_stored(rows(spark, 6), "p", logged(log), store, most_calls=2, **QUICK)
        assert found.where("status = 'pending'").count() == pending
        assert len(log.read_text().split()) == calls
    # failed prompts do not keep new ones waiting
    store = str(tmp_path / "other")
    for _ in range(4):
        found = enrich_stored(rows(spark, 6), "p", logged(log, fails={"p0", "p1"}), store, most_calls=2, **QUICK)
    assert found.where("status = 'ok'").count() == 4


def test_breaking_off_keeps_committed_batches(spark, tmp_path):
    log, store = tmp_path / "log", str(tmp_path / "store")

    call = logged(log)

    def dies(prompt):
        if log.exists() and len(log.read_text().split()) >= 4:
            raise SystemExit("machine lost")
        return call(prompt)

    with pytest.raises(Exception):  # noqa: B017
        enrich_stored(rows(spark, 6), "p", dies, store, batch=2, **QUICK)
    kept = read_store(spark, store).count()
    assert kept == 4
    log.write_text("")
    assert enrich_stored(rows(spark, 6), "p", logged(log), store, batch=2, **QUICK).where("status = 'ok'").count() == 6
    assert len(log.read_text().split()) == 2
