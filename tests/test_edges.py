"""Rows that strategies used to treat differently, and deliveries that used to lose or keep too much."""

from __future__ import annotations

import gzip

import pytest
from pyspark.sql import functions as F

from gramledger.functions.columns import severity_rank, tier_by_limit
from gramledger.operators.containment import best_contained, contains_join
from gramledger.operators.enrich import enrich_rows
from gramledger.sources import bronze, pages


@pytest.mark.parametrize("strategy", ["scan", "grams", "shuffle"])
def test_null_key_and_characters_beyond_16_bits(spark, strategy):
    left = spark.createDataFrame([(None, "cold gear"), (1, "x \U0001f600ab y"), (2, None)], "k int, t string")
    right = spark.createDataFrame([("COLD",), ("?AB",), ("?",), ("\U0001f600A",)], "name string")
    wanted = {(None, "COLD"), (1, "\U0001f600A"), (2, None)}
    found = contains_join(left, right, "k", "t", "name", strategy=strategy).collect()
    assert {(r["k"], r["name"]) for r in found} == wanted and len(found) == 3
    best = best_contained(left, right, "k", "t", "name", [F.col("name")], strategy=strategy).collect()
    assert {(r["k"], r["name"]) for r in best} == wanted and len(best) == 3


def test_day_without_rows_replaces_the_old_one(spark, tmp_path):
    df = spark.createDataFrame([(1,), (2,)], "n int")
    for day in ("2024-01-01", "2024-01-02"):
        bronze.write_dated(df, f"{tmp_path}/t", day)
    done = bronze.write_dated(df.where("false"), f"{tmp_path}/t", "2024-01-01")
    back = spark.read.parquet(f"{tmp_path}/t")
    assert (done["rows"] or 0) == 0
    assert [str(r["ingest_date"]) for r in back.select("ingest_date").distinct().collect()] == ["2024-01-02"]


def test_pages_are_told_by_their_records(spark, tmp_path):
    for page, text in enumerate(['{"a":1}', "{}", '{"a":3}', "[    ]", '{"a":5}']):
        folder = tmp_path / "p" / f"page={page}"
        folder.mkdir(parents=True)
        with gzip.open(folder / "f.json.gz", "wt") as f:
            f.write(text + "\n")
    found = pages.read_pages(spark, str(tmp_path / "p"), spark.createDataFrame([], "a int").schema)
    assert [r["a"] for r in found.orderBy("page").collect()] == [1, None, 3]


def test_feed_without_a_page_limit_is_read_to_its_end(spark):
    def fetch(offset, size, filters):
        return [(i,) for i in range(offset, min(offset + size, 73))]

    schema = spark.createDataFrame([], "a int").schema
    spark.dataSource.register(pages.paged_feed("endless", schema, fetch))
    assert spark.read.format("endless").option("size", 10).load().count() == 73


def test_waits_are_the_callers(spark):
    calls = spark.createDataFrame([("a",), ("b",)], "p string")

    def generate(text):
        raise RuntimeError("429 RESOURCE_EXHAUSTED" if text == "a" else "bad")

    found = enrich_rows(calls, "p", generate, quota_wait=0.0, pause=0.0).collect()
    assert {(r["p"], r["attempts"]) for r in found} == {("a", 4), ("b", 1)}


def test_no_ranks_and_no_limits(spark):
    row = spark.range(1).select(
        severity_rank(F.lit("x"), {}, 4).alias("r"), tier_by_limit(F.lit(1.0), [], "Low").alias("t")
    )
    assert tuple(row.first()) == (4, "Low")
