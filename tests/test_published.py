"""Published days: a failed write changes nothing, versions change together, and states of days merge to the whole."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import functions as F

from gramledger.operators.partials import history_partials, merge_histories, merge_rollups, rollup_partials
from gramledger.operators.rollup import history_summary, weighted_rollup
from gramledger.sources.published import drop_old_versions, publish_days, published, read_published

SCHEMA = "ingest_date date, k long, v string"


def frame(spark, rows):
    return spark.createDataFrame(rows, "d string, k long, v string").select(F.to_date("d").alias("ingest_date"), "k", "v")


@pytest.fixture
def table(spark, tmp_path):
    path, schema = str(tmp_path / "t"), spark.createDataFrame([], SCHEMA).schema

    def read(**which):
        return sorted((str(r["ingest_date"]), r["k"], r["v"]) for r in read_published(spark, path, schema, **which).collect())

    return path, read


def test_replaced_days_and_older_states(spark, table):
    path, read = table
    assert read() == []
    publish_days(frame(spark, [("2024-01-01", 1, "a"), ("2024-01-02", 2, "b"), ("2024-01-02", 3, "c")]), path)
    publish_days(frame(spark, [("2024-01-02", 4, "d"), ("2024-01-03", 5, "e")]), path)
    publish_days(frame(spark, []).drop("ingest_date"), path, day="2024-01-01")  # a delivery without rows
    assert read() == [("2024-01-02", 4, "d"), ("2024-01-03", 5, "e")]
    assert read(upto=2) == [("2024-01-01", 1, "a"), ("2024-01-02", 4, "d"), ("2024-01-03", 5, "e")]
    assert read(upto=1) == [("2024-01-01", 1, "a"), ("2024-01-02", 2, "b"), ("2024-01-02", 3, "c")]
    assert read(day="2024-01-03") == [("2024-01-03", 5, "e")] and read(day="2024-02-01") == []


def test_write_that_fails_half_way_changes_nothing(spark, table):
    path, read = table
    publish_days(frame(spark, [("2024-01-01", k, "old") for k in range(40)]), path)
    old = read()
    fails = F.when(F.col("k") == 33, F.raise_error(F.lit("lost"))).otherwise(F.lit("new"))
    broken = frame(spark, [("2024-01-01", k, "new") for k in range(40)]).repartition(8).withColumn("v", fails.cast("string"))
    with pytest.raises(Exception, match="lost"):
        publish_days(broken, path)
    assert read() == old
    publish_days(broken.where("k <> 33"), path)
    assert read() == [("2024-01-01", k, "new") for k in sorted(range(40)) if k != 33]


def test_only_versions_in_use_are_read_and_kept(spark, table):
    path, read = table
    for n in range(4):
        publish_days(frame(spark, [("2024-01-01", n, "x"), *([("2024-01-02", n, "x")] if n == 0 else [])]), path)
    scan = read_published(spark, path, frame(spark, []).schema)
    assert len(scan.inputFiles()) <= 3  # of version 1 and 4
    assert len(drop_old_versions(spark, path)) == 2 and drop_old_versions(spark, path) == []
    assert read() == [("2024-01-01", 3, "x"), ("2024-01-02", 0, "x")]
    assert published(spark, path).count() == 2


@pytest.mark.parametrize("null_weight", ["keep", "drop"])
def test_merged_days_equal_all_rows(spark, tmp_path, null_weight):
    rng = random.Random(1)
    rows = [
        (f"2024-01-0{rng.randrange(1, 4)}", rng.choice("abc"), rng.choice([None, 1.0, 2.5]), rng.choice([None, 0.0, 3.0]),
         rng.choice([None, "t", "u"]))
        for _ in range(300)
    ]
    df = spark.createDataFrame(rows, "d string, k string, v double, w double, text string")
    args, path = ("k", "w", ["v"], ["w"], ["text"], null_weight), str(tmp_path / "states")
    for n in (1, 2, 3, 2):
        day = df.where(F.col("d") == f"2024-01-0{n}")
        first_of_two = n == 2 and not published(spark, path).where("day = '2024-01-03'").count()
        publish_days(rollup_partials(day.limit(5) if first_of_two else day, *args), path, f"2024-01-0{n}")
    schema = rollup_partials(df, *args).schema
    merged = merge_rollups(read_published(spark, path, schema), *args)
    rounded = [F.round("v", 9).alias("v"), F.round("w", 9).alias("w"), "k", "text"]
    assert sorted(merged.select(*rounded).collect()) == sorted(weighted_rollup(df, *args).select(*rounded).collect())


def test_merged_histories_count_a_firm_once(spark):
    rng = random.Random(3)
    rows = [
        (n % 3, rng.choice(["x", "y", None]), rng.choice([1, 2, None]), f"2024-01-{n % 28 + 1:02d}",
         rng.choice(["Ongoing", "Ended", None]), rng.choice(["f", "g", None]))
        for n in range(200)
    ]
    df = spark.createDataFrame(
        rows, "part int, generic_name_clean string, severity_rank int, report_date string, status string, recalling_firm string"
    )
    merged = merge_histories(history_partials(df, by=["part"]))
    whole = history_summary(df)
    assert sorted(map(tuple, merged.select(whole.columns).collect()), key=str) == sorted(map(tuple, whole.collect()), key=str)
