"""Landing with keys remembered for a period: bounded state, defined late repeats, no loss when a run breaks off."""

from __future__ import annotations

from datetime import date, timedelta

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from gramledger.streaming.incremental import drop_repeats, keys_held, land_recent_files

ROW = "k long, v string"


@pytest.fixture
def feed(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema = spark.createDataFrame([], ROW).schema

    def deliver(rows):
        spark.createDataFrame(rows, ROW).coalesce(1).write.mode("append").json(source)

    def run(day, days=4, flatten=lambda df: df):
        stamp = f"{day}T06:00:00"
        query = land_recent_files(
            spark, source, schema, flatten, ["k"], target, state, stamp, days, files_per_batch=2, partitions=3
        )
        query.awaitTermination()
        return query

    return deliver, run, target


def test_state_stays_bounded_and_nothing_is_lost(spark, feed):
    deliver, run, target = feed
    first, held, wanted = date(2024, 1, 1), [], set()
    for n in range(14):
        day = first + timedelta(days=n)
        deliver([(k, str(n)) for k in (*range(10 * n, 10 * n + 10), *range(max(0, 10 * n - 50), 10 * n))])  # repeats of five days
        held.append(keys_held(run(day)))
        period = (day - date(1970, 1, 1)).days // 4
        wanted |= {(k, period) for k in range(max(0, 10 * n - 50), 10 * n + 10)}
    period = F.floor(F.datediff("taken_at", F.lit("1970-01-01")) / 4)
    taken = spark.read.parquet(target)
    rows = [tuple(r) for r in taken.select("k", period).collect()]
    assert sorted(rows) == sorted(wanted)
    assert max(held) <= 180 and max(held[11:]) <= max(held[7:11])  # two periods of keys, however many runs
    newest = drop_repeats(taken, ["k"], newest_by="taken_at")
    assert newest.count() == newest.select("k").distinct().count() == 140


def test_run_that_breaks_off_is_taken_up_again(spark, feed):
    deliver, run, target = feed
    for part in range(4):
        deliver([(part * 10 + i, "x") for i in range(10)])
    broken = F.when(F.col("k") == 25, F.raise_error(F.lit("lost"))).otherwise(F.col("k"))
    with pytest.raises(StreamingQueryException):
        run("2024-01-01", flatten=lambda df: df.withColumn("k", broken.cast("long")))
    run("2024-01-01")
    run("2024-01-01")
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == list(range(40))


def test_time_does_not_go_back_and_null_keys_are_one_key(feed, spark):
    deliver, run, target = feed
    deliver([(None, "a"), (None, "b"), (1, None)])
    run("2024-01-02")
    with pytest.raises(ValueError, match="after one of"):
        run("2024-01-01")
    run("2024-01-02")
    assert spark.read.parquet(target).count() == 2


def test_keys_are_known_whether_they_are_counted_or_not(spark, tmp_path):
    source, target, state = (str(tmp_path / n) for n in ("in", "out", "state"))
    schema, before = spark.createDataFrame([], ROW).schema, spark.conf.getAll
    held = []
    for n, counted in enumerate((True, False, False, True)):
        spark.createDataFrame([(k, "x") for k in range(10 * n, 10 * n + 20)], ROW).write.mode("append").json(source)
        query = land_recent_files(
            spark, source, schema, lambda df: df, ["k"], target, state, "2024-01-01", 14, partitions=2, count_keys=counted
        )
        query.awaitTermination()
        held.append(keys_held(query))
    assert sorted(r["k"] for r in spark.read.parquet(target).collect()) == list(range(50))
    assert held[0] == 20
    assert spark.conf.getAll == before
