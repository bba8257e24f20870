"""Histories merged from states of days: the tasks' shares are bounded, and the results stay."""

from __future__ import annotations

from pyspark.sql import functions as F
from test_containment import plan_of

from gramledger import session
from gramledger.operators.partials import history_partials, merge_histories
from gramledger.operators.rollup import history_summary
from gramledger.sources.published import publish_days, published_rows

SHUFFLE, ADVISORY = "spark.sql.shuffle.partitions", "spark.sql.adaptive.advisoryPartitionSizeInBytes"


def notices(spark):
    n = F.col("id")
    return spark.range(600).select(
        F.when(n % 7 != 0, F.concat(F.lit("name "), n % 5)).alias("generic_name_clean"),
        F.when(n % 11 != 0, (n % 13).cast("string")).alias("recalling_firm"),
        (n % 4).cast("int").alias("severity_rank"),
        F.expr("date_add(date'2024-01-01', cast(id % 50 as int))").alias("report_date"),
        F.when(n % 3 != 0, F.lit("Ongoing")).alias("status"),
        F.expr("date_add(date'2024-01-01', cast(id % 3 as int))").alias("ingest_date"),
    )


def test_parts_grow_with_the_rows_of_a_block_only(spark, monkeypatch):
    monkeypatch.setattr(session, "ROWS_OF_PART", 100)
    before = spark.conf.get(SHUFFLE), spark.conf.get(ADVISORY)
    with session.bounded_parts(spark, 100 * int(before[0])):
        assert int(spark.conf.get(SHUFFLE)) == int(before[0]) + 1
    with session.bounded_parts(spark, 0):
        assert spark.conf.get(SHUFFLE) == before[0]
    assert (spark.conf.get(SHUFFLE), spark.conf.get(ADVISORY)) == before


def test_merged_in_parts_equals_the_summary(spark, tmp_path):
    rows = notices(spark)
    states = history_partials(rows, by=["ingest_date"])
    merged = merge_histories(states, parts=7)
    assert plan_of(merged).count(", 7)") == 1
    wanted = sorted(map(repr, history_summary(rows).collect()))
    assert sorted(map(repr, merged.collect())) == sorted(map(repr, merge_histories(states).collect())) == wanted


def test_published_rows_count_what_is_read(spark, tmp_path):
    path = str(tmp_path / "t")
    assert published_rows(spark, path) == 0
    rows = notices(spark).select("report_date", "ingest_date")
    publish_days(rows, path)
    publish_days(rows.where("ingest_date = '2024-01-02'"), path)
    assert published_rows(spark, path) == 600 + 200
    publish_days(rows.limit(0), path, "2024-01-02")
    assert published_rows(spark, path) == 600
