"""Bucketed tables: no shuffle where rows lie together, no buckets where one would be too full."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F
from test_containment import plan_of

from gramledger.operators.rollup import weighted_rollup
from gramledger.session import settings
from gramledger.sources import snapshot


def saved(spark, tmp_path, df, buckets=4):
    name = f"t_{uuid.uuid4().hex}"
    return snapshot.save_bucketed(df, name, "k", buckets, str(tmp_path / name)), spark.table(name)


def test_rollup_and_join_without_exchange(spark, tmp_path):
    rows = spark.range(4000).select((F.col("id") % 97).cast("string").alias("k"), F.col("id").cast("double").alias("v"), F.lit(2.0).alias("w"))
    texts = spark.range(97).select(F.col("id").cast("string").alias("k"), F.lit("text").alias("t"))
    (even, left), (_, right) = saved(spark, tmp_path, rows), saved(spark, tmp_path, texts)
    with settings(spark, {"spark.sql.autoBroadcastJoinThreshold": -1}):
        plan = weighted_rollup(left, "k", "w", ["v"]).join(right, "k", "left")
        assert even and "Exchange" not in plan_of(plan)
        plain = weighted_rollup(rows, "k", "w", ["v"]).join(texts, "k", "left")
        assert "Exchange" in plan_of(plain)
        assert sorted(map(tuple, plan.collect())) == sorted(map(tuple, plain.collect()))


def test_hot_key_is_not_put_in_one_bucket(spark, tmp_path):
    hot = F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.col("id").cast("string")).alias("k")
    even, table = saved(spark, tmp_path, spark.range(3000).select(hot), buckets=32)
    assert not even and table.count() == 3000
    even, table = saved(spark, tmp_path, spark.range(0).select(F.col("id").cast("string").alias("k")))
    assert even and table.count() == 0
