"""Keys counted from bitmaps of days, against plain counting."""

from __future__ import annotations

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from gramledger.operators.uniqueness import key_states, repeated_keys


@pytest.mark.parametrize("seed", [1, 2])
def test_merged_days_equal_counting(spark, seed):
    rng = random.Random(seed)
    keys = [rng.choice([None, rng.randrange(-40, 90), rng.randrange(100_000), 2**40 + rng.randrange(5)]) for _ in range(3000)]
    df = spark.createDataFrame([(i % 5, k) for i, k in enumerate(keys)], "day int, k long").repartition(4)
    counts = Counter(k for k in keys if k is not None)
    found = repeated_keys(key_states(df, "k", ["day"])).collect()
    assert [tuple(r) for r in found] == [(len(counts), sum(n > 1 for n in counts.values()))]
    whole = repeated_keys(key_states(df, "k")).collect()
    assert whole == found


def test_no_keys(spark):
    df = spark.createDataFrame([(1, None)], "day int, k long")
    assert [tuple(r) for r in repeated_keys(key_states(df, "k", ["day"])).collect()] == [(0, 0)]


def test_one_key_over_and_over_is_one_row_per_task(spark):
    df = spark.range(0, 50_000, 1, 4).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"))
    expected = len({7 if i % 3 == 0 else i for i in range(50_000)})
    assert [tuple(r) for r in repeated_keys(key_states(df, "k")).collect()] == [(expected, 1)]
