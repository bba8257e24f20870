"""Uniqueness of whole-number keys over days, from a state per day.

A day's state is two bitmaps per block of 32,768 keys: the keys that occur, and those that occur twice or more. Days are
merged by what their bitmaps share, so a new or replaced day is read once and no row of any other day again. Keys are
counted exactly. The state is small for keys that are given out in sequence, a bit or two each; keys that are spread over
all numbers take a block each and are better checked by grouping.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def key_states(df: DataFrame, column: str, by: Sequence[str] = ()) -> DataFrame:
    """One row per block of keys, and per value of ``by``: bitmaps ``seen`` and ``twice``. Null keys are not compared."""
    key = F.col(column).cast("long")
    counted = df.where(key.isNotNull()).groupBy(*by, key.alias("_key")).agg(F.count(F.lit(1)).alias("_n"))
    placed = counted.select(
        *by, F.expr("bitmap_bucket_number(_key)").alias("block"), F.expr("bitmap_bit_position(_key)").alias("_bit"), "_n"
    )
    return placed.groupBy(*by, "block").agg(
        F.expr("bitmap_construct_agg(_bit)").alias("seen"),
        F.expr("bitmap_construct_agg(_bit) FILTER (WHERE _n > 1)").alias("twice"),
    )


def repeated_keys(states: DataFrame) -> DataFrame:
    """One row: ``distinct_keys`` and ``repeated_keys`` over all states together. A block is one task's work at a time."""

    def merge(block: pa.Table) -> pa.Table:
        seen = twice = np.uint8(0)
        for ours, double in zip(block.column("seen").to_pylist(), block.column("twice").to_pylist()):
            here = np.frombuffer(ours, np.uint8)
            twice = twice | np.frombuffer(double, np.uint8) | (seen & here)
            seen = seen | here
        counts = [[int(np.unpackbits(np.atleast_1d(bits)).sum())] for bits in (seen, twice)]
        return pa.table(counts, names=["keys", "repeated"])

    merged = states.select("block", "seen", "twice").groupBy("block").applyInArrow(merge, "keys long, repeated long")
    zero = F.lit(0).cast("long")
    return merged.agg(
        F.coalesce(F.sum("keys"), zero).alias("distinct_keys"), F.coalesce(F.sum("repeated"), zero).alias("repeated_keys")
    )
