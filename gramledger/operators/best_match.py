"""Best match per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def longest_then_worst(name: str, severity: str) -> list[Column]:
    """Longest name first, then the lowest rank; the name itself makes ties stable."""
    return [
        F.length(name).desc_nulls_last(),
        F.col(severity).asc_nulls_last(),
        F.col(name).asc_nulls_last(),
    ]


def best_match(df: DataFrame, key: str | Sequence[str], order: Sequence[Column]) -> DataFrame:
    """First row per key in ``order``.

    Spark keeps one row per key and task ahead of the shuffle (WindowGroupLimit), so a key with very
    many matches never gathers them in one task.
    """
    keys = [key] if isinstance(key, str) else list(key)
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    return ranked.where("_rank = 1").drop("_rank")
