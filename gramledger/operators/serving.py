"""What a dashboard reads: top rows, headline figures, filter lists, filtered rows."""

from __future__ import annotations

from collections.abc import Collection, Mapping

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def top_n(df: DataFrame, n: int, score: str = "combined_risk_score", key: str = "hcpcs_code") -> DataFrame:
    """Highest scores first; the key settles ties. Every task keeps ``n`` rows, no full sort."""
    return df.orderBy(F.col(score).desc_nulls_last(), F.col(key).asc()).limit(n)


def newest(df: DataFrame, date: str, key: str, n: int) -> DataFrame:
    """The ``n`` newest rows by a column of dates or timestamps.

    That many rows from every task would be too much for the one task that merges them. So rows are first
    counted per day, and only days that can still be among the newest are read for the sort. The task that
    adds the counts up sees one row per day, which is why other types are refused.
    """
    kind = df.schema[date].dataType
    if not isinstance(kind, T.DateType | T.TimestampType | T.TimestampNTZType):
        raise TypeError(f"{date} must be a date or a timestamp, not {kind.simpleString()}")
    day = F.col(date) if isinstance(kind, T.DateType) else F.date_trunc("day", date)
    per_day = df.groupBy(day.alias("_day")).agg(F.count(F.lit(1)).alias("_rows"))
    newer = Window.orderBy(F.col("_day").desc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    ahead = per_day.withColumn("_ahead", F.coalesce(F.sum("_rows").over(newer), F.lit(0)))
    oldest = ahead.where(F.col("_ahead") < n).agg(
        F.min("_day").alias("_day"), F.bool_or(F.col("_day").isNull()).alias("_undated")
    )
    reached = (F.col(date) >= oldest.select("_day").scalar()) | oldest.select("_undated").scalar()
    return df.where(reached).orderBy(F.col(date).desc_nulls_last(), F.col(key).asc()).limit(n)


def kpi_row(
    df: DataFrame,
    cost: str = "cost_risk_tier",
    high: str = "High",
    recalls: str = "total_recalls",
    impact: str = "dollar_impact",
) -> DataFrame:
    return df.agg(
        F.count(F.lit(1)).alias("items"),
        F.count_if(F.col(cost) == high).alias("high_cost_items"),
        F.count_if(F.col(recalls) > 0).alias("items_with_recalls"),
        F.sum(impact).alias("total_impact"),
    )


def value_options(df: DataFrame, column: str) -> DataFrame:
    """Distinct values of a column, sorted, missing ones left out."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def board_filter(df: DataFrame, chosen: Mapping[str, Collection[str] | None]) -> DataFrame:
    """Rows whose columns all hold a chosen value; ``None`` stands for every value present."""
    for column, values in chosen.items():
        c = F.col(column)
        df = df.where(c.isNotNull() if values is None else c.isin(*values))
    return df
