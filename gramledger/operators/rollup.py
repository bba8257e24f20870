"""Aggregations: volume-weighted rollup and event-history summary."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def weighted_rollup(
    df: DataFrame,
    key: str,
    weight: str,
    averages: Sequence[str],
    totals: Sequence[str] = (),
    carry: Sequence[str] = (),
    null_weight: str = "keep",
) -> DataFrame:
    """One row per key: ``sum(v * w) / sum(w)`` per average, plain sums, and carried text.

    A text maximum forces Spark to sort the rows of the aggregate that holds it. So the many rows are
    first hash-aggregated by key and carried text together, numbers only, and the text maximum is taken
    over what is left of them, about one row per key. Both steps combine before they shuffle, so a key
    that owns a third of the rows reaches the exchange as one row per task.

    A null measure leaves the numerator but its weight stays in the denominator (``null_weight='keep'``);
    ``'drop'`` leaves that weight out as well.
    """
    sums = rollup_sums(weight, averages, totals, null_weight)
    grouped = df.groupBy(key, *carry).agg(*[c.alias(n) for n, c in sums.items()])
    if carry:
        grouped = grouped.groupBy(key).agg(
            *[F.max(c).alias(c) for c in carry], *[F.sum(n).alias(n) for n in sums]
        )
    return rollup_averages(grouped, key, averages, totals, carry, null_weight)


def _base(v: str, null_weight: str) -> str:
    return "_w" if null_weight == "keep" else f"_w_{v}"


def rollup_sums(
    weight: str, averages: Sequence[str], totals: Sequence[str], null_weight: str
) -> dict[str, Column]:
    """Name and expression of every sum that a rollup is made of."""
    if null_weight not in ("keep", "drop"):
        raise ValueError("null_weight is 'keep' or 'drop'")
    w = F.col(weight)
    sums: dict[str, Column] = {f"_s_{c}": F.sum(c) for c in totals}
    for v in averages:
        sums[f"_n_{v}"] = F.sum(F.col(v) * w)
        sums[_base(v, null_weight)] = F.sum(w if null_weight == "keep" else F.when(F.col(v).isNotNull(), w))
    return sums


def rollup_averages(
    sums: DataFrame, key: str, averages: Sequence[str], totals: Sequence[str], carry: Sequence[str], null_weight: str
) -> DataFrame:
    """The rollup from its sums, one row per key."""
    return sums.select(
        key,
        *carry,
        *[F.col(f"_s_{c}").alias(c) for c in totals],
        *[F.try_divide(F.col(f"_n_{v}"), F.col(_base(v, null_weight))).alias(v) for v in averages],
    )


def history_summary(
    df: DataFrame,
    name: str = "generic_name_clean",
    severity: str = "severity_rank",
    date: str = "report_date",
    status: str = "status",
    firm: str = "recalling_firm",
    ongoing: str = "Ongoing",
) -> DataFrame:
    """One row per name: count, worst rank, latest date, ongoing count, distinct firms.

    The distinct count makes Spark shuffle by (name, firm) first and by name afterwards; each step
    combines on the map side, so one very frequent name is spread over its firms.
    """
    return df.groupBy(name).agg(
        F.count(F.lit(1)).alias("total_recalls"),
        F.min(severity).alias("worst_severity_rank"),
        F.max(date).alias("most_recent_recall_date"),
        F.sum(F.when(F.col(status) == ongoing, 1).otherwise(0)).alias("ongoing_recalls"),
        F.count_distinct(F.col(firm)).alias("distinct_manufacturers"),
    )
