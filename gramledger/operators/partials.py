"""Rollups that are kept by day: what a day adds is stored, and days are merged without reading their rows again.

A partial state has the sums that a result is made of, not the result: of an average its numerator and denominator, of a
distinct count the pairs that were seen. So the merged result equals a rollup of all rows, also after a day was replaced:
only that day's state is made anew.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.operators.rollup import rollup_averages, rollup_sums


def rollup_partials(
    df: DataFrame,
    key: str,
    weight: str,
    averages: Sequence[str],
    totals: Sequence[str] = (),
    carry: Sequence[str] = (),
    null_weight: str = "keep",
    by: Sequence[str] = (),
) -> DataFrame:
    """What rows add to a :func:`~gramledger.operators.rollup.weighted_rollup`: one row per key and carried texts.

    ``by`` names further columns to group by, such as the day, so that one pass makes the states of many days.
    """
    sums = rollup_sums(weight, averages, totals, null_weight)
    return df.groupBy(*by, key, *carry).agg(*[c.alias(n) for n, c in sums.items()])


def merge_rollups(
    partials: DataFrame,
    key: str,
    weight: str,
    averages: Sequence[str],
    totals: Sequence[str] = (),
    carry: Sequence[str] = (),
    null_weight: str = "keep",
) -> DataFrame:
    """The rollup of all rows from the partial states of their days. The arguments are those of the states."""
    sums = rollup_sums(weight, averages, totals, null_weight)
    grouped = partials.groupBy(key, *carry).agg(*[F.sum(n).alias(n) for n in sums])
    if carry:  # texts are compared when numbers are few, as in the rollup itself
        grouped = grouped.groupBy(key).agg(*[F.max(c).alias(c) for c in carry], *[F.sum(n).alias(n) for n in sums])
    return rollup_averages(grouped, key, averages, totals, carry, null_weight)


def history_partials(
    df: DataFrame,
    name: str = "generic_name_clean",
    severity: str = "severity_rank",
    date: str = "report_date",
    status: str = "status",
    firm: str = "recalling_firm",
    ongoing: str = "Ongoing",
    by: Sequence[str] = (),
) -> DataFrame:
    """What rows add to a :func:`~gramledger.operators.rollup.history_summary`: one row per name and firm.

    ``by`` names further columns to group by, such as the day, so that one pass makes the states of many days.
    """
    return df.groupBy(*by, F.col(name).alias("name"), F.col(firm).alias("firm")).agg(
        F.count(F.lit(1)).alias("events"),
        F.min(severity).alias("worst"),
        F.max(date).alias("latest"),
        F.sum(F.when(F.col(status) == ongoing, 1).otherwise(0)).alias("ongoing"),
    )


def merge_histories(partials: DataFrame, name: str = "generic_name_clean", parts: int | None = None) -> DataFrame:
    """The summary of all rows from the partial states of their days.

    With ``parts``, pairs are brought together in so many tasks first, so that a task's groups do not grow with the states.
    """
    if parts is not None:
        partials = partials.repartition(parts, "name", "firm")
    added = [F.sum("events").alias("events"), F.min("worst").alias("worst"), F.max("latest").alias("latest")]
    pairs = partials.groupBy("name", "firm").agg(*added, F.sum("ongoing").alias("ongoing"))
    return pairs.groupBy(F.col("name").alias(name)).agg(
        F.sum("events").alias("total_recalls"),
        F.min("worst").alias("worst_severity_rank"),
        F.max("latest").alias("most_recent_recall_date"),
        F.sum("ongoing").alias("ongoing_recalls"),
        F.count("firm").alias("distinct_manufacturers"),
    )
