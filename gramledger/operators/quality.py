"""Data-quality checks as one small report."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

NOT_NULL, UNIQUE, ACCEPTED = "not_null", "unique", "accepted_values"


@dataclass(frozen=True)
class Check:
    table: str
    column: str
    kind: str
    values: tuple[str, ...] = ()


def _row_failures(check: Check) -> Column:
    c = F.col(check.column)
    if check.kind == NOT_NULL:
        return F.count_if(c.isNull())
    return F.count_if(~c.isin(*check.values))  # a null is neither in nor out, so it passes


def _report(counts: DataFrame, checks: Sequence[Check]) -> DataFrame:
    """One row of counts, ``_0`` for the first check and so on, to one row per check."""
    rows = [
        F.struct(
            F.lit(c.table).alias("table_name"),
            F.lit(c.column).alias("column_name"),
            F.lit(c.kind).alias("check_name"),
            F.col(f"_{i}").alias("failures"),
        )
        for i, c in enumerate(checks)
    ]
    return counts.select(F.inline(F.array(*rows)))


def run_checks(tables: Mapping[str, DataFrame], checks: Sequence[Check]) -> DataFrame:
    """One report row per check, with the number of failing rows (failing values for ``unique``).

    A table is read once: its row checks are counted per group of its first ``unique`` column, and the
    groups summed up. Only further ``unique`` columns need a grouping of their own. Nulls are not compared
    for uniqueness.
    """
    parts: list[DataFrame] = []
    for table, df in tables.items():
        mine = [c for c in checks if c.table == table]
        by_row = [c for c in mine if c.kind != UNIQUE]
        unique = [c for c in mine if c.kind == UNIQUE]
        row_counts = [_row_failures(c).alias(f"_{i}") for i, c in enumerate(by_row)]
        if by_row and not unique:
            parts.append(_report(df.agg(*row_counts), by_row))
        for position, check in enumerate(unique):
            with_rows = by_row if position == 0 else []
            group = df.groupBy(F.col(check.column).alias("_value"))
            groups = group.agg(F.count(F.lit(1)).alias("_n"), *row_counts[: len(with_rows)])
            sums = [F.coalesce(F.sum(f"_{i}"), F.lit(0)).alias(f"_{i}") for i in range(len(with_rows))]
            repeated = F.count_if(F.col("_value").isNotNull() & (F.col("_n") > 1))
            counts = groups.agg(*sums, repeated.alias(f"_{len(with_rows)}"))
            parts.append(_report(counts, [*with_rows, check]))
    report = reduce(DataFrame.unionByName, parts)
    return report.withColumn("passed", F.col("failures") == 0)
