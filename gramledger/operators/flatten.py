"""Nested feed records to flat tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.functions import columns as C


def flatten_fields(
    df: DataFrame,
    keep: Sequence[str],
    texts: Mapping[str, str],
    numbers: Mapping[str, str],
) -> DataFrame:
    """Dotted paths to flat columns: ``texts`` and ``numbers`` map an output name to its path."""
    return df.select(
        *keep,
        *[F.col(path).alias(out) for out, path in texts.items()],
        *[C.number(F.col(path)).alias(out) for out, path in numbers.items()],
    )


def add_gap_and_impact(
    df: DataFrame,
    submitted: str = "avg_submitted_charge",
    paid: str = "avg_medicare_paid",
    services: str = "total_services",
) -> DataFrame:
    return df.withColumns(
        {
            "payment_gap_pct": C.gap_pct(F.col(submitted), F.col(paid)),
            "dollar_impact": C.money_impact(F.col(services), F.col(submitted), F.col(paid)),
        }
    )


def explode_keep(df: DataFrame, array: str, out: str, keep: Sequence[str]) -> DataFrame:
    """One row per array element; a null or empty array still gives one row, with null."""
    return df.select(*keep, F.explode_outer(F.col(array)).alias(out))
