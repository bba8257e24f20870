"""Tables behind the dashboard page."""

from __future__ import annotations

from collections.abc import Collection

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.functions import columns as C
from gramledger.operators.serving import board_filter, kpi_row, top_n, value_options

# Rows in the chart and rows with their text shown.
CHART_ROWS = 15
TEXT_ROWS = 10


def chart_rows(rows: DataFrame, n: int = CHART_ROWS) -> DataFrame:
    return top_n(rows, n).select(
        C.short_label(F.col("drug_desc")).alias("short_label"), "combined_risk_score"
    )


def text_rows(rows: DataFrame, n: int = TEXT_ROWS) -> DataFrame:
    shown = F.coalesce(F.col("ai_explanation"), F.lit(C.NO_EXPLANATION))
    return top_n(rows, n).select("drug_desc", "combined_risk_score", shown.alias("explanation"))


def board(
    snapshot: DataFrame,
    cost: Collection[str] | None = None,
    safety: Collection[str] | None = None,
) -> dict[str, DataFrame]:
    """All tables of the page; headline figures ignore the filters, everything else obeys them."""
    rows = board_filter(snapshot, {"cost_risk_tier": cost, "safety_risk_tier": safety})
    return {
        "kpis": kpi_row(snapshot),
        "cost_options": value_options(snapshot, "cost_risk_tier"),
        "safety_options": value_options(snapshot, "safety_risk_tier"),
        "chart": chart_rows(rows),
        "table": rows.select(
            "drug_desc",
            "payment_gap_pct",
            "dollar_impact",
            "total_recalls",
            "safety_risk_tier",
            "combined_risk_score",
        ),
        "texts": text_rows(rows),
    }
