"""Staged tables, recall summary and the scored table."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.functions import columns as C
from gramledger.operators.best_match import longest_then_worst
from gramledger.operators.containment import best_contained, contains_join
from gramledger.operators.flatten import add_gap_and_impact
from gramledger.operators.quality import ACCEPTED, NOT_NULL, UNIQUE, Check
from gramledger.operators.rollup import history_summary, weighted_rollup

# The geography that is ranked, the measures, the ongoing status.
NATIONAL = "National"
ONGOING = "Ongoing"
AVERAGES = ("avg_submitted_charge", "avg_medicare_allowed", "avg_medicare_paid")
TOTALS = ("total_providers", "total_services")

MATCH = {"key": "hcpcs_code", "text": "drug_desc", "name": "generic_name_clean"}

CHECKS = (
    Check("staged_payments", "hcpcs_code", NOT_NULL),
    Check("staged_payments", "hcpcs_code", UNIQUE),
    Check("staged_payments", "payment_gap_pct", NOT_NULL),
    Check("staged_recalls", "recall_number", NOT_NULL),
    Check("staged_recalls", "classification", ACCEPTED, tuple(C.SEVERITY_RANKS)),
    Check("scored", "hcpcs_code", NOT_NULL),
    Check("scored", "hcpcs_code", UNIQUE),
    Check("scored", "cost_risk_tier", ACCEPTED, C.COST_TIERS),
    Check("scored", "safety_risk_tier", ACCEPTED, C.SAFETY_TIERS),
    Check("scored", "combined_risk_score", NOT_NULL),
)


def staged_payments(
    silver: DataFrame, descriptions: DataFrame | None = None, national: str = NATIONAL
) -> DataFrame:
    """One row per code, from the national rows; gap and impact follow from the combined amounts.

    ``descriptions`` (code, text) is for payments that carry no text of their own: the measures are
    rolled up first and the text joined to one row per code.
    """
    rows = silver.where(F.col("geography") == national)
    carry = ("drug_desc",) if descriptions is None else ()
    rolled = weighted_rollup(rows, "hcpcs_code", "total_services", AVERAGES, TOTALS, carry)
    if descriptions is not None:
        rolled = rolled.join(descriptions, "hcpcs_code", "left")
    geography = F.lit(national).alias("geography")
    return add_gap_and_impact(
        rolled.select("hcpcs_code", "drug_desc", geography, *TOTALS, *AVERAGES)
    )


def staged_recalls(
    silver: DataFrame, ranks: Mapping[str, int] = C.SEVERITY_RANKS
) -> DataFrame:
    named = silver.where(F.col("generic_name").isNotNull())
    return named.select(
        "recall_number",
        "classification",
        C.severity_rank(F.col("classification"), ranks).alias("severity_rank"),
        "status",
        "recalling_firm",
        "reason_for_recall",
        C.report_date(F.col("report_date")).alias("report_date"),
        "distribution_pattern",
        C.clean_name(F.col("generic_name")).alias("generic_name_clean"),
    )


def recall_summary(staged: DataFrame, ongoing: str = ONGOING) -> DataFrame:
    return history_summary(staged, ongoing=ongoing)


def matched_payments(payments: DataFrame, summary: DataFrame, strategy: str = "auto") -> DataFrame:
    """Codes with every name found in their description; the summary is aggregated before the join."""
    return _filled(contains_join(payments.drop("geography"), summary, **MATCH, strategy=strategy))


def scored_table(payments: DataFrame, summary: DataFrame, strategy: str = "auto") -> DataFrame:
    """One row per code with tiers and score. Unordered: sinks and reports sort for themselves."""
    order = longest_then_worst("generic_name_clean", "worst_severity_rank")
    best = best_contained(
        payments.drop("geography"), summary, **MATCH, order=order, strategy=strategy
    )
    gap, recalls = F.col("payment_gap_pct"), F.col("total_recalls")
    worst, ongoing = F.col("worst_severity_rank"), F.col("ongoing_recalls")
    return _filled(best).withColumns(
        {
            "cost_risk_tier": C.tier_by_limit(gap),
            "safety_risk_tier": C.safety_tier(recalls, worst),
            "combined_risk_score": C.risk_score(gap, recalls, worst, ongoing),
        }
    )


def _filled(matched: DataFrame) -> DataFrame:
    """Counts of a code without a match are zero."""
    zero = F.lit(0).cast("long")
    return matched.withColumns(
        {c: F.coalesce(F.col(c), zero) for c in ("total_recalls", "ongoing_recalls")}
    )
