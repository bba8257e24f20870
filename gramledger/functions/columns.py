"""Column expressions: cleaning, ranks, tiers, score, labels and prompt text.

All of them are built-in Spark expressions, so they stay inside generated code.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Class ranks, tier limits and names, score weights, label length, fallback text.
SEVERITY_RANKS = {"Class I": 1, "Class II": 2, "Class III": 3}
OTHER_SEVERITY = 4
COST_LIMITS = ((75, "High"), (40, "Medium"))
LOWEST_COST_TIER = "Low"
SAFETY_BY_SEVERITY = {1: "High", 2: "Medium"}
OTHER_SAFETY_TIER = "Low"
NO_RECALL_TIER = "None"
COST_TIERS = ("High", "Medium", "Low")
SAFETY_TIERS = ("High", "Medium", "Low", "None")
POINTS_PER_SEVERITY_STEP = 20
POINTS_PER_ONGOING = 10
LABEL_LENGTH = 30
LABEL_MARK = "..."
NO_EXPLANATION = "No AI explanation generated for this drug yet."

PROMPT = (
    "Explain in two or three plain sentences why this item is a review priority. "
    "Rely on the figures listed here and on nothing else.\n"
    "Item: %s\n"
    "Gap between charge and payment: %s%%\n"
    "Money impact: $%s\n"
    "Cost tier: %s\n"
    "Safety tier: %s\n"
    "Recalls: %s, still ongoing: %s\n"
    "Score: %s"
)
MISSING_FIGURE = "n/a"


def number(c: Column) -> Column:
    """Text to double; text that is no number becomes null instead of failing the job."""
    return c.try_cast("double")


def gap_pct(submitted: Column, paid: Column) -> Column:
    """Share of the submitted amount left unpaid, in percent; null for a zero charge."""
    return F.try_divide(submitted - paid, submitted) * 100


def money_impact(services: Column, submitted: Column, paid: Column) -> Column:
    return services * (submitted - paid)


def clean_name(c: Column) -> Column:
    return F.upper(F.trim(c))


def report_date(c: Column) -> Column:
    """Eight-digit date text, or ISO text, to a date; anything else to null."""
    return F.coalesce(F.try_to_date(c, "yyyyMMdd"), F.try_to_date(c, "yyyy-MM-dd"))


def severity_rank(
    c: Column, ranks: Mapping[str, int] = SEVERITY_RANKS, other: int = OTHER_SEVERITY
) -> Column:
    """Class text to a rank, lower is worse; unknown and missing text take ``other``."""
    chain = F.lit(other)
    for text, rank in reversed(list(ranks.items())):
        chain = F.when(c == text, F.lit(rank)).otherwise(chain)
    return chain


def tier_by_limit(
    c: Column,
    limits: Sequence[tuple[float, str]] = COST_LIMITS,
    lowest: str = LOWEST_COST_TIER,
) -> Column:
    """First tier whose limit is reached; null falls to the lowest one."""
    chain = F.lit(lowest)
    for limit, tier in reversed(limits):
        chain = F.when(c >= limit, F.lit(tier)).otherwise(chain)
    return chain


def safety_tier(recalls: Column, worst: Column) -> Column:
    chain = F.when(recalls == 0, F.lit(NO_RECALL_TIER))
    for rank, tier in SAFETY_BY_SEVERITY.items():
        chain = chain.when(worst == rank, F.lit(tier))
    return chain.otherwise(F.lit(OTHER_SAFETY_TIER))


def risk_score(gap: Column, recalls: Column, worst: Column, ongoing: Column) -> Column:
    """Gap percent, plus points for the worst recall and for each ongoing one, to one place."""
    zero = F.lit(0)
    severity_points = (OTHER_SEVERITY - worst) * POINTS_PER_SEVERITY_STEP
    return F.round(
        F.coalesce(gap, F.lit(0.0))
        + F.when(recalls > 0, severity_points).otherwise(zero)
        + F.coalesce(ongoing, zero) * POINTS_PER_ONGOING,
        1,
    )


def short_label(c: Column, length: int = LABEL_LENGTH) -> Column:
    mark = F.when(F.length(c) > length, F.lit(LABEL_MARK)).otherwise(F.lit(""))
    return F.concat(F.substring(c, 1, length), mark)


def _figure(form: str, c: Column) -> Column:
    return F.when(c.isNull(), F.lit(MISSING_FIGURE)).otherwise(F.format_string(form, c))


def prompt_text(
    description: str = "drug_desc",
    gap: str = "payment_gap_pct",
    impact: str = "dollar_impact",
    cost: str = "cost_risk_tier",
    safety: str = "safety_risk_tier",
    recalls: str = "total_recalls",
    ongoing: str = "ongoing_recalls",
    score: str = "combined_risk_score",
    template: str = PROMPT,
) -> Column:
    """Prompt that holds only figures the pipeline has computed."""
    return F.format_string(
        template,
        F.coalesce(F.col(description), F.lit(MISSING_FIGURE)),
        _figure("%.1f", F.col(gap)),
        _figure("%,.0f", F.col(impact)),
        F.col(cost),
        F.col(safety),
        F.col(recalls).cast("string"),
        F.col(ongoing).cast("string"),
        _figure("%.1f", F.col(score)),
    )
