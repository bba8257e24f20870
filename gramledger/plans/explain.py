"""Explanations for the items at the top of the ranking."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame

from gramledger.functions import columns as C
from gramledger.operators.enrich import enrich_rows, written_explanations
from gramledger.operators.serving import top_n
from gramledger.session import materialize

# Fixed value: how many items get a text.
TOP_ITEMS = 50


def with_prompts(scored: DataFrame, n: int = TOP_ITEMS) -> DataFrame:
    return top_n(scored, n).select(
        "hcpcs_code", "drug_desc", "combined_risk_score", C.prompt_text().alias("prompt")
    )


def template_text(prompt: str) -> str:
    """Stand-in generator: the figures of the prompt in one line, no outside service."""
    return "; ".join(line for line in prompt.splitlines()[1:])


def enriched_top(
    scored: DataFrame,
    generate: Callable[[str], str] = template_text,
    n: int = TOP_ITEMS,
    **pacing: float,
) -> DataFrame:
    """Top rows with text or failure, written once so that no call is made twice by later steps."""
    return materialize(enrich_rows(with_prompts(scored, n), "prompt", generate, **pacing), "enriched")


def explanations(
    scored: DataFrame,
    run_ts: str,
    generate: Callable[[str], str] = template_text,
    n: int = TOP_ITEMS,
    **pacing: float,
) -> DataFrame:
    """Explanations table: only rows whose generation succeeded."""
    return written_explanations(enriched_top(scored, generate, n, **pacing), run_ts)


def snapshot_rows(scored: DataFrame, texts: DataFrame) -> DataFrame:
    """Scored rows with their explanation where there is one, in snapshot column order.

    ``texts`` holds at most the top items, so the join sends it to every task once its size is known.
    """
    joined = scored.join(texts.select("hcpcs_code", "ai_explanation"), "hcpcs_code", "left")
    return joined.select(
        "hcpcs_code",
        "drug_desc",
        "total_services",
        "avg_submitted_charge",
        "avg_medicare_paid",
        "payment_gap_pct",
        "dollar_impact",
        "cost_risk_tier",
        "total_recalls",
        "ongoing_recalls",
        "safety_risk_tier",
        "combined_risk_score",
        "ai_explanation",
    )
