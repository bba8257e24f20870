"""The daily run over one folder: landed files to flat tables, scored table, texts and snapshot.

``python -m gramledger.plans.daily ROOT [--date YYYY-MM-DD]`` runs all steps on ``ROOT/raw``.
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramledger.functions.columns import report_date
from gramledger.operators.enrich import PAUSE
from gramledger.operators.quality import run_checks
from gramledger.operators.serving import newest
from gramledger.plans import explain, gold
from gramledger.plans.silver import silver_payments, silver_recalls
from gramledger.schemas import BRONZE_PAYMENTS, BRONZE_RECALLS, SILVER_PAYMENTS, SILVER_RECALLS
from gramledger.session import build_session
from gramledger.sources import bronze, snapshot

PAYMENTS, RECALLS = "payments", "recalls"

# Fixed value: what marks a payment row as one for a drug.
DRUG_FLAG = "Y"


def land_payments(
    feed: DataFrame, root: str, day: str, run_ts: str, flag: str = DRUG_FLAG
) -> dict[str, object]:
    """Land the flagged rows of the payment feed for a day: nested, numbered, stamped.

    ``feed`` is what ``read_pages`` or a live feed gives, after ``until_empty_page``.
    """
    rows = feed.where(F.col("HCPCS_Drug_Ind") == flag)
    number = F.monotonically_increasing_id().alias("id")
    landed = rows.select(number, F.struct(*rows.columns).alias("record"))
    return bronze.write_dated(bronze.stamp_rows(landed, run_ts), f"{root}/raw/{PAYMENTS}", day, fmt="json")


def land_recalls(
    documents: DataFrame, root: str, day: str, run_ts: str, newest_rows: int | None = None
) -> dict[str, object]:
    """Land recall documents for a day, all of them or the newest ones by report date."""
    if newest_rows is not None:
        reported = documents.withColumn("_day", report_date(F.col("report_date")))
        documents = newest(reported, "_day", "recall_number", newest_rows).drop("_day")
    stamped = bronze.stamp_rows(documents, run_ts, "_ingested_at")
    return bronze.write_dated(stamped, f"{root}/raw/{RECALLS}", day, fmt="json")


def to_bronze(
    payments: DataFrame, recalls: DataFrame, root: str, day: str, run_ts: str, newest_rows: int | None = None
) -> dict[str, dict]:
    """Land both feeds; returns rows and schema per table. :func:`to_silver` goes on from there."""
    return {
        PAYMENTS: land_payments(payments, root, day, run_ts),
        RECALLS: land_recalls(recalls, root, day, run_ts, newest_rows),
    }


def to_silver(spark: SparkSession, root: str, day: str, arrays: bool = False) -> dict[str, dict]:
    """Flatten one day's landed files; returns rows and schema per table."""
    feeds = {PAYMENTS: (BRONZE_PAYMENTS, silver_payments), RECALLS: (BRONZE_RECALLS, silver_recalls)}
    done = {}
    for feed, (schema, flatten) in feeds.items():
        landed = bronze.read_dated_json(spark, f"{root}/raw/{feed}", schema, day, arrays)
        done[feed] = bronze.write_dated(flatten(landed), f"{root}/silver/{feed}", day)
    return done


def to_gold(spark: SparkSession, root: str, day: str) -> DataFrame:
    """Score one day's flat tables, replace the scored table, and return the report of its checks."""
    payments = bronze.read_parts(spark, f"{root}/silver/{PAYMENTS}", day, SILVER_PAYMENTS)
    recalls = bronze.read_parts(spark, f"{root}/silver/{RECALLS}", day, SILVER_RECALLS)
    models = {
        "staged_payments": gold.staged_payments(payments),
        "staged_recalls": gold.staged_recalls(recalls),
    }
    models["recall_summary"] = gold.recall_summary(models["staged_recalls"])
    path = f"{root}/gold/scored"
    scored = gold.scored_table(models["staged_payments"], models["recall_summary"])
    scored.write.mode("overwrite").parquet(path)
    models["scored"] = spark.read.parquet(path)
    snapshot.register_views(**models)
    return run_checks(models, gold.CHECKS)


def to_texts(
    spark: SparkSession,
    root: str,
    run_ts: str,
    generate: Callable[[str], str] = explain.template_text,
    **pacing: float,
) -> None:
    """Replace the explanations of the top items."""
    scored = spark.read.parquet(f"{root}/gold/scored")
    texts = explain.explanations(scored, run_ts, generate, **pacing)
    texts.write.mode("overwrite").parquet(f"{root}/gold/explanations")


def to_snapshot(spark: SparkSession, root: str) -> str:
    """Write scored rows with their texts as the snapshot the dashboard reads."""
    scored = spark.read.parquet(f"{root}/gold/scored")
    texts = spark.read.parquet(f"{root}/gold/explanations")
    path = f"{root}/snapshot"
    snapshot.write_snapshot(explain.snapshot_rows(scored, texts), path)
    return path


def run(spark: SparkSession, root: str, day: str, arrays: bool = False, pause: float = PAUSE) -> None:
    for feed, done in to_silver(spark, root, day, arrays).items():
        print(f"{feed}: {done['rows']} rows, {done['schema']}")
    to_gold(spark, root, day).show(truncate=False)
    to_texts(spark, root, f"{day}T00:00:00", pause=pause)
    print(f"snapshot: {to_snapshot(spark, root)}")


def main() -> None:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    parser.add_argument("root", help="folder that holds raw/, and gets silver/, gold/ and snapshot/")
    parser.add_argument("--date", help="day to run; today if left out")
    parser.add_argument("--arrays", action="store_true", help="raw files hold one JSON array each")
    parser.add_argument("--pause", type=float, default=PAUSE, help="seconds between two generated texts")
    options = parser.parse_args()
    spark = build_session("gramledger-daily")
    run(spark, options.root, bronze.run_date(options.date), options.arrays, options.pause)
    spark.stop()


if __name__ == "__main__":
    main()
