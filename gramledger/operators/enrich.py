"""Row enrichment by an outside text generator, with retries and per-row failure isolation.

:func:`enrich_rows` calls it for every row; :func:`enrich_stored` keeps the results and calls it for new prompts only.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramledger.session import materialize

# Attempts per row and waits in seconds.
ATTEMPTS = 4
QUOTA_WAIT = 45.0
BUSY_WAIT = 20.0
PAUSE = 4.5

# Prompts sent by one run at most, and by one job.
MOST_PROMPTS = 10_000
BATCH = 500

# What a generator puts at the head of its error text to ask for another attempt.
QUOTA = "QUOTA"
BUSY = "BUSY"


def enrich_rows(
    df: DataFrame,
    prompt: str,
    generate: Callable[[str], str],
    out: str = "ai_explanation",
    attempts: int = ATTEMPTS,
    quota_wait: float = QUOTA_WAIT,
    busy_wait: float = BUSY_WAIT,
    pause: float = PAUSE,
    lanes: int = 1,
    wait_for: Callable[[Exception], float | None] | None = None,
) -> DataFrame:
    """``df`` with the generated text and ``status``, ``attempts`` and ``error`` per row.

    ``wait_for(error)`` says how long to wait before the next attempt, or None to give the row up. By
    default quota errors (a text that starts with ``QUOTA`` or holds ``RESOURCE_EXHAUSTED``) wait
    ``quota_wait``, and busy ones (``BUSY``, or any error class named as a server error) ``busy_wait``. A row that fails keeps its place with ``status = 'failed'``, and the others go
    on. ``generate`` is called again when Spark repeats a task, so it must stand repetition. Calls run in
    ``lanes`` tasks and each waits ``pause * lanes`` between two calls, which keeps the overall rate
    whatever the number of lanes. Write the result once before using it twice.
    """
    added = [
        T.StructField(out, T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("error", T.StringType()),
    ]
    between = pause * lanes

    def usual_wait(failure: Exception) -> float | None:
        text = str(failure)
        if text.startswith(QUOTA) or "RESOURCE_EXHAUSTED" in text:
            return quota_wait
        if text.startswith(BUSY) or type(failure).__name__.endswith("ServerError"):
            return busy_wait
        return None

    waits = wait_for or usual_wait

    def attempt_row(text: str) -> tuple[str | None, str, int, str | None]:
        import time

        for tried in range(1, attempts + 1):
            try:
                return generate(text).strip(), "ok", tried, None
            except Exception as failure:  # any failure of the generator belongs to this row alone
                error = str(failure)
                wait = waits(failure)
                if wait is None or tried == attempts:
                    return None, "failed", tried, error
                time.sleep(wait)
        raise ValueError("attempts must be at least 1")

    def run(batches: Iterator) -> Iterator:
        import time

        for batch in batches:
            rows = []
            for text in batch[prompt]:
                rows.append(attempt_row(text))
                time.sleep(between)
            for i, field in enumerate(added):
                batch[field.name] = [row[i] for row in rows]
            yield batch

    spread = df.coalesce(1) if lanes == 1 else df.repartition(lanes)
    return spread.mapInPandas(run, T.StructType([*df.schema.fields, *added]))


STORED = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("text", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("attempts", T.IntegerType()),
        T.StructField("error", T.StringType()),
        T.StructField("run", T.IntegerType()),
    ]
)


def read_store(spark: SparkSession, store: str) -> DataFrame:
    """All results of :func:`enrich_stored`, also those that failed; empty before the first run."""
    try:
        return spark.read.schema(STORED).parquet(store)
    except AnalysisException:
        return spark.createDataFrame([], STORED)


def enrich_stored(
    df: DataFrame,
    prompt: str,
    generate: Callable[[str], str],
    store: str,
    out: str = "ai_explanation",
    most_calls: int = MOST_PROMPTS,
    batch: int = BATCH,
    **pacing: object,
) -> DataFrame:
    """``df`` with ``out``, ``status``, ``attempts`` and ``error``, where no prompt that succeeded is sent again.

    Results are kept in the folder ``store`` by the hash of their prompt. Only prompts without a text there are sent, each
    once however many rows have it, ``most_calls`` per run and ``batch`` at a time; every batch is committed before the
    next, so a run that breaks off, or a task that is repeated, costs the calls of one batch again. What a run leaves
    because of its bound is ``pending`` and comes first in the next ones, in the order of the hashes; ``failed`` prompts
    are sent again. A null prompt is never sent and has no status. ``pacing`` goes to :func:`enrich_rows`.
    """
    spark = df.sparkSession
    keyed = df.withColumn("_key", F.sha2(F.col(prompt).cast("binary"), 256))
    wanted = keyed.where(F.col("_key").isNotNull()).groupBy(F.col("_key").alias("key")).agg(F.first(prompt).alias("_prompt"))
    stored = read_store(spark, store)
    runs = stored.agg(F.max("run")).collect()[0][0] or 0
    failed = stored.where("status <> 'ok'").select("key").distinct().withColumn("_again", F.lit(True))
    new = wanted.join(stored.where("status = 'ok'").select("key"), "key", "left_anti").join(failed, "key", "left")
    chosen = new.orderBy(F.col("_again").isNotNull(), "key").limit(most_calls)
    todo = materialize(chosen.withColumn("_nth", F.monotonically_increasing_id()).drop("_again"), "prompts")
    order = Window.orderBy("_nth")  # most_calls rows at most
    numbered = todo.withColumn("_nth", F.row_number().over(order) - 1)
    for at in range(0, todo.count(), batch):
        part = numbered.where(F.col("_nth").between(at, at + batch - 1))
        done = enrich_rows(part, "_prompt", generate, out="text", **pacing)
        done.withColumn("run", F.lit(runs + 1)).select(*STORED.fieldNames()).write.mode("append").parquet(store)
    value = F.struct((F.col("status") == "ok").alias("good"), "run", "text", "status", "attempts", "error")
    best = read_store(spark, store).groupBy("key").agg(F.max(value).alias("_best")).select("key", "_best.*")
    joined = keyed.join(best.withColumnRenamed("key", "_key"), "_key", "left")
    state = F.when(F.col("_key").isNotNull(), F.coalesce("status", F.lit("pending")))
    return joined.select(*df.columns, F.col("text").alias(out), state.alias("status"), "attempts", "error")


def written_explanations(df: DataFrame, run_ts: str) -> DataFrame:
    """The rows that succeeded, in the shape of the explanations table."""
    return df.where(F.col("status") == "ok").select(
        "hcpcs_code",
        "drug_desc",
        "combined_risk_score",
        "ai_explanation",
        F.lit(run_ts).cast("timestamp").alias("generated_at"),
    )
