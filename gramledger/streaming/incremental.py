"""Incremental landing: take new files only, flatten, drop repeats, append.

Two ways to know a repeat. :func:`land_new_files` remembers every key for ever. :func:`land_recent_files` takes a key once
per period, so its state holds the keys of the last periods only, however long the feed runs.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from gramledger.session import settings

STATE_STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
ROCKSDB_CONF = "spark.sql.streaming.stateStore.rocksdb"

# Fixed value: MB a part of the state keeps of its filters and blocks. Spark's own 8 MB are less than the filters of ten million
# keys, so that each key would read them from disk again.
STATE_CACHE = 64


def land_new_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    flatten: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    target: str,
    state: str,
    files_per_batch: int = 1000,
    partitions: int | None = None,
    version: str | None = None,
) -> StreamingQuery:
    """Run over the files that came in since the last run and append unseen keys to ``target``.

    Documents that get updated bring a ``version`` column, such as the time of their delivery: every new
    version of a key is appended, and :func:`drop_repeats` with ``newest_by=version`` reads the newest.

    The keys already written live in the state store under ``state``, spread by key over the tasks and
    kept on disk, so a run costs what its new files cost and never reads the target again. The Parquet
    sink commits each batch once; a run that is broken off and started again adds nothing twice. Put
    ``state`` and ``target`` in storage that all executors share. ``partitions`` is the number of parts of
    the state, by default one per core; the first run settles it for good. Keys are plain columns.
    """
    new = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)
    known = list(keys) if version is None else [*keys, version]
    unseen = _combined(flatten(new), known).dropDuplicates(known)
    writer = (
        unseen.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", state)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    parts = partitions or spark.sparkContext.defaultParallelism
    with settings(spark, {STATE_STORE: ROCKSDB, "spark.sql.shuffle.partitions": parts}):
        return writer.start()


def land_recent_files(
    spark: SparkSession,
    source: str,
    schema: T.StructType,
    flatten: Callable[[DataFrame], DataFrame],
    keys: Sequence[str],
    target: str,
    state: str,
    run_ts: str,
    days: int,
    stamp: str = "taken_at",
    files_per_batch: int = 1000,
    partitions: int | None = None,
    count_keys: bool = True,
) -> StreamingQuery:
    """Like :func:`land_new_files`, with keys remembered for the rest of a period of ``days``, counted from 1970.

    All rows of a run get the time of the run, ``run_ts``, as their column ``stamp``; a run that is started again after a
    failure is given the same one. The stamp is the stream's event time, so no row is late, whatever dates it holds:

    * a key that comes again in the period in which it was taken is dropped;
    * one that comes again in a later period is taken once more, with its later stamp, and :func:`drop_repeats` with
      ``newest_by=stamp`` reads the newest; nothing is lost.

    That is the same however the files fall into batches. The state holds the keys of at most two periods: the first
    batch of a run moves the watermark to ``days`` before the run, and keys of runs before that go at its end. Runs whose time
    goes back are refused, as the stream would drop their rows.

    ``count_keys=False`` leaves out the count that :func:`keys_held` gives, for which every key that is taken or goes is
    looked up once more.
    """
    new = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch).json(source)
    at = F.lit(run_ts).cast("timestamp")
    newest = _newest(spark, target, stamp)
    if newest is not None and spark.range(1).where(at < F.lit(newest).cast("timestamp")).count():
        raise ValueError(f"run of {run_ts} after one of {newest}")
    rows = _combined(flatten(new), keys).withColumn(stamp, at)
    period = unused_name(rows.columns, "period")
    periods = rows.withColumn(period, F.floor(F.unix_seconds(stamp) / (days * 86_400)))
    unseen = periods.withWatermark(stamp, f"{days} days").dropDuplicatesWithinWatermark([*keys, period]).drop(period)
    writer = (
        unseen.writeStream.format("parquet")
        .option("path", target)
        .option("checkpointLocation", state)
        .outputMode("append")
        .trigger(availableNow=True)
    )
    parts = partitions or spark.sparkContext.defaultParallelism
    store = {STATE_STORE: ROCKSDB, f"{ROCKSDB_CONF}.blockCacheSizeMB": STATE_CACHE}
    store[f"{ROCKSDB_CONF}.trackTotalNumberOfRows"] = str(count_keys).lower()
    with settings(spark, {**store, "spark.sql.shuffle.partitions": parts}):
        return writer.start()


def unused_name(names: Sequence[str], wanted: str) -> str:
    while wanted in names:
        wanted += "_"
    return wanted


def keys_held(query: StreamingQuery) -> int:
    """Keys in the state after the query's last batch; 0 if it had none. The query counted them, see ``count_keys``."""
    progress = [p for p in query.recentProgress if p.stateOperators]
    return progress[-1].stateOperators[0].numRowsTotal if progress else 0


def _newest(spark: SparkSession, target: str, stamp: str) -> str | None:
    """Newest stamp in the target, from the footers of its files; None if there is no target yet."""
    try:
        taken = spark.read.parquet(target)
    except AnalysisException:  # nothing was landed yet
        return None
    with settings(spark, {"spark.sql.parquet.aggregatePushdown": True}):
        return taken.agg(F.max(stamp).cast("string").alias("newest")).collect()[0]["newest"]


def _combined(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Repeats dropped within each Arrow batch, ahead of the shuffle.

    A streaming ``dropDuplicates`` sends every row to the task that owns its key. So of a delivery that
    repeats one key over and over, each batch passes on a single row.
    """
    names = list(keys)

    def first_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            numbered = rows.select(names).append_column("_row", pa.array(range(batch.num_rows)))
            first = numbered.group_by(names, use_threads=False).aggregate([("_row", "min")])
            yield from rows.take(first["_row_min"]).combine_chunks().to_batches()

    return df.mapInArrow(first_rows, df.schema)


def drop_repeats(df: DataFrame, keys: Sequence[str], newest_by: str) -> DataFrame:
    """Rows of an append-only table with repeats removed: the newest row per key stays.

    The comparison is a maximum, so repeats of a key combine in each task ahead of the shuffle. Rows
    that tie on ``newest_by`` are settled by their remaining columns.
    """
    rest = [c for c in df.columns if c not in keys and c != newest_by]
    latest = F.max(F.struct(newest_by, *rest)).alias("_latest")
    return df.groupBy(*keys).agg(latest).select(*keys, "_latest.*").select(*df.columns)
