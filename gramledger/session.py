"""Session settings and the shared folder that cuts lineage between jobs."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator, Mapping
from contextlib import AbstractContextManager, contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# What a task of a large shuffle takes in, some 300 MB once it is sorted and grouped.
ROWS_OF_PART, BYTES_OF_PART = 500_000, "16m"

_local_base: dict[str, str] = {}


def build_session(app: str = "gramledger", master: str | None = None, **conf: object) -> SparkSession:
    """Session with the settings the operators are tuned for.

    Skewed join keys are left to adaptive execution, which splits a hot partition at run time. The
    session zone is fixed so that dates and run stamps mean the same on every machine.
    """
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    settings = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.sql.python.filterPushdown.enabled": "true",
        **conf,
    }
    for name, value in settings.items():
        builder = builder.config(name, str(value))
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """Folder that every executor can reach.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, where driver and executors
    are one machine, may fall back to a temporary folder of its own.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder shared by all executors")
    app = spark.sparkContext.applicationId
    if app not in _local_base:
        _local_base[app] = tempfile.mkdtemp(prefix="gramledger-")
    return _local_base[app]


def fresh_path(spark: SparkSession, tag: str) -> str:
    """New path under the shared folder; never reused, so a rerun cannot read old data."""
    return f"{shared_folder(spark)}/{tag}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` once and read it back: cuts the lineage and survives the loss of executors."""
    path = fresh_path(df.sparkSession, tag)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_small(scan: DataFrame) -> DataFrame:
    """Redistribute a plain file scan whose rows sit in fewer splits than there are cores.

    A file with one row group is read by one task, however many cores are free. A scan that already has
    many splits is returned as it is: a large table is never moved.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    if scan.rdd.getNumPartitions() > 4 * cores:
        return scan
    filled = scan.select(F.spark_partition_id()).distinct().count()
    return scan if filled >= cores else scan.repartition(cores)


def parts_of(rows: int) -> int:
    """Shuffle partitions that hold ``ROWS_OF_PART`` rows in the mean, one at least."""
    return 1 + rows // ROWS_OF_PART


def bounded_parts(spark: SparkSession, rows: int) -> AbstractContextManager[None]:
    """Session settings for a block whose largest shuffles take ``rows`` rows.

    With a fixed number of shuffle partitions, what a task sorts and groups grows with the table. Adaptive execution joins
    small partitions again, up to ``BYTES_OF_PART`` each.
    """
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), parts_of(rows))
    advisory = "spark.sql.adaptive.advisoryPartitionSizeInBytes"
    return settings(spark, {"spark.sql.shuffle.partitions": parts, advisory: BYTES_OF_PART})


@contextmanager
def settings(spark: SparkSession, wanted: Mapping[str, object]) -> Iterator[None]:
    """Session settings for the duration of a block."""
    before = {name: spark.conf.get(name, None) for name in wanted}
    try:
        for name, value in wanted.items():
            spark.conf.set(name, str(value))
        yield
    finally:
        for name, value in before.items():
            spark.conf.unset(name) if value is None else spark.conf.set(name, value)
