"""Days that are replaced as a whole: a version is written first and published afterwards.

A table is a folder with ``data/version=<v>/ingest_date=<day>/`` and ``_published/``, small files that say which version of
which day counts. A version is written next to the ones in use; only when all its files are there, one small file names
its days. So a write that fails half-way, or is still going on, changes nothing that is read; the days of one version change
together; and an older state can be read as long as its versions are kept.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramledger.sources.bronze import INGEST_DATE

PUBLISHED = T.StructType(
    [
        T.StructField("day", T.StringType()),
        T.StructField("version", T.StringType()),
        T.StructField("number", T.LongType()),
        T.StructField("rows", T.LongType()),
    ]
)


def published(spark: SparkSession, path: str, upto: int | None = None) -> DataFrame:
    """The version of each day that counts: the one of the highest number, up to ``upto`` if that is given."""
    try:
        every = spark.read.schema(PUBLISHED).json(f"{path}/_published")
    except AnalysisException:  # nothing was published yet
        every = spark.createDataFrame([], PUBLISHED)
    if upto is not None:
        every = every.where(F.col("number") <= upto)
    newest = F.max(F.struct("number", "version", "rows")).alias("newest")
    return every.groupBy("day").agg(newest).select("day", "newest.version", "newest.number", "newest.rows")


def publish_days(df: DataFrame, path: str, day: str | None = None) -> int:
    """Replace days by the rows of ``df`` and return the number of the version.

    ``day`` is the date of the whole frame; it is replaced even if there are no rows. Without it, the frame brings its own
    ``ingest_date`` and its days are replaced. Of two versions published at once, each day is whole from one of them.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    dated = df.hint("rebalance", INGEST_DATE) if day is None else df.withColumn(INGEST_DATE, F.lit(day).cast("date"))
    seen = Observation()
    days = F.collect_set(F.col(INGEST_DATE).cast("string")).alias("days")  # a table has few days
    counted = dated.observe(seen, F.count(F.lit(1)).alias("rows"), days)
    counted.write.partitionBy(INGEST_DATE).parquet(f"{path}/data/version={version}")
    written = seen.get["days"] if day is None else [day]
    highest = published(spark, path).agg(F.max("number")).collect()[0][0]
    number = 1 if highest is None else highest + 1
    rows = [(d, version, number, seen.get["rows"]) for d in written]
    if rows:  # one file, which is there or not
        spark.createDataFrame(rows, PUBLISHED).coalesce(1).write.mode("append").json(f"{path}/_published")
    return number


def read_published(
    spark: SparkSession, path: str, schema: T.StructType, day: str | None = None, upto: int | None = None
) -> DataFrame:
    """The rows that count now, or did when version ``upto`` was the last; ``day`` reads that day only.

    Only the folders of these versions are read: a name per day goes through the driver.
    """
    whole = T.StructType([f for f in schema.fields if f.name != INGEST_DATE]).add(INGEST_DATE, T.DateType())
    chosen = published(spark, path, upto)
    chosen = chosen if day is None else chosen.where(F.col("day") == day)
    listed = [(r["version"], r["day"]) for r in chosen.where("rows > 0").collect()]
    if not listed:
        return spark.createDataFrame([], whole)
    versions = sorted({v for v, _ in listed})
    days = F.struct("version", F.col(INGEST_DATE).cast("string")).isin(
        [F.struct(F.lit(v).alias("version"), F.lit(d).alias("day")) for v, d in listed]
    )
    wide = T.StructType([*whole.fields, T.StructField("version", T.StringType())])
    folders = [f"{path}/data/version={v}" for v in versions]
    return spark.read.schema(wide).option("basePath", f"{path}/data").parquet(*folders).where(days).drop("version")


def published_rows(spark: SparkSession, path: str) -> int:
    """Rows of the versions that count now, those of their replaced days included."""
    return published(spark, path).select("version", "rows").distinct().agg(F.sum("rows")).collect()[0][0] or 0


def drop_old_versions(spark: SparkSession, path: str, keep: int = 1) -> list[str]:
    """Delete the data of versions that none of the last ``keep`` published states reads; returns their names.

    Versions that are not published yet stay, as a run may still be writing them.
    """
    every = spark.read.schema(PUBLISHED).json(f"{path}/_published")
    last = every.agg(F.max("number")).collect()[0][0] or 0
    used: set[str] = set()
    for number in range(max(1, last - keep + 1), last + 1):
        used |= {r["version"] for r in published(spark, path, number).select("version").distinct().collect()}
    gone = sorted({r["version"] for r in every.select("version").distinct().collect()} - used)
    deleted = []
    for version in gone:
        folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/data/version={version}")
        if folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True):
            deleted.append(version)
    return deleted
