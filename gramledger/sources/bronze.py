"""Landing zone: JSON and Parquet folders partitioned by ingest date."""

from __future__ import annotations

from collections.abc import Sequence
from datetime import date
from functools import reduce
from operator import or_

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

INGEST_DATE = "ingest_date"
RAW, REASON = "_raw", "_reason"

# Landed JSON repeats its field names on every line, so it is compressed. Spark does not split such a file; the
# limit keeps it small enough for one task.
LANDED_JSON = {"compression": "gzip", "maxRecordsPerFile": 500_000}


def run_date(given: str | None = None) -> str:
    """Date of a run: the one given, else today."""
    return date.fromisoformat(given).isoformat() if given else date.today().isoformat()


def stamp_rows(df: DataFrame, run_ts: str, column: str = "ingested_at") -> DataFrame:
    """One ingestion time per run, so that a repeated task writes the same value."""
    return df.withColumn(column, F.lit(run_ts))


def write_dated(
    df: DataFrame, path: str, day: str | None = None, fmt: str = "parquet", mode: str = "replace"
) -> dict[str, object]:
    """Write date folders and return row count and schema, counted by the write itself.

    ``day`` is the date of the whole frame. Without it the frame brings its own ``ingest_date``, and rows of
    a day are brought together first, in as many tasks as the day needs.
    ``replace`` swaps the days that are written and leaves the others alone; with ``day``, that day is
    swapped even if there are no rows. ``append`` adds to them. JSON is compressed, in files of bounded size.
    """
    if mode not in ("replace", "append"):
        raise ValueError("mode is 'replace' or 'append'")
    if day is None:
        dated = df.hint("rebalance", INGEST_DATE)
    else:
        dated = df.withColumn(INGEST_DATE, F.lit(day).cast("date"))
    seen = Observation()
    counted = dated.observe(seen, F.count(F.lit(1)).alias("rows"))
    options = LANDED_JSON if fmt == "json" else {}
    writer = counted.write.partitionBy(INGEST_DATE).format(fmt).options(**options)
    if mode == "append":
        writer.mode("append").save(path)
    elif day is None:
        writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").save(path)
    else:  # the folder itself, so that a delivery without rows leaves none of the old ones
        folder = f"{path.rstrip('/')}/{INGEST_DATE}={day}"
        counted.drop(INGEST_DATE).write.format(fmt).options(**options).mode("overwrite").save(folder)
    return {"rows": seen.get["rows"], "schema": df.schema.simpleString()}


def read_dated_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    day: str | None = None,
    arrays: bool = False,
) -> DataFrame:
    """Landed JSON with a fixed schema; ``day`` reads that folder only.

    New files are JSON Lines, compressed or not. ``arrays=True`` reads older files, one JSON array each, which Spark
    cannot split.
    """
    dated = T.StructType([*schema.fields, T.StructField(INGEST_DATE, T.DateType())])
    df = spark.read.schema(dated).option("multiLine", arrays).json(path)
    return df if day is None else df.where(F.col(INGEST_DATE) == F.lit(day).cast("date"))


def read_json_array(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Files that hold one JSON array each, outside any date folder."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def read_checked_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    required: Sequence[str] = (),
    arrays: bool = False,
) -> DataFrame:
    """All records of JSON files, whether they fit ``schema`` or not, with ``_raw`` and ``_reason`` of those that don't.

    ``not_json``    the line (or, with ``arrays``, the file) cannot be parsed; no field of it is trusted
    ``wrong_type``  it can, but a field holds what its type cannot
    ``missing``     it fits, but one of the ``required`` fields is null
    Good records have null for both. ``_raw`` is the record's own text, of a missing field its fields as JSON. Blank lines
    are no records.
    """
    fields = T.StructType([*schema.fields, T.StructField(RAW, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": RAW}
    if arrays:  # Spark's reader gives up a whole file for one element
        files = spark.read.text(path, wholetext=True)
        elements = F.coalesce(F.from_json("value", "array<string>"), F.array("value"))
        each = files.select(F.explode(elements).alias("_element"), F.col("_metadata.file_path").alias("_file"))
        df = each.select(F.from_json("_element", fields, options).alias("_record"), "_file").select("_record.*", "_file")
    else:
        df = spark.read.schema(fields).options(**options).json(path).withColumn("_file", F.col("_metadata.file_path"))
    absent = reduce(or_, (F.col(c).isNull() for c in required), F.lit(False))
    reason = (
        F.when(F.col(RAW).isNotNull() & F.try_parse_json(RAW).isNull(), F.lit("not_json"))
        .when(F.col(RAW).isNotNull(), F.lit("wrong_type"))
        .when(absent, F.lit("missing"))
    )
    fitting = F.to_json(F.struct(*schema.fieldNames()))
    return df.withColumn(REASON, reason).withColumn(RAW, F.when(F.col(REASON) == "missing", fitting).otherwise(F.col(RAW)))


def land_checked(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    target: str,
    quarantine: str,
    day: str,
    required: Sequence[str] = (),
    arrays: bool = False,
) -> dict[str, int]:
    """Land a day's records; those that don't fit go to the day's ``quarantine`` with their text, reason and file.

    Returns how many came, were landed and quarantined; the first is the sum of the others, all counted by the writes.
    A day without a broken record reads its files once. Landing a day again replaces both tables' day.
    """
    checked = read_checked_json(spark, path, schema, required, arrays)
    seen = Observation()
    broken = F.count_if(F.col(REASON).isNotNull()).alias("quarantined")
    counted = checked.observe(seen, F.count(F.lit(1)).alias("came"), broken)
    landed = write_dated(counted.where(F.col(REASON).isNull()).select(*schema.fieldNames()), target, day)["rows"]
    kept = checked.select(F.col(RAW).alias("raw"), F.col(REASON).alias("reason"), F.col("_file").alias("file"))
    kept = kept.where(F.col("reason").isNotNull() if seen.get["quarantined"] else F.lit(False))
    found = write_dated(kept, quarantine, day)["rows"]
    if landed + found != seen.get["came"]:
        raise ValueError(f"{landed} landed and {found} quarantined of {seen.get['came']} records: the files changed")
    return {"came": seen.get["came"], "landed": landed, "quarantined": found}


def read_parts(
    spark: SparkSession, path: str, day: str | None = None, schema: T.StructType | None = None
) -> DataFrame:
    """A folder of Parquet parts as one table, columns matched by name across parts.

    With a ``schema`` no footer is read ahead; a column missing in a part is null there. Without one the
    footers of all parts are merged first, which takes long for very many parts.
    """
    if schema is None:
        df = spark.read.option("mergeSchema", True).parquet(path)
    else:
        df = spark.read.schema(schema).parquet(path)
    return df if day is None else df.where(F.col(INGEST_DATE) == F.lit(day).cast("date"))


def stack(*parts: DataFrame) -> DataFrame:
    """All rows of all parts, matched by column name; a column missing in a part is null there."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def read_landing_table(
    spark: SparkSession,
    url: str,
    table: str,
    key: str,
    lower: int,
    upper: int,
    partitions: int,
    **options: str,
) -> DataFrame:
    """Landing table of a database, read in key ranges by as many tasks."""
    return spark.read.jdbc(
        url,
        table,
        column=key,
        lowerBound=lower,
        upperBound=upper,
        numPartitions=partitions,
        properties=options,
    )


def documents_as_rows(df: DataFrame, object_id: str = "_id") -> DataFrame:
    """Document export with its object id as text."""
    return df.withColumn(object_id, F.col(object_id).cast("string"))
