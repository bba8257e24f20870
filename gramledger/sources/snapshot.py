"""Snapshot files and table sinks."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramledger.schemas import SNAPSHOT

CSV = {
    "header": True,
    "quote": '"',
    "escape": '"',
    "ignoreLeadingWhiteSpace": False,
    "ignoreTrailingWhiteSpace": False,
}


def write_snapshot(
    df: DataFrame, path: str, score: str = "combined_risk_score", key: str = "hcpcs_code"
) -> None:
    """CSV with header and upper-case names, ordered by score.

    The order is a range partitioning: part files follow one another and each is sorted, so no single
    task writes the whole table.
    """
    ordered = df.orderBy(F.col(score).desc_nulls_last(), F.col(key).asc())
    upper = ordered.toDF(*[c.upper() for c in ordered.columns])
    upper.write.mode("overwrite").options(**CSV).csv(path)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType = SNAPSHOT) -> DataFrame:
    """Snapshot with fixed types and lower-case names.

    The text ``None`` stays a value. CSV has one spelling for empty and missing text, so empty text comes
    back as null.
    """
    df = spark.read.schema(schema).options(**CSV, multiLine=True).csv(path)
    return df.toDF(*[c.lower() for c in df.columns])


def save_table(df: DataFrame, name: str, upper_names: bool = False) -> None:
    """Replace a catalog table, created from the frame; names in upper case for export on request."""
    shown = df.toDF(*[c.upper() for c in df.columns]) if upper_names else df
    shown.write.mode("overwrite").saveAsTable(name)


def save_bucketed(
    df: DataFrame, name: str, key: str, buckets: int, path: str, most_uneven: float = 4.0
) -> bool:
    """Replace a catalog table whose rows lie by ``key`` already, in ``buckets`` sorted files under ``path``.

    Grouping by the key, and joining it with another table of as many buckets, then needs no shuffle. A bucket is one
    task's work, so rows are counted by bucket first: if the fullest has over ``most_uneven`` times the mean, as with a key
    that owns a third of all rows, the table is saved without buckets and its readers shuffle, where partial
    sums and adaptive execution take care of that key. Returns whether the table has buckets.
    """
    bucket = F.pmod(F.hash(key), F.lit(buckets))  # as Spark's own buckets are numbered
    sizes = df.groupBy(bucket.alias("bucket")).agg(F.count(F.lit(1)).alias("n"))
    fullest, rows = sizes.agg(F.max("n"), F.sum("n")).first()
    even = rows is None or fullest <= most_uneven * max(1.0, rows / buckets)
    if even:
        writer = df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key)
    else:
        writer = df.write
    writer.mode("overwrite").option("path", path).saveAsTable(name)
    return even


def register_views(**models: DataFrame) -> None:
    """Name models for SQL; nothing is computed."""
    for name, df in models.items():
        df.createOrReplaceTempView(name)
