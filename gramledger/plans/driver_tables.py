"""The order and part tables seen as payments and recalls.

A line is a payment row for its part, its line status the geography, of which ``O`` is ranked. It is a recall
notice for its part too, with the part's type as class. The description of a part is its name, brand and size.
A notice names short pieces of it: the first word of the name, and the second word with brand and size, in
small letters between spaces when the order is urgent. Only words of up to four letters are named, so one name
lies inside many descriptions, several names in one, and none in some.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from gramledger.operators.flatten import explode_keep
from gramledger.plans.gold import recall_summary, scored_table, staged_payments, staged_recalls
from gramledger.session import spread_small

PRIORITY_RANKS = {"1-URGENT": 1, "2-HIGH": 2, "3-MEDIUM": 3}
TYPE_RANKS = {"PROMO": 1, "LARGE": 2, "MEDIUM": 3}
ONGOING_STATUS = "O"
URGENT = "1-URGENT"
RANKED_GEOGRAPHY = "O"
NAMED_LETTERS = 4


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _description() -> Column:
    return F.concat_ws(", ", "p_name", "p_brand", F.concat(F.lit("size "), F.col("p_size")))


def descriptions(spark: SparkSession, folder: str) -> DataFrame:
    return table(spark, folder, "part").select(
        F.col("p_partkey").cast("string").alias("hcpcs_code"), _description().alias("drug_desc")
    )


def payments(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as flat payment rows, without text."""
    price, discount = F.col("l_extendedprice"), F.col("l_discount")
    return table(spark, folder, "lineitem").select(
        F.col("l_partkey").cast("string").alias("hcpcs_code"),
        F.col("l_linestatus").alias("geography"),
        F.col("l_linenumber").cast("double").alias("total_providers"),
        F.col("l_quantity").alias("total_services"),
        price.alias("avg_submitted_charge"),
        (price * (1 - discount)).alias("avg_medicare_allowed"),
        (price * (1 - discount * 10)).alias("avg_medicare_paid"),
    )


def awkward_payments(spark: SparkSession, folder: str) -> DataFrame:
    """The same rows with what feeds get wrong: zero charges, missing payments, codes without any volume."""
    line = F.col("total_providers")
    return payments(spark, folder).withColumns(
        {
            "avg_submitted_charge": F.when(line == 7, F.lit(0)).otherwise(F.col("avg_submitted_charge")),
            "avg_medicare_paid": F.when(line != 6, F.col("avg_medicare_paid")),
            "total_services": F.when(F.col("hcpcs_code").endswith("9"), 0).otherwise(F.col("total_services")),
        }
    )


def notices(spark: SparkSession, folder: str) -> DataFrame:
    """Lines as recall notices, with their names as an array."""
    lines = table(spark, folder, "lineitem")
    orders = table(spark, folder, "orders")
    parts = table(spark, folder, "part")
    first, second = (F.split("p_name", " ")[i] for i in (0, 1))
    exact = F.concat(second, F.lit(", "), F.col("p_brand"), F.lit(", size "), F.col("p_size"))
    spaced = F.concat(F.lit(" "), F.lower(exact), F.lit(" "))
    spelled = F.when(F.col("o_orderpriority") == URGENT, spaced).otherwise(exact)
    named = [F.when(F.length(w) <= NAMED_LETTERS, n) for w, n in ((first, first), (second, spelled))]
    return (
        lines.join(orders, lines.l_orderkey == orders.o_orderkey)
        .join(parts, lines.l_partkey == parts.p_partkey)
        .select(
            F.col("l_orderkey").cast("string").alias("recall_number"),
            F.col("p_type").alias("classification"),
            F.col("o_orderstatus").alias("status"),
            F.col("l_suppkey").cast("string").alias("recalling_firm"),
            F.lit(None).cast("string").alias("reason_for_recall"),
            F.date_format("o_orderdate", "yyyyMMdd").alias("report_date"),
            F.lit(None).cast("string").alias("distribution_pattern"),
            F.array(*named).alias("names"),
        )
    )


def recalls(spark: SparkSession, folder: str) -> DataFrame:
    rows = notices(spark, folder)
    return explode_keep(rows, "names", "generic_name", [c for c in rows.columns if c != "names"])


def staged(spark: SparkSession, folder: str) -> DataFrame:
    return staged_payments(payments(spark, folder), descriptions(spark, folder), RANKED_GEOGRAPHY)


def staged_notices(spark: SparkSession, folder: str) -> DataFrame:
    return staged_recalls(recalls(spark, folder), TYPE_RANKS)


def summary(spark: SparkSession, folder: str) -> DataFrame:
    return recall_summary(staged_notices(spark, folder), ONGOING_STATUS)


def scored(spark: SparkSession, folder: str) -> DataFrame:
    return scored_table(staged(spark, folder), summary(spark, folder))


def benchmark_words(spark: SparkSession, folder: str) -> DataFrame:
    """Distinct upper-case words of the benchmark passages, with the first passage that holds each."""
    words = table(spark, folder, "benchmark").select(
        "item_id", F.explode(F.split(F.upper(plain(F.col("text"))), " ")).alias("word")
    )
    return words.groupBy("word").agg(F.min("item_id").alias("first_item"))


def plain(c: Column) -> Column:
    """Text in which both engines agree on upper case."""
    return F.replace(c, F.lit("ß"), F.lit("ss"))


def document_texts(spark: SparkSession, folder: str) -> DataFrame:
    texts = table(spark, folder, "documents").select("doc_id", "text")
    return spread_small(texts).select("doc_id", plain(F.col("text")).alias("text"))
