"""One query per operator over the driver's tables, and its SQL where SQL can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramledger.llm import (
    bpe_codec,
    centroids,
    decontamination,
    language_id,
    license_scan,
    lm_score,
    neighbours,
    packing,
    prefix_trie,
    simhash,
    suffix_dedup,
    toxicity,
    url_filter,
)
from gramledger.llm.common import remainder

Query = Callable[[SparkSession, str], DataFrame]


def read(spark: SparkSession, folder: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{table}.parquet")


def tokenizer_paths() -> tuple[str, str]:
    """Where this machine keeps the public tokenizer and its ranks; the paths are arguments of the operator."""
    import public_tokenizers

    return tuple(str(public_tokenizers.path(f"byte_bpe_50k.{kind}")) for kind in ("json", "tiktoken"))


def word_tokenizer_path() -> str:
    import public_tokenizers

    return str(public_tokenizers.path("word_bpe_49k.json"))


def op1_suffix_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return suffix_dedup.remove_repeats(read(spark, folder, "documents"), longest="longest_repeat")


def op2_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    return license_scan.scan(read(spark, folder, "documents"))


def op3_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = read(spark, folder, "documents"), read(spark, folder, "labels")
    model = toxicity.learn(docs.where(remainder(F.col("doc_id"), 5) != 0), labels)
    found = toxicity.score(docs, model)
    held_out = (remainder(F.col("doc_id"), 5) == 0).alias("held_out")
    return found.select("doc_id", held_out, *found.columns[1:])


def op4_language_id(spark: SparkSession, folder: str) -> DataFrame:
    docs = read(spark, folder, "documents")
    held_out = remainder(F.col("doc_id"), 4) == 2
    found = language_id.predict(docs, language_id.learn(docs.where(~held_out)))
    return found.select("doc_id", held_out.alias("held_out"), *found.columns[1:])


def op5_simhash(spark: SparkSession, folder: str) -> DataFrame:
    return simhash.near_duplicates(read(spark, folder, "documents"))


def op6_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(read(spark, folder, "pages"))


def op7_lm_score(spark: SparkSession, folder: str) -> DataFrame:
    return lm_score.score(read(spark, folder, "documents"))


def op8_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    return decontamination.contamination(read(spark, folder, "documents"), read(spark, folder, "benchmark"))


def op9_neighbours(spark: SparkSession, folder: str) -> DataFrame:
    return neighbours.nearest(read(spark, folder, "embeddings"))


def op10_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(read(spark, folder, "documents"), *tokenizer_paths())


def op11_bpe(spark: SparkSession, folder: str) -> DataFrame:
    found = bpe_codec.encode(read(spark, folder, "documents"), word_tokenizer_path())
    listed = F.array_join(F.col("ids").cast("array<string>"), " ")
    return found.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(listed.cast("binary"), 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op12_centroids(spark: SparkSession, folder: str) -> DataFrame:
    return centroids.cluster(read(spark, folder, "embeddings"))


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie.trie(read(spark, folder, "conversations"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_suffix_dedup,
        op2_license_scan,
        op3_toxicity,
        op4_language_id,
        op5_simhash,
        op6_url_filter,
        op7_lm_score,
        op8_decontamination,
        op9_neighbours,
        op10_packing,
        op11_bpe,
        op12_centroids,
        op13_prefix_trie,
    )
}

_LOWER = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

CONTAMINATION_SQL = f"""
    WITH d AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
    i AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
    sizes AS (SELECT DISTINCT least(13, len(w)) AS k FROM i WHERE len(w) > 0),
    iw AS (SELECT DISTINCT item_id, k, array_to_string(w[s : s + k - 1], ' ') AS t FROM (
        SELECT item_id, w, least(13, len(w)) AS k, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS s
        FROM i WHERE len(w) > 0)),
    dw AS (SELECT doc_id, k, s, array_to_string(w[s : s + k - 1], ' ') AS t FROM (
        SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS s FROM d, sizes WHERE len(w) >= k)),
    hits AS (SELECT doc_id, item_id, k, s FROM dw JOIN iw USING (k, t)),
    places AS (SELECT doc_id, count(DISTINCT p) AS n FROM (
        SELECT doc_id, unnest(range(s, s + k)) AS p FROM (SELECT DISTINCT doc_id, k, s FROM hits)) GROUP BY doc_id),
    names AS (SELECT doc_id, count(*) AS n, string_agg(x, ',' ORDER BY x) AS ids
        FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM hits) GROUP BY doc_id)
    SELECT d.doc_id, coalesce(len(w), 0)::BIGINT AS n_words, coalesce(places.n, 0) AS n_hit,
           coalesce(names.n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
           coalesce(places.n, 0) > 0 AND 20 * coalesce(places.n, 0) >= coalesce(len(w), 0) AS contaminated
    FROM d LEFT JOIN places USING (doc_id) LEFT JOIN names USING (doc_id)"""

ORACLE: dict[str, str] = {
    "op2_license_scan": license_scan.scan_sql(),
    "op6_url_filter": url_filter.judge_sql(),
    "op8_decontamination": CONTAMINATION_SQL,
    "op12_centroids": centroids.cluster_sql(),
    "op13_prefix_trie": prefix_trie.trie_sql(),
}
