"""Corpus pipeline: language, near duplicates, repeated passages, benchmark passages, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame that is written as Parquet and read again as the next
stage's ``docs``. All but the last return the columns of ``docs``, whatever they are. An empty table passes through all
stages. Null texts have no language and go in the first stage.

Rows are whole documents here, so the stages have Spark hand at most ``BATCH_ROWS`` of them to a Python worker at a time;
they lower the session's own number if it is larger, and change nothing else in it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gramledger.llm import decontamination, language_id, packing, simhash, suffix_dedup
from gramledger.llm.common import discard, quoted, unused, written
from gramledger.llm.queries import read, tokenizer_paths


#: Rows of a batch for Python workers.
BATCH_ROWS = 1000
#: Passages of more than this many words are cut where they repeat. A word has five bytes at least, with its space, in 95 of
#: 100 passages of that length (in the given tables 51 words take 316 bytes in the median, 270 in the twentieth).
PASSAGE_WORDS, WORD_BYTES = 50, 5


def in_small_batches(spark: SparkSession) -> None:
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def keep_known_languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that some learned language explains. Learns from the tagged documents it is given."""
    in_small_batches(spark)
    columns = docs.columns
    names = tuple(unused(columns, n) for n in ("lang_pred", "lang_score", "lang_bits"))
    found = language_id.predict(docs, language_id.learn(docs), carry=tuple(columns), names=names)
    return found.where(~language_id.rejects(names[0], names[2])).select(*map(quoted, columns))


def keep_one_of_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document per component: the one whose id is the component's; of rows that repeat that id, one."""
    in_small_batches(spark)
    columns = docs.columns
    row = [unused(columns, n) for n in ("file_", "row_number_")]
    numbered = with_places(docs, *row)
    # a component of null ids only has a null id and its fingerprint stands for it
    found = simhash.near_duplicates(numbered, carry=tuple(row))
    group = F.coalesce(F.col("component_id").cast("string"), F.concat(F.lit("fp "), "fingerprint"))
    place = F.struct(F.coalesce(F.col("doc_id") != F.col("component_id"), F.lit(True)), *map(quoted, row))
    kept = found.groupBy(group.alias("group_")).agg(F.min(place).alias("first_"))
    kept = kept.select(*(F.col(f"first_.{quoted(r)}") for r in row))
    return numbered.join(kept, row, "left_semi").select(*map(quoted, columns))


def with_places(docs: DataFrame, file: str, row: str) -> DataFrame:
    """``docs`` with the key of each row's file and its number there, which any reading of the files repeats.

    A plain scan of Parquet files, as every stage is given, is not written again; anything else is, once.
    """
    scan = docs if docs._jdf.queryExecution().analyzed().nodeName() == "LogicalRelation" else written(docs, "placed")
    place = scan.metadataColumn("_metadata")
    return scan.withColumns({file: F.xxhash64(place["file_path"]), row: place["row_index"]})


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the passages that repeat; a document of which nothing is left stays, with an empty text.

    A passage is ``PASSAGE_WORDS`` words, counted as ``WORD_BYTES`` bytes each.
    """
    in_small_batches(spark)
    columns = docs.columns
    names = tuple(unused(columns, n) for n in ("n_bytes_", "n_removed_", "n_spans_", "kept_sha256_"))
    left = unused(columns, "kept_text_")
    span = PASSAGE_WORDS * WORD_BYTES
    found = suffix_dedup.remove_repeats(docs, carry=tuple(columns), span=span, kept_text=left, names=names)
    changed = F.when(F.col("text").isNull(), F.col("text")).otherwise(F.col(left)).alias("text")
    return found.select(*(changed if c == "text" else quoted(c) for c in columns))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents of which less than a twentieth is benchmark text."""
    in_small_batches(spark)
    columns = docs.columns
    names = tuple(unused(columns, n) for n in ("n_words_", "n_hit_", "n_items_", "items_", "contaminated_"))
    found = decontamination.contamination(
        docs, read(spark, sf_dir, "benchmark"), carry=tuple(columns), names=names
    )
    return found.where(~F.col(names[4])).select(*map(quoted, columns))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their sequences."""
    in_small_batches(spark)
    return packing.pack(docs, *tokenizer_paths())


STAGES = [
    ("language_id", keep_known_languages),
    ("simhash_near_dedup", keep_one_of_near_copies),
    ("suffix_array_dedup", cut_repeated_passages),
    ("benchmark_decontamination", drop_contaminated),
    ("best_fit_packing", pack_sequences),
]

#: SQL has no prediction by partial matching, no XXH64 and no tokenizer; tests compare with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the table ``documents``."""
    docs, before = read(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        after = written(stage(spark, docs, sf_dir), f"stage-{name}")
        if before is not None:
            discard(before)
        docs = before = after
    return STAGES[-1][1](spark, docs, sf_dir)
