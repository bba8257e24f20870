"""Left outer join on text containment: a description holds a name.

Spark plans such a join as a nested loop over all pairs. Here every description is read once instead:

``scan``     the names, whose total size is checked first, go to all tasks; each task walks its texts
             through one multi-pattern automaton and adds the array of names found. No text is moved,
             rows keep their partitioning, and the work grows with the text and not with the pairs.
             Names beyond one task's memory are left to the next way, which reads the texts once too.
``grams``    for workers without the automaton package: an equi-join of the strings in the text, by their
             hashes, with the broadcast names. A task reads each text once and hands its names on as an array.
``shuffle``  any number of names: strings that may be names, told by tables of bounded size, are shuffled on
             a salted key, once per block of texts. What is a name goes back to its block, and each text gets
             its names as an array.

In the last two, names beyond ``WHOLE`` characters are joined by fixed-width pieces, then ``contains`` decides. Such a
name is looked up by the one of its pieces that is rarest in the texts, and only pieces that some name is looked up by
leave a text.

All three give the same rows. ``auto`` measures the names and picks the first that can hold them; a way
that is asked for gives way to the next if it cannot. When only the best name per description is wanted,
and what makes it best is known of the names alone, :func:`best_contained` lets the scan itself keep that
one name, so that no rows are multiplied, sorted or shuffled.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence
from functools import reduce
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramledger.operators.best_match import best_match
from gramledger.operators.pieces import (
    ROWS,
    WHOLE,
    blocks_of_texts,
    cheapest_pieces,
    known_names,
    known_pieces,
    names_by_text,
    names_in_texts,
    piece_filter,
    sketch,
)
from gramledger.session import fresh_path, materialize

# Characters of names held in memory by a task; an automaton takes some 40 bytes for each.
SCAN_CHARS = 4_000_000
# Characters of names, and bytes of the joined name table, that may be broadcast as a hash table.
BROADCAST_CHARS = 16_000_000
BROADCAST_BYTES = 128_000_000
# Width of the piece by which a long name is looked up.
WIDTH = 8
# Characters of a text that are cut into pieces at a time.
SEGMENT = 50_000
SALTS = 8
# Names found that a task of the scan holds before it hands them on, and those of one text more.
FOUND = 1 << 16
# The key as a struct, which is equal to itself where the key is null.
KEY = "_key"


def automaton_available() -> bool:
    try:
        import ahocorasick  # noqa: F401
    except ImportError:
        return False
    return True


def contains_join(
    left: DataFrame,
    right: DataFrame,
    key: str,
    text: str,
    name: str,
    strategy: str = "auto",
    normalize: Callable[[Column], Column] = F.upper,
    min_name_len: int = 0,
    scan_chars: int = SCAN_CHARS,
) -> DataFrame:
    """``left`` rows with every ``right`` row whose ``name`` occurs in the normalized ``text``.

    ``key`` is unique in ``left``; one row may have a null key. Left rows without a match are kept once, with nulls. A
    literal match: ``%`` and ``_`` in a name stand for themselves. The empty name occurs in every text,
    unless ``min_name_len`` shuts it out. ``right`` is written once to the shared folder, because it is
    both measured and joined.
    """
    names, chars = _measured(_usable(right, name, min_name_len), name)
    prepared = left.withColumns({"_text": normalize(F.col(text)), KEY: F.struct(key)})
    strategy = _choose(strategy, chars, scan_chars)
    if strategy == "scan":
        found = _finder(_shared(names, name), T.ArrayType(T.StringType()))
        matched = prepared.withColumn(name, F.explode_outer(found(F.col("_text"))))
        return matched.join(names, name, "left").select(*left.columns, *right.columns)
    found = _names_found(prepared, names, KEY, name, move=strategy == "shuffle").withColumnRenamed(name, "_names")
    matched = prepared.join(found, KEY, "left").withColumn(name, F.explode_outer("_names"))
    return matched.join(names, name, "left").select(*left.columns, *right.columns)


def best_contained(
    left: DataFrame,
    right: DataFrame,
    key: str,
    text: str,
    name: str,
    order: Sequence[Column],
    strategy: str = "auto",
    normalize: Callable[[Column], Column] = F.upper,
    min_name_len: int = 0,
    scan_chars: int = SCAN_CHARS,
) -> DataFrame:
    """``contains_join`` followed by ``best_match`` on ``key``: one row per left row.

    ``order`` may use columns of ``right`` only. The names go to the tasks in that order, and a task
    keeps the first one it finds in a text.
    """
    single = best_match(_usable(right, name, min_name_len), name, order)
    names, chars = _measured(single, name)
    prepared = left.withColumns({"_text": normalize(F.col(text)), KEY: F.struct(key)})
    strategy = _choose(strategy, chars, scan_chars)
    if strategy == "scan":
        found = _finder(_shared(names.orderBy(*order), name), T.StringType())
        matched = prepared.withColumn(name, found(F.col("_text")))
        return matched.join(names, name, "left").select(*left.columns, *right.columns)
    found = _names_found(prepared, names, KEY, name, move=strategy == "shuffle")
    pairs = found.withColumn(name, F.explode(name)).join(names, name)
    best = best_match(pairs.select(KEY, *right.columns), KEY, order)
    return prepared.join(best, KEY, "left").select(*left.columns, *right.columns)


def _usable(right: DataFrame, name: str, min_name_len: int) -> DataFrame:
    return right.where(F.col(name).isNotNull() & (F.length(name) >= min_name_len))


def _choose(strategy: str, chars: int, scan_chars: int) -> str:
    """The wished way if the names are small enough for it, else the next one that takes them all."""
    if strategy not in ("auto", "scan", "grams", "shuffle"):
        raise ValueError(f"unknown strategy {strategy!r}")
    if strategy in ("auto", "scan") and automaton_available() and chars <= scan_chars:
        return "scan"
    if strategy != "shuffle" and chars <= BROADCAST_CHARS:
        return "grams"
    return "shuffle"


def _measured(right: DataFrame, name: str) -> tuple[DataFrame, int]:
    """Write ``right`` once; its size is counted by the write itself.

    Returns the written table, marked for broadcast if its counted size allows it, and the number of
    characters in its names.
    """
    spark = right.sparkSession
    path = fresh_path(spark, "names")
    size = Observation()
    row_bytes = sum((_bytes(f) for f in right.schema.fields), F.lit(0))
    counted = right.observe(
        size, F.sum(F.length(name)).alias("chars"), F.sum(row_bytes).alias("bytes")
    )
    counted.write.parquet(path)
    written = spark.read.schema(right.schema).parquet(path)
    small = (size.get["bytes"] or 0) <= BROADCAST_BYTES
    return (F.broadcast(written) if small else written), size.get["chars"] or 0


def _bytes(field: T.StructField) -> Column:
    """Bytes of a value, from above; a nested value is measured by its JSON text."""
    if isinstance(field.dataType, T.StringType | T.BinaryType):
        size = F.octet_length(field.name)
    elif isinstance(field.dataType, T.ArrayType | T.MapType | T.StructType):
        size = F.octet_length(F.to_json(F.struct(field.name))) * 4
    else:
        size = F.lit(0)
    return F.coalesce(size, F.lit(0)).cast("long") + 16


def _shared(names: DataFrame, name: str) -> Broadcast:
    """Names, in the order of the frame, for all tasks. The caller has checked their size."""
    # the same name many times, or the empty one, counts once; the order of the frame stays
    listed = list(dict.fromkeys(row[name] for row in names.select(name).collect()))
    return names.sparkSession.sparkContext.broadcast({"names": listed})


def _finder(shared: Broadcast, returns: T.DataType) -> Callable[[Column], Column]:
    """Column function: text to all distinct names in it, or, for a string result, to the first one."""
    every = isinstance(returns, T.ArrayType)

    def automaton() -> tuple:
        import ahocorasick

        held = shared.value
        if "automaton" not in held:  # once per worker process, not once per task
            built = ahocorasick.Automaton()
            for i, word in enumerate(held["names"]):
                if word:
                    built.add_word(word, i)
            if len(built):
                built.make_automaton()
            held["automaton"] = built
            held["everywhere"] = {i for i, word in enumerate(held["names"]) if not word}
            held["array"] = pa.array(held["names"], pa.string())
        return held["automaton"], held["everywhere"], held["array"]

    def find(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        built, everywhere, names = automaton()

        def numbers(text: str) -> set[int]:
            return {i for _, i in built.iter(text)} | everywhere if len(built) else everywhere

        def packed(found: list[np.ndarray]) -> pa.Array:
            ends = pa.array(accumulate(map(len, found), initial=0), pa.int32())
            return pa.ListArray.from_arrays(ends, names.take(pa.array(np.concatenate(found))))

        for batch in batches:
            for start in range(0, len(batch), ROWS):
                texts = batch.slice(start, ROWS).to_pylist()
                found = (set() if text is None else numbers(text) for text in texts)
                if not every:
                    yield names.take(pa.array([min(f, default=None) for f in found], pa.int64()))
                    continue
                held, n = [], 0
                for f in found:  # a batch may hold any number of texts, and a text all names
                    held.append(np.fromiter(f, np.int64, len(f)))
                    n += len(f)
                    if n >= FOUND:
                        yield packed(held)
                        held, n = [], 0
                if held:
                    yield packed(held)

    return F.arrow_udf(find, returns)


def _segments(texts: DataFrame, key: str, longest: int) -> DataFrame:
    """Long texts in parts that overlap by a piece, so that no task holds all pieces of a long text.

    ``_around`` is the part with as much text on both sides as the longest name takes: a name whose piece
    lies in the part lies in there, so a candidate is checked without walking the whole text again.
    """
    last = F.floor(F.greatest(F.length("_text") - 1, F.lit(0)) / SEGMENT)
    starts = texts.withColumn("_nth", F.explode(F.sequence(F.lit(0).cast("long"), last)))
    begin = (F.col("_nth") * SEGMENT + 1).cast("int")
    length = F.lit(SEGMENT + WIDTH - 1)
    before = F.least(begin - 1, F.lit(longest))
    return starts.select(
        key,
        F.substring(F.col("_text"), begin, length).alias("_segment"),
        F.substring(F.col("_text"), begin - before, length + before + longest).alias("_around"),
    )


def _names_found(prepared: DataFrame, names: DataFrame, key: str, name: str, move: bool) -> DataFrame:
    """(key, name), where ``name`` is an array of names that the text holds; a key has no row, one or several."""
    words = names.select(name).distinct()
    # A handful of integers: which lengths short names have, how many there are, and how long the long ones get.
    size = F.least(F.length(name), F.lit(WHOLE + 1))
    sizes = words.groupBy(size.alias("_size")).agg(F.count("*").alias("_n"), F.max(F.length(name)).alias("_longest")).collect()
    lengths = {r["_size"]: r["_n"] for r in sizes if 0 < r["_size"] <= WHOLE}
    texts = prepared.where(F.col("_text").isNotNull()).select(key, "_text")
    ways = []
    if lengths:
        short = words.where(F.length(name).between(1, WHOLE))
        ways.append(_short_moved(texts, short, key, name, lengths) if move else _short_held(texts, short, key, name))
    if longest := max((r["_longest"] for r in sizes if r["_size"] > WHOLE), default=0):
        pairs = _long_pairs(texts, words.where(F.length(name) > WHOLE), key, name, longest, move)
        ways.append(pairs.select(key, F.array(name).alias(name)))
    found = reduce(DataFrame.unionAll, ways) if ways else texts.where("false").select(key, F.array(F.lit("")).alias(name))
    if not move:
        one_each = F.array_distinct(F.flatten(F.collect_list(name)))
        found = found.groupBy(key).agg(one_each.alias(name))
    # The empty name is in every text.
    everywhere = any(r["_size"] == 0 for r in sizes)
    return found.unionAll(texts.select(key, F.array(F.lit("")).alias(name))) if everywhere else found


def _short_held(texts: DataFrame, short: DataFrame, key: str, name: str) -> DataFrame:
    """All short names go to the tasks as a table of their hashes; no text and no piece of one is moved."""
    listed = short.toArrow()[name].cast(pa.string()).combine_chunks()  # their size was checked
    shared = texts.sparkSession.sparkContext.broadcast({"names": listed})
    return names_in_texts(texts, key, "_text", name, shared)


def _short_moved(texts: DataFrame, short: DataFrame, key: str, name: str, lengths: Mapping[int, int]) -> DataFrame:
    """Strings that may be names meet the names, once per block of texts, and what is one goes back to its block."""
    known = known_names(short, name, list(lengths), sum(lengths.values()))
    shared = texts.sparkSession.sparkContext.broadcast(tuple(known))
    made = materialize(blocks_of_texts(texts, key, "_text", shared), "blocks")
    pieces = made.where(F.col("_piece").isNotNull()).select("_block", "_piece", "_at")
    pieces = pieces.withColumn("_salt", F.pmod(F.xxhash64("_block"), F.lit(SALTS)))
    salted = _salted(short.select(F.col(name), F.col(name).alias("_piece")))
    found = pieces.join(salted, ["_piece", "_salt"]).select(F.col("_block").alias("_of"), name, "_at")
    keys = made.where(F.col("_piece").isNull()).select("_block", "_keys")
    return names_by_text(found, keys, key, name)


def _salted(lookup: DataFrame) -> DataFrame:
    every_salt = F.sequence(F.lit(0).cast("long"), F.lit(SALTS - 1).cast("long"))
    return lookup.withColumn("_salt", F.explode(every_salt))


def _long_pairs(texts: DataFrame, words: DataFrame, key: str, name: str, longest: int, move: bool) -> DataFrame:
    """(key, name) for names beyond ``WHOLE`` characters: found by a piece, then compared with the text."""
    cut = [WIDTH]
    lookup = cheapest_pieces(words, name, cut, sketch(texts, "_text", cut), sketch(words, name, cut))
    lookup = materialize(lookup, "lookup")
    segments = _segments(texts, key, longest)
    segments = segments.drop("_around") if move else segments  # the text is not what is shuffled
    pieces = known_pieces(segments, "_segment", cut, piece_filter(lookup))
    if not move:
        found = pieces.join(F.broadcast(lookup), "_piece")
        # Texts stay where they are; what moves are names found.
        return found.where(F.contains(F.col("_around"), F.col(name))).select(key, name)
    pieces = pieces.select(key, "_piece", F.pmod(F.xxhash64(key), F.lit(SALTS)).alias("_salt"))
    found = pieces.join(_salted(lookup), ["_piece", "_salt"]).select(key, name)
    # Candidates go to where their text is, once each, and are checked there.
    candidates = found.repartition(key).distinct().join(texts, key)
    return candidates.where(F.contains(F.col("_text"), F.col(name))).select(key, name)
