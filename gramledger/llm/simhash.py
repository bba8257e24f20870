"""SimHash near-duplicates over a Gray-order hierarchical index.

Distinct fingerprints are sorted by their rank in the Gray code, where neighbours share most bits, and cut into blocks
of equal size. The bits that all members of a block agree on are the block's masked pattern; a fingerprint is sent to a
block only if it differs from that pattern in at most ``bits`` places (the upper level of the index: one pattern per
block). In a block, ``FANOUT`` neighbours at a time are factored into a node that holds the bits they share and the
nodes above do not; a search goes down with the differences accumulated so far and drops a whole group as soon as they
exceed ``bits``. The search is exact. A block returns a spanning forest of what it linked, never all pairs, and the
forests are joined to components by repeated joins.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.llm.common import as_bytes, discard, map_texts, quoted, written

WORDS = 3
BITS = 2
SEED = 42
FANOUT = 8
#: Fingerprints per block, and blocks at most: their patterns are known to every task.
BLOCK_ROWS = 512
MOST_BLOCKS = 8192
#: Pairs of a fingerprint and a mark or pattern that are compared at once; a pair takes some 80 bytes meanwhile.
PAIRS = 1 << 19


def fingerprint(text: bytes, size: int = WORDS) -> int:
    """64-bit SimHash of a text's word shingles, repeats included."""
    words = text.lower().split()  # bytes: A-Z only, and white space is 0x20 and 0x09 to 0x0D
    if not words:
        return 0
    whole = b" ".join(words)
    if len(words) <= size:
        return xxhash.xxh64_intdigest(whole, SEED)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    last = ends[size - 1 :].tolist()
    first = [0, *(ends[: len(words) - size] + 1).tolist()]
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(whole[a:b], SEED) for a, b in zip(first, last)], "<u8")
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 16):
        part = hashes[k : k + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(hashes), bitorder="little").tobytes(), "little")


def fingerprints(
    docs: DataFrame, text: str = "text", carry: tuple[str, ...] = ("doc_id",), into: str = "fp", size: int = WORDS
) -> DataFrame:
    """Carried columns and the fingerprint as a signed long; null and empty texts have fingerprint zero."""

    def kernel():
        def work(texts: pa.Array) -> list[pa.Array]:
            marks = np.array([fingerprint(t, size) for t in as_bytes(texts)], np.uint64)
            return [pa.array(marks.view(np.int64))]

        return work

    return map_texts(docs, kernel, [(into, "long")], text, carry)


def gray_rank(marks: np.ndarray) -> np.ndarray:
    """Position of each code word in the Gray sequence."""
    rank = marks.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(shift)
    return rank


class Index:
    """The hierarchical index over some distinct fingerprints."""

    def __init__(self, marks: np.ndarray):
        self.marks = marks[np.argsort(gray_rank(marks))]
        levels = [(self.marks, self.marks)]  # and, or
        while len(levels[-1][0]) > FANOUT:
            cut = np.arange(0, len(levels[-1][0]), FANOUT)
            levels.append(
                (np.bitwise_and.reduceat(levels[-1][0], cut), np.bitwise_or.reduceat(levels[-1][1], cut))
            )
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []  # from the top: shared bits not shared above, pattern
        above = np.zeros(1, np.uint64)
        for all_one, any_one in reversed(levels):
            shared = ~(all_one ^ any_one)
            parents = np.repeat(above, FANOUT)[: len(shared)] if self.levels else np.zeros(len(shared), np.uint64)
            self.levels.append((shared & ~parents, all_one & shared))
            above = shared

    def search(self, queries: np.ndarray, bits: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Pairs (position of a query, position of a mark) that differ in at most ``bits`` bits.

        As many queries go down together as make ``PAIRS`` pairs with all marks, so memory does not follow the hits.
        """
        together = max(1, PAIRS // len(self.marks))
        for start in range(0, len(queries), together):
            part = queries[start : start + together]
            top = len(self.levels[0][0])
            which = np.repeat(np.arange(len(part)), top)
            node = np.tile(np.arange(top), len(part))
            differ = np.zeros(len(which), np.uint8)
            for depth, (mask, pattern) in enumerate(self.levels):
                if depth:
                    width = FANOUT
                    child = (node[:, None] * width + np.arange(width)).ravel()
                    which, differ = np.repeat(which, width), np.repeat(differ, width)
                    real = child < len(mask)
                    node, which, differ = child[real], which[real], differ[real]
                differ = differ + np.bitwise_count((part[which] ^ pattern[node]) & mask[node])
                near = differ <= bits
                which, node, differ = which[near], node[near], differ[near]
            yield which + start, node


def forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Smallest position reachable from each of ``size`` positions over the links a-b."""
    label = np.arange(size)
    while True:
        low = np.minimum(label[a], label[b])
        before = label.copy()
        np.minimum.at(label, label[a], low)
        np.minimum.at(label, label[b], low)
        np.minimum.at(label, a, low)
        np.minimum.at(label, b, low)
        label = label[label]
        if (label == before).all():
            return label


def _labels(size: int, pairs: Iterator[tuple[np.ndarray, np.ndarray]]) -> np.ndarray:
    """:func:`forest` of links that come part by part; some ``PAIRS`` of them are held."""
    label, held, waiting = np.arange(size), [], 0
    for part in chain(pairs, [None]):
        if part is not None:
            apart = part[0] != part[1]
            held.append((part[0][apart], part[1][apart]))
            waiting += len(held[-1][0])
        if waiting and (part is None or waiting >= PAIRS):
            tied = np.flatnonzero(label != np.arange(size))
            held.append((tied, label[tied]))
            label, held, waiting = forest(size, *map(np.concatenate, zip(*held))), [], 0
    return label


def _rank(batch: pa.RecordBatch) -> np.ndarray:
    """Gray ranks of the first column; flipping the top bit makes signed order the order of the ranks."""
    rank = gray_rank(batch.column(0).to_numpy(zero_copy_only=False).view(np.uint64))
    return (rank ^ np.uint64(1 << 63)).view(np.int64)


def links(marks: DataFrame, bits: int = BITS, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Links (a, b) whose components are those of all pairs of ``marks.fp`` within ``bits`` bits.

    ``marks.fp`` must be distinct and not null.
    """
    spark = marks.sparkSession
    n = marks.count()
    blocks = max(1, min(MOST_BLOCKS, -(-n // block_rows)))

    # one Python step per stage: every further one would keep a worker of its own per core
    def gray(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(_rank(batch))], ["gray"])

    splits = []
    if blocks > 1:
        at = [k / blocks for k in range(1, blocks)]
        ranked = marks.select("fp").mapInArrow(gray, "gray long")
        found = ranked.agg(F.percentile_approx("gray", at, max(10_000, 20 * blocks)).alias("s")).first()["s"]
        splits = sorted(set(found))
    edges = np.array(splits, np.int64)

    def block_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = np.searchsorted(edges, _rank(batch))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(at, pa.int64())], ["fp", "block"])

    dealt = marks.select("fp").mapInArrow(block_of, "fp long, block long")
    shape = (
        dealt.groupBy("block").agg(F.bit_and("fp").alias("every"), F.bit_or("fp").alias("some")).orderBy("block")
    ).collect()  # one row per block, MOST_BLOCKS at most
    number = np.array([r["block"] for r in shape], np.int64)
    every = np.array([r["every"] for r in shape], np.int64).view(np.uint64)
    some = np.array([r["some"] for r in shape], np.int64).view(np.uint64)
    shared = ~(every ^ some)

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        together = max(1, PAIRS // max(1, len(number)))
        for batch in batches:
            marks, own = batch.column(0).to_numpy(zero_copy_only=False), np.searchsorted(edges, _rank(batch))
            for start in range(0, len(marks), together):
                part, home = marks[start : start + together], own[start : start + together]
                away = np.bitwise_count((part.view(np.uint64)[:, None] ^ every) & shared)
                # a pair from two blocks is found in the lower one
                row, column = np.nonzero((away <= bits) & (number <= home[:, None]))
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(part[row]),
                        pa.array(number[column]),
                        pa.array(number[column] == home[row]),
                    ],
                    ["fp", "block", "member"],
                )

    def search(key: tuple, table: pa.Table) -> pa.Table:
        marks = table["fp"].to_numpy().view(np.uint64)
        member = table["member"].to_numpy()
        index = Index(marks[member])
        everyone = np.concatenate((index.marks, marks[~member]))
        label = _labels(len(everyone), index.search(everyone, bits))
        tied = label != np.arange(len(label))
        return pa.table(
            {"a": everyone[label[tied]].view(np.int64), "b": everyone[tied].view(np.int64)},
        )

    routed = marks.select("fp").mapInArrow(route, "fp long, block long, member boolean")
    return routed.groupBy("block").applyInArrow(search, "a long, b long")


def components(edges: DataFrame) -> DataFrame:
    """(node, component) for every node of the links (a, b); the component is its smallest node.

    Alternates two steps until nothing changes: every node links its larger neighbours to its smallest one, then its
    smaller neighbours and itself. Both are a grouped minimum and a join, so a node with many links is
    pre-aggregated and, in the join, split. Each round is written to the shared folder.
    """

    def star(edges: DataFrame, large: bool) -> DataFrame:
        both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else edges
        # large: a looks at all neighbours b; small: edges go from the larger end (a) to the smaller (b)
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        joined = both.join(least, "a")
        if large:
            moved = joined.where(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b"))
        else:
            moved = joined.select(F.col("b").alias("a"), F.col("m").alias("b")).unionAll(
                least.select("a", F.col("m").alias("b"))
            )
        return moved.where(F.col("a") != F.col("b")).distinct()

    def turned(edges: DataFrame) -> DataFrame:
        return edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()

    def state(edges: DataFrame) -> tuple:
        row = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("h"),
        ).first()
        return row["n"], row["h"]

    current = written(turned(edges), "links")
    before = None
    now = state(current)
    while now != before and now[0]:
        last, current = current, written(star(star(current, True), False), "links")
        discard(last)
        before, now = now, state(current)
    return current.select(F.col("a").alias("node"), F.col("b").alias("component")).unionAll(
        current.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct()
    )


def near_duplicates(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    carry: tuple[str, ...] = (),
    bits: int = BITS,
    size: int = WORDS,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per document: doc_id, fingerprint (16 hexadecimal digits), component_id, then carried columns.

    The component is the smallest id reachable over links of at most ``bits`` differing bits; a component whose ids
    are all null has a null one. Null and empty texts have fingerprint zero and link like any other. Repeated rows
    are rows of the same component. An empty table gives no rows.
    """
    columns = [doc_id, *(c for c in carry if c != doc_id)]
    plain = docs.select(
        *(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)), F.col(quoted(text)).alias("text")
    )
    marked = written(fingerprints(plain, "text", tuple(f"c{i}" for i in range(len(columns))), "fp", size), "marks")
    marks = written(marked.groupBy("fp").agg(F.min("c0").alias("least")), "distinct-marks")
    joined = written(links(marks, bits, block_rows), "forest")
    member = components(joined)
    classes = (
        member.join(marks.withColumnRenamed("fp", "node"), "node")
        .groupBy("component")
        .agg(F.min("least").alias("component_id"))
        .join(member, "component")
        .select(F.col("node").alias("fp"), "component_id")
    )
    of_mark = marks.join(classes, "fp", "left").select(
        "fp", F.coalesce("component_id", "least").alias("component_id")
    )
    result = marked.join(of_mark, "fp", "left").select(
        F.col("c0").alias("doc_id"),
        F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"),
        "component_id",
        *(F.col(f"c{i}") for i in range(1, len(columns))),
    )
    return result.toDF("doc_id", "fingerprint", "component_id", *columns[1:])
