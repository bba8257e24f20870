"""Benchmark decontamination by winnowing.

Both sides hash every run of ``GRAM`` words and keep, in every window of ``SPAN - GRAM + 1`` consecutive hashes, the
smallest. Two texts that share ``SPAN`` words share such a window and so its smallest hash: no shared span is missed.
Where a document's kept hash is one of the benchmark's, it is extended: every ``SPAN``-word window of the document that
holds it is looked up, word for word, among the windows of the items. An item of fewer than ``SPAN`` words is one
window; runs of its own length are looked up instead (a window of one hash).

The benchmark is taken in blocks of about ``BLOCK_BYTES`` of text, so what each task holds is bounded whatever its
size; each block is one pass over the documents, which stay where they are.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.llm.common import as_bytes, cut, joined, mixed, quoted, sums, word_keys, word_table, written

SPAN = 13
GRAM = 5
#: Text of the benchmark that is held in a task at once. A longer item is a block of its own.
BLOCK_BYTES = 16 << 20

#: Digits, lower-case letters and all bytes beyond ASCII.
WORD = word_table([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_FACTOR = mixed(np.arange(1, SPAN + 1, dtype=np.uint64)) | np.uint64(1)
_LAST = np.uint64(2**64 - 1)


class Words:
    """The words of several texts, by position in one array; ``first`` and ``count`` give each text's share."""

    def __init__(self, texts: list[bytes]):
        buffer, at = joined(texts)
        self.raw = buffer.tobytes().lower()
        self.starts, self.ends, self.keys = word_keys(np.frombuffer(self.raw, np.uint8), WORD)
        self.first = np.searchsorted(self.starts, at)
        self.count = np.diff(np.append(self.first, len(self.starts)))
        self.last = np.repeat(self.first + self.count, self.count)  # for each word, the end of its text

    def hashes(self, size: int, at: np.ndarray | None = None) -> np.ndarray:
        """Hash of the ``size`` words from each position (or from those of ``at``); the largest value if too few."""
        n = max(0, len(self.keys) - size + 1)
        if at is None:
            total = np.full(len(self.keys), _LAST)
            value = np.zeros(n, np.uint64)
            for k in range(size):
                value += self.keys[k : k + n] * _FACTOR[k]
            total[:n] = mixed(value) >> np.uint64(1)
            total[np.arange(len(total)) + size > self.last] = _LAST
            return total
        value = np.zeros(len(at), np.uint64)
        for k in range(size):
            value += self.keys[at + k] * _FACTOR[k]
        return mixed(value) >> np.uint64(1)

    def text(self, at: int, size: int) -> bytes:
        return b" ".join(
            self.raw[a:b] for a, b in zip(self.starts[at : at + size].tolist(), self.ends[at : at + size].tolist())
        )

    def winnowed(self) -> tuple[np.ndarray, np.ndarray]:
        """Positions and values of the hashes that are smallest in some window."""
        width = SPAN - GRAM + 1
        value = self.hashes(GRAM)
        if len(value) < width:
            return np.zeros(0, np.int64), np.zeros(0, np.uint64)
        least = value[: len(value) - width + 1].copy()
        for k in range(1, width):
            np.minimum(least, value[k : len(value) - width + 1 + k], out=least)
        whole = np.arange(len(least)) + SPAN <= self.last[: len(least)]
        least[~whole] = 0
        most = np.zeros(len(value), np.uint64)
        for k in range(width):
            np.maximum(most[k : k + len(least)], least, out=most[k : k + len(least)])
        at = np.flatnonzero((most == value) & (value != _LAST))
        return at, value[at]


class Block:
    """Windows of some items: their hashes by length, their words, the items that hold them, the kept hashes."""

    def __init__(self, items: list[tuple[str, bytes]]):
        words = Words([t for _, t in items])
        found: dict[bytes, set[str]] = {}
        hashes: dict[int, set[int]] = {}
        for (name, _), first, count in zip(items, words.first.tolist(), words.count.tolist()):
            size = min(SPAN, count)
            if not size:
                continue
            at = np.arange(first, first + count - size + 1)
            hashes.setdefault(size, set()).update(words.hashes(size, at).tolist())
            for k in at.tolist():
                found.setdefault(words.text(k, size), set()).add(name)
        self.items = found
        self.hashes = {n: np.array(sorted(h), np.uint64) for n, h in hashes.items()}
        self.kept = np.unique(words.winnowed()[1])


def _among(values: np.ndarray, known: np.ndarray) -> np.ndarray:
    if not len(known) or not len(values):
        return np.zeros(len(values), bool)
    coarse = np.zeros(1 << 18, bool)
    coarse[known >> np.uint64(45)] = True
    hit = coarse[np.minimum(values >> np.uint64(45), np.uint64((1 << 18) - 1))] & (values != _LAST)
    some = values[hit]
    hit[hit] = known[np.minimum(np.searchsorted(known, some), len(known) - 1)] == some
    return hit


def find(words: Words, block: Block) -> tuple[np.ndarray, dict[int, set[str]]]:
    """Words hit by a window of the block, and for each text the items whose windows occur in it."""
    delta = np.zeros(len(words.keys) + 1, np.int64)
    items: dict[int, set[str]] = {}
    for size, known in block.hashes.items():
        if size == SPAN:
            at, value = words.winnowed()
            near = (at[_among(value, block.kept)][:, None] - np.arange(SPAN - GRAM + 1)).ravel()
            near = np.unique(near[near >= 0])
            near = near[near + SPAN <= words.last[near]]
            near = near[_among(words.hashes(SPAN, near), known)]
        else:
            near = np.flatnonzero(_among(words.hashes(size), known))
        owner = np.searchsorted(words.first + words.count, near, side="right")
        for k, text in zip(near.tolist(), owner.tolist()):
            names = block.items.get(words.text(k, size))
            if names:
                delta[k] += 1
                delta[k + size] -= 1
                items.setdefault(text, set()).update(names)
    return np.cumsum(delta[:-1]) > 0, items


def _blocks(benchmark: DataFrame, item: str, text: str) -> Iterator[list[tuple[str, bytes]]]:
    """Items in blocks that the driver can hold; repeated rows once, a null id as the empty one."""
    items = benchmark.select(
        F.coalesce(F.col(quoted(item)).cast("string"), F.lit("")).alias("item"), F.col(quoted(text)).alias("text")
    ).where(F.octet_length("text") > 0)
    size = items.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    parts = -(-size // BLOCK_BYTES)
    for k in range(parts):
        rows = items.where(F.pmod(F.xxhash64("item", "text"), F.lit(parts)) == k).distinct().collect()
        yield [(r["item"], r["text"].encode()) for r in rows]


def contamination(
    docs: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    item: str = "item_id",
    item_text: str = "text",
    names: tuple[str, ...] = ("n_words", "n_hit", "n_items", "items_sha256", "contaminated"),
) -> DataFrame:
    """Carried columns with the number of words, of words hit, of items found, a digest of those items' ids
    (sorted as strings, comma-joined), and whether a twentieth of the words or more is hit.

    A null or empty text has no words and is clean. Without benchmark items nothing is hit. Repeated documents get
    equal results; repeated items count once per id.
    """
    spark = docs.sparkSession
    n = len(carry)
    frame = docs.select(
        *(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(carry)),
        F.col(quoted(text)).alias("text"),
        F.array().cast("array<long>").alias("hit"),
        F.array().cast("array<string>").alias("items"),
    )
    kinds = ", ".join(f"c{i} {frame.schema[i].dataType.simpleString()}" for i in range(n))
    blocks = _blocks(benchmark, item, item_text)
    held: list[tuple[str, bytes]] = next(blocks, [])
    while True:
        following = next(blocks, None)
        shared = spark.sparkContext.broadcast(vars(Block(held)))  # bounded by BLOCK_BYTES
        if following is None:
            break
        frame = written(_scan(frame, shared, f"{kinds}, text string, hit array<long>, items array<string>", n, False), "windows")
        held = following
    result = _scan(frame, shared, f"{kinds}, r0 long, r1 long, r2 long, r3 string, r4 boolean", n, True)
    return result.toDF(*carry, *names)


def _scan(frame: DataFrame, shared, schema: str, n: int, final: bool) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = Block.__new__(Block)
        block.__dict__.update(shared.value)
        for batch in batches:
            for part in cut(batch, n):
                words = Words(as_bytes(part.column(n)))
                hit, items = find(words, block)
                # words hit in earlier blocks, as positions in their text
                before = part.column(n + 1)
                where = np.repeat(words.first, before.value_lengths().to_numpy(zero_copy_only=False))
                hit[where + before.flatten().to_numpy(zero_copy_only=False)] = True
                names = [sorted(items.get(k, set()).union(b)) for k, b in enumerate(part.column(n + 2).to_pylist())]
                kept = part.columns[:n]
                if final:
                    total = sums(hit.astype(np.int64), words.first, words.count)
                    digest = [hashlib.sha256(",".join(x).encode()).hexdigest() for x in names]
                    new = [
                        pa.array(words.count),
                        pa.array(total),
                        pa.array([len(x) for x in names], pa.int64()),
                        pa.array(digest),
                        pa.array((total > 0) & (20 * total >= words.count)),
                    ]
                    columns = [*kept, *new]
                else:
                    at = np.flatnonzero(hit)
                    owner = np.searchsorted(words.first + words.count, at, side="right")
                    cuts = np.searchsorted(owner, np.arange(len(words.first) + 1)).astype(np.int32)
                    spans = pa.ListArray.from_arrays(pa.array(cuts), pa.array(at - words.first[owner]))
                    columns = [*kept, part.column(n), spans, pa.array(names, pa.list_(pa.string()))]
                labels = [f"c{i}" for i in range(n)]
                labels += [f"r{i}" for i in range(5)] if final else ["text", "hit", "items"]
                yield pa.RecordBatch.from_arrays(columns, labels)

    return frame.mapInArrow(run, schema)
