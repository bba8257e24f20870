"""Removal of repeated passages by prefix-free parsing.

Every text is cut into phrases where a rolling hash of ``WINDOW`` bytes is smallest among the :func:`reach` positions on
either side, so a cut depends on the bytes around it only and equal passages are cut alike. The suffixes of the corpus
are then ordered without being compared byte by byte: a suffix is the rest of its phrase (a suffix of the dictionary)
followed by phrases (a suffix of the parse). Two suffixes agree in their first ``span`` bytes if and only if they agree
in the rest of a phrase, in the whole phrases after it, and in the beginning of the last one. Only the classes of equal
``span``-byte beginnings matter, not which class comes first, so the classes of dictionary and parse are found by
counting keys, which combines before the shuffle and splits hot ones, where sorting would bring a class together:

1. dictionary: phrases that occur once in the corpus. A passage that holds one of them whole occurs once too.
2. parse: runs of starts whose ``span`` bytes touch the same phrases. If these phrases occur elsewhere in the same
   order, every start of the run is repeated. If not even the phrases that lie whole in the passage do, none is.
3. dictionary again: starts still open, at the ends of repeated passages, are told apart by their own ``span`` bytes.
   One place of every class that step 2 found repeated takes part where it holds the phrases of an open start.

Each step hands on only what is open. A text is known by a 128-bit key of its bytes, because equal texts have equal
results; copies of a text count as different places. Keys of phrase sequences have 128 bits, those of passages 96.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramledger.llm.common import as_bytes, cut, discard, mixed, quoted, written

SPAN = 400
WINDOW = 16
REACH = 32

#: Bytes of a stretch of repeated phrases that is told.
STRETCH = 128

_A = np.uint64(0x9E3779B97F4A7C15)
_B = np.uint64(0xC2B2AE3D27D4EB4F)


def reach(span: int) -> int:
    """Positions on either side of a cut: ``REACH`` of them for passages of ``SPAN`` bytes, fewer for shorter ones."""
    return max(4, min(REACH, REACH * span // SPAN))


def phrase_starts(text: bytes, span: int = SPAN) -> np.ndarray:
    """Where phrases begin, and the end of the text. A text below ``span`` bytes is one phrase."""
    n, near = len(text), reach(span)
    m = n - WINDOW + 1
    if n < span or m < 2 * near + 1:
        return np.array([0, n], np.int64)
    words = np.ndarray((n - 7,), "<u8", text, strides=(1,))
    value = words[:m] * _A
    value ^= value >> np.uint64(29)
    value += words[8:] * _B
    value = (mixed(value) >> np.uint64(32)).astype(np.uint32)
    least, size = value, 1
    while size < near:  # smallest of near neighbours, by doubling
        step = min(size, near - size)
        least = np.minimum(least[: len(least) - step], least[step:])
        size += step
    here = value[near : m - near]
    count = len(here)
    smallest = (here < least[:count]) & (here <= least[near + 1 : near + 1 + count])
    return np.concatenate(([0], np.flatnonzero(smallest) + near, [n]))


def _key(data: bytes) -> bytes:
    return xxhash.xxh3_128_digest(data)


def parse(docs: DataFrame, span: int) -> DataFrame:
    """(k1, k2, cuts, phrases) for every text of ``span`` bytes or more: its key, cuts and 64-bit phrase keys."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch, 2):
                cuts, phrases, sizes = [], [], []
                for text in as_bytes(part.column(2)):
                    at = phrase_starts(text, span)
                    ends = at.tolist()
                    cuts.append(at)
                    phrases += [xxhash.xxh3_64_digest(text[a:b]) for a, b in zip(ends, ends[1:])]
                    sizes.append(len(ends))
                total = np.concatenate(([0], np.cumsum(sizes))).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0),
                        part.column(1),
                        pa.ListArray.from_arrays(pa.array(total), pa.array(np.concatenate(cuts).astype(np.int32))),
                        pa.ListArray.from_arrays(
                            pa.array((total - np.arange(len(total))).astype(np.int32)),
                            pa.array(np.frombuffer(b"".join(phrases), "<i8")),
                        ),
                    ],
                    ["k1", "k2", "cuts", "phrases"],
                )

    long_enough = docs.where(F.octet_length("text") >= span).select("k1", "k2", "text")
    return long_enough.mapInArrow(run, "k1 long, k2 long, cuts array<int>, phrases array<long>")


def _split(n: int, span: int, *edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts of passages in a text of ``n`` bytes, cut at the edges: first and end of each run."""
    first = np.unique(np.concatenate(([0], *edges)))
    first = first[(first >= 0) & (first <= n - span)]
    return first, np.append(first[1:], n - span + 1)


def _runs(at: np.ndarray, unique: np.ndarray, span: int) -> tuple[tuple, tuple]:
    """Runs of starts that may be repeated, for the cuts ``at`` and the phrases known to be unique.

    First those that touch the same phrases: first, end, first phrase, last phrase. Then those that hold the same
    phrases for certain: first, end, first phrase, last phrase (exclusive). A cut is certain if all bytes it depends
    on lie in the passage; so equal passages hold equal phrases.
    """
    n = int(at[-1])
    once = np.zeros(len(at) + 1, np.int64)
    once[unique + 1] = 1
    once = np.cumsum(once)
    low = reach(span)
    high = span - low - WINDOW

    def held(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        inner = np.searchsorted(at, last + low, side="left")
        return inner, np.maximum(inner, np.searchsorted(at, first + high, side="right") - 1)

    first, end = _split(n, span, at, at - span + 1)
    left = np.searchsorted(at, first, side="right") - 1
    right = np.searchsorted(at, first + span, side="left") - 1
    inner, outer = held(first, end - 1)
    open_ = once[outer] == once[inner]
    touched = tuple(x[open_] for x in (first, end, left, right))
    first, end = _split(n, span, at - low + 1, at - high)
    inner, outer = held(first, first)
    open_ = once[outer] == once[inner]
    return touched, tuple(x[open_] for x in (first, end, inner, outer))


class Runs:
    """The open runs of one text, and the keys of the phrases they touch and of those they hold."""

    def __init__(self, cuts: pa.Scalar, phrases: pa.Scalar, unique: pa.Scalar, span: int):
        at = cuts.values.to_numpy().astype(np.int64)
        listed = unique.values
        once = np.zeros(0, np.int64) if listed is None else listed.to_numpy().astype(np.int64)
        self.touched, self.held = _runs(at, once, span)
        self.starts = max(0, int(at[-1]) - span + 1)
        self.whole = self.held[3] > self.held[2]  # some phrase is held whole
        self._raw = phrases.values.to_numpy()

    def _keys(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        raw = self._raw.tobytes()
        keys = [_key(raw[a:b]) for a, b in zip((8 * first).tolist(), (8 * last).tolist())]
        return np.frombuffer(b"".join(keys), "<i8").reshape(-1, 2)

    def touched_keys(self) -> np.ndarray:
        return self._keys(self.touched[2], self.touched[3] + 1)

    def held_keys(self, which: np.ndarray) -> np.ndarray:
        return self._keys(self.held[2][which], self.held[3][which])


def _rows(names: list[str], *columns: object) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(np.ascontiguousarray(c)) for c in columns], names)


def _classes(found: DataFrame, span: int) -> DataFrame:
    """(kind, h1, h2, n, tid, first, end): the classes of runs that touch (kind 0) or hold (kind 1) the same phrases,
    with the number of runs, the smallest text, and, where there is one run only, its starts.

    Runs are counted before the shuffle, so a hot class costs a row per task.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                runs = Runs(batch.column(1)[i], batch.column(2)[i], batch.column(3)[i], span)
                keys = np.concatenate((runs.touched_keys(), runs.held_keys(runs.whole)))
                if not len(keys):
                    continue
                kind = np.repeat(np.array([0, 1], np.int8), [len(runs.touched[0]), int(runs.whole.sum())])
                yield _rows(
                    ["kind", "h1", "h2", "tid", "first", "end"],
                    kind,
                    keys[:, 0],
                    keys[:, 1],
                    np.full(len(keys), batch.column(0)[i].as_py()),
                    np.concatenate((runs.touched[0], runs.held[0][runs.whole])).astype(np.int32),
                    np.concatenate((runs.touched[1], runs.held[1][runs.whole])).astype(np.int32),
                )

    rows = found.select("tid", "cuts", "phrases", "unique").mapInArrow(
        run, "kind byte, h1 long, h2 long, tid long, first int, end int"
    )
    return rows.groupBy("kind", "h1", "h2").agg(
        F.count(F.lit(1)).alias("n"), F.min("tid").alias("tid"), F.min("first").alias("first"), F.min("end").alias("end")
    )


def _facts(classes: DataFrame) -> DataFrame:
    """Per text: ranges of the runs of its own classes of either kind, and the repeated classes it stands for."""
    single, own = F.col("n") == 1, F.array("first", "end")
    return (
        classes.where(single | (F.col("kind") == 0))
        .groupBy("tid")
        .agg(
            F.flatten(F.collect_list(F.when(single & (F.col("kind") == 0), own))).alias("lone"),
            F.flatten(F.collect_list(F.when(single & (F.col("kind") == 1), own))).alias("alone"),
            F.collect_list(F.when(~single, F.col("h1"))).alias("stands"),
        )
    )


def _sorted_out(known: DataFrame, span: int) -> DataFrame:
    """What step 2 says, as rows (tid, what, h1, h2, ranges).

    ``closed``: starts that are repeated for certain; ``open``: starts still to be compared, all of a text; ``core``:
    the key of phrases that an open start holds; ``rep``: starts of a class this text stands for that hold the
    phrases of the key; ``free``: such starts that hold no phrase whole.
    """

    def flat(flags: np.ndarray) -> list[int]:
        return np.flatnonzero(np.diff(flags, prepend=False, append=False)).tolist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tid, what, h1, h2, ranges = [], [], [], [], []
            lists = [batch.column(k).to_pylist() for k in range(4, 7)]
            for i, (lone, alone, stands) in enumerate(zip(*lists)):
                runs = Runs(batch.column(1)[i], batch.column(2)[i], batch.column(3)[i], span)
                n = runs.starts
                once = _starts(lone, n)
                touched = _starts(np.stack(runs.touched[:2], 1), n)
                left = once & _starts(np.stack(runs.held[:2], 1), n) & ~_starts(alone, n)
                out = [("closed", 0, 0, flat(touched & ~once)), ("open", 0, 0, flat(left))]
                rep = np.zeros(n, bool)
                if stands:
                    chosen = np.isin(runs.touched_keys()[:, 0], np.array(stands, np.int64))
                    rep = _starts(np.stack(runs.touched[:2], 1)[chosen], n) & ~once
                a, b = runs.held[:2]
                sums_left, sums_rep = (np.concatenate(([0], np.cumsum(f))) for f in (left, rep))
                some_left, some_rep = sums_left[b] > sums_left[a], sums_rep[b] > sums_rep[a]
                which = np.flatnonzero((some_left | some_rep) & runs.whole)
                for j, key in zip(which.tolist(), runs.held_keys(which).tolist()):
                    if some_left[j]:
                        out.append(("core", *key, []))
                    if some_rep[j]:
                        out.append(("rep", *key, [int(a[j]) + x for x in flat(rep[a[j] : b[j]])]))
                for j in np.flatnonzero(some_rep & ~runs.whole).tolist():
                    out.append(("free", 0, 0, [int(a[j]) + x for x in flat(rep[a[j] : b[j]])]))
                for w, x, y, r in out:
                    if r or w == "core":
                        tid.append(batch.column(0)[i].as_py())
                        what.append(w)
                        h1.append(x)
                        h2.append(y)
                        ranges.append(r)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(tid, pa.int64()),
                    pa.array(what, pa.string()),
                    pa.array(h1, pa.int64()),
                    pa.array(h2, pa.int64()),
                    pa.array(ranges, pa.list_(pa.int32())),
                ],
                ["tid", "what", "h1", "h2", "ranges"],
            )

    plain = known.select("tid", "cuts", "phrases", "unique", "lone", "alone", "stands")
    return plain.mapInArrow(run, "tid long, what string, h1 long, h2 long, ranges array<int>")


def _starts(lists: list | np.ndarray | None, n: int) -> np.ndarray:
    """Flags of the starts in ranges given as flat (first, end) numbers."""
    delta = np.zeros(n + 1, np.int32)
    if lists is not None and len(lists):
        pairs = np.array(lists, np.int64).reshape(-1, 2)
        np.add.at(delta, pairs[:, 0], 1)
        np.add.at(delta, pairs[:, 1], -1)
    return np.cumsum(delta[:-1]) > 0


def remove_repeats(
    docs: DataFrame,
    text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    span: int = SPAN,
    kept_text: str | None = None,
    names: tuple[str, str, str, str] = ("n_bytes", "n_removed", "n_spans", "kept_sha256"),
    longest: str | None = None,
) -> DataFrame:
    """Carried columns, then bytes, removed bytes, maximal removed runs and the digest of what is left.

    A byte goes if a ``span``-byte string that covers it also starts elsewhere, in the same text or another. Null and
    empty texts have no bytes. Repeated rows are different places, so texts of ``span`` bytes or more that occur
    twice go whole. With ``kept_text``, a column of that name holds what is left; a character that lost some of its
    bytes is left out. With ``longest``, a last column of that name tells of shorter repeats too, which stay: the bytes
    of the longest removed run or, if that is more, of the longest stretch of whole phrases that each occur elsewhere,
    in that order or not. A stretch below ``STRETCH`` bytes, as within chance, or in a text below ``span`` is none.
    """
    n = len(carry)
    frame = docs.select(
        *(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(carry)), F.col(quoted(text)).alias("text")
    )
    frame = frame.withColumns({"k1": F.xxhash64("text"), "k2": F.xxhash64(F.lit(span), F.col("text"))})
    parsed = written(parse(frame, span).withColumn("tid", F.monotonically_increasing_id()), "parse")
    # 1. phrases that occur once; the place of such a phrase is its smallest one
    phrases = parsed.select("tid", F.posexplode("phrases").alias("at", "phrase"))
    once = phrases.groupBy("phrase").agg(
        F.count(F.lit(1)).alias("n"), F.min("tid").alias("tid"), F.min("at").alias("at")
    )
    unique = once.where("n = 1").groupBy("tid").agg(F.collect_list("at").alias("unique"))
    found = written(parsed.join(unique, "tid", "left"), "dictionary")
    discard(parsed)
    # 2. classes of runs
    known = found.join(_facts(_classes(found, span)), "tid", "left")
    sorted_out = written(_sorted_out(known, span), "classes")
    cores = sorted_out.where("what = 'core'").select("h1", "h2").distinct()
    rep = sorted_out.where("what = 'rep'").join(cores, ["h1", "h2"], "left_semi")
    compared = (
        sorted_out.where("what IN ('open', 'free')").unionByName(rep).groupBy("tid").agg(
            F.flatten(F.collect_list("ranges")).alias("ranges")
        )
    )
    texts = written(_stretches(found) if longest else found.select("tid", "k1", "k2"), "texts")
    discard(found)
    # 3. the passages themselves
    asked = frame.select("k1", "k2", "text").join(texts.join(compared, "tid"), ["k1", "k2"])
    lonely = (
        _windows(asked.select("tid", "text", "ranges"), span)
        .groupBy("h1", "h2")
        .agg(F.count(F.lit(1)).alias("n"), F.min("tid").alias("tid"), F.min("first").alias("first"))
        .where("n = 1")
        .groupBy("tid")
        .agg(F.collect_list("first").alias("single"))
    )
    closed, open_ = (
        sorted_out.where(F.col("what") == w).select("tid", F.col("ranges").alias(w)) for w in ("closed", "open")
    )
    facts = closed.join(open_, "tid", "full").join(lonely, "tid", "left")
    if longest:
        facts = texts.join(facts, "tid", "left").where("stretch > 0 OR closed IS NOT NULL OR open IS NOT NULL")
    else:
        facts = facts.join(texts, "tid")
    # copies of a text have the same facts
    facts = written(facts.dropDuplicates(["k1", "k2"]).drop("tid"), "facts")
    discard(texts, sorted_out)
    return _cut_out(frame.join(facts, ["k1", "k2"], "left"), n, span, kept_text, carry, names, longest)


def _stretches(found: DataFrame) -> DataFrame:
    """(tid, k1, k2, stretch): bytes between the phrases that occur once, where they are furthest apart."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            longest = np.zeros(batch.num_rows, np.int64)
            for i in range(batch.num_rows):
                at, listed = batch.column(3)[i].values.to_numpy(), batch.column(4)[i].values
                once = np.zeros(0, np.int64) if listed is None else np.sort(listed.to_numpy())
                longest[i] = (np.append(at[once], at[-1]) - np.append(0, at[once + 1])).max()
            longest[longest < STRETCH] = 0
            yield pa.RecordBatch.from_arrays([*batch.columns[:3], pa.array(longest)], ["tid", "k1", "k2", "stretch"])

    plain = found.select("tid", "k1", "k2", "cuts", "unique")
    return plain.mapInArrow(run, "tid long, k1 long, k2 long, stretch long")


def _windows(asked: DataFrame, span: int) -> DataFrame:
    """The key of the passage, in 96 bits, at every start that is compared."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                data = (batch.column(1)[i].as_py() or "").encode()
                starts = np.flatnonzero(_starts(batch.column(2)[i].as_py(), len(data)))
                for k in range(0, len(starts), 1 << 16):
                    at = starts[k : k + (1 << 16)]
                    keys = np.frombuffer(b"".join([_key(data[a : a + span]) for a in at.tolist()]), "<i8")
                    tid = np.full(len(at), batch.column(0)[i].as_py())
                    half = keys[1::2].astype(np.int32)
                    yield _rows(["h1", "h2", "tid", "first"], keys[::2], half, tid, at.astype(np.int32))

    return asked.mapInArrow(run, "h1 long, h2 int, tid long, first int")


def _cut_out(
    frame: DataFrame, n: int, span: int, kept_text: str | None, carry: tuple, names: tuple, longest: str | None
) -> DataFrame:
    fields = [T.StructField(f"c{i}", frame.schema[f"c{i}"].dataType) for i in range(n)]
    kinds = [T.LongType(), T.LongType(), T.LongType(), T.StringType(), *([T.StringType()] if kept_text else [])]
    kinds += [T.LongType()] if longest else []
    fields += [T.StructField(f"r{i}", k) for i, k in enumerate(kinds)]
    lists = ["closed", "open", "single"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch, n):
                sizes, removed, spans, digests, texts, runs = [], [], [], [], [], []
                facts = [part.column(n + 1 + k).to_pylist() for k in range(len(lists))]
                for data, closed, rest, single in zip(as_bytes(part.column(n)), *facts):
                    left, gone, pieces, most = data, 0, 0, 0
                    if closed or rest:
                        size = len(data)
                        flags = _starts(rest, size)
                        if single:
                            flags[np.array(single)] = False
                        flags |= _starts(closed, size)
                        at = np.flatnonzero(flags)
                        delta = np.zeros(size + 1, np.int64)
                        delta[at] += 1
                        delta[at + span] -= 1
                        out = np.cumsum(delta[:-1]) > 0
                        gone = int(out.sum())
                        edges = np.flatnonzero(np.diff(out, prepend=False, append=False))
                        pieces, most = len(edges) // 2, int((edges[1::2] - edges[::2]).max(initial=0))
                        left = np.frombuffer(data, np.uint8)[~out].tobytes()
                    sizes.append(len(data))
                    removed.append(gone)
                    spans.append(pieces)
                    runs.append(most)
                    digests.append(hashlib.sha256(left).hexdigest())
                    if kept_text:
                        texts.append(left.decode("utf-8", "ignore") if gone else data.decode())
                columns = [*part.columns[:n], pa.array(sizes, pa.int64()), pa.array(removed, pa.int64())]
                columns += [pa.array(spans, pa.int64()), pa.array(digests, pa.string())]
                if kept_text:
                    columns.append(pa.array(texts, pa.string()))
                if longest:
                    stretches = part.column(n + 1 + len(lists)).to_numpy(zero_copy_only=False)
                    columns.append(pa.array(np.maximum(stretches, np.array(runs, np.int64))))
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in fields])

    told = [F.coalesce("stretch", F.lit(0).cast("long"))] if longest else []
    plain = frame.select(*(f"c{i}" for i in range(n)), "text", *lists, *told)
    result = plain.mapInArrow(run, T.StructType(fields))
    return result.toDF(*carry, *names, *([kept_text] if kept_text else []), *([longest] if longest else []))
