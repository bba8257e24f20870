"""Best-fit packing by the configuration linear program.

A sequence of ``LIMIT`` tokens that is filled by some multiset of piece lengths is a configuration. The program asks
for the fewest configurations that cover the histogram of lengths. It has too many columns to write down, so they are
priced: every length has a weight, a knapsack dynamic program finds the configuration of largest weight, it is used
until a length in it is covered, and the weights of the lengths that it covered shrink by a factor (multiplicative
weights). Rounding keeps whole uses, and packs what they leave over best-fit, a length at a time.

The program sees the histogram only (at most ``LIMIT`` numbers), so it is the same work for any number of documents.
Pieces never move through the driver: each is numbered among those of its length, and the plan says which number goes
where.
"""

from __future__ import annotations

import base64
import os
import zlib
from array import array
from bisect import bisect_left, insort
from collections.abc import Iterator
from itertools import product

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gramledger.llm.common import cut, quoted, written

LIMIT = 1024
END = 2
#: How fast the weight of a length falls as it is covered; steps between two bounds; the share of a sequence that a
#: configuration may leave empty is one over ROOM; the shares of fractional uses that roundings keep.
RATE = 0.1
BOUNDS = 64
ROOM = 32
SHARES = (1.0, 0.9, 0.75, 0.5, 0.25, 0.0)

# Classes of characters below 0x250, as the tokenizer's pattern tells them apart.
_PLAIN = 0x250
_LETTER, _DIGIT, _SPACE, _OTHER, _BETWEEN = 1, 2, 3, 4, 0


def _classes() -> np.ndarray:
    import unicodedata

    kinds = np.full(_PLAIN, _OTHER, np.uint8)
    for c in range(_PLAIN):
        if chr(c).isspace() and not 0x1C <= c <= 0x1F:
            kinds[c] = _SPACE
        elif unicodedata.category(chr(c))[0] in "LN":
            kinds[c] = _LETTER if unicodedata.category(chr(c))[0] == "L" else _DIGIT
    return kinds


class _Known(dict):
    """Ids of the cuts seen so far, ``most`` at most; what is not among them is encoded when asked for."""

    def __init__(self, encode, most: int):
        super().__init__()
        self.encode, self.most = encode, most

    def __missing__(self, cut: str) -> bytes:
        ids = self.encode(cut)
        if len(self) < self.most:
            self[cut] = ids
        return ids


class Encoder:
    """Token ids of whole texts, as little-endian 32-bit bytes.

    With ``ranks``, a file of the same vocabulary as byte ranks, new cuts are encoded by that faster form of it.
    The tokenizer cuts a text by a fixed pattern and encodes each cut by itself, so equal cuts are encoded once. The
    pattern is applied to whole arrays for texts of Latin characters without apostrophes; all other texts are given
    to the tokenizer as they are.
    """

    def __init__(self, path: str, ranks: str | None = None, most: int = 700_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.ranked = None
        if ranks:
            import tiktoken

            with open(ranks, "rb") as lines:  # a file of this machine, like the tokenizer's
                known = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            # cuts are encoded one by one, so the pattern takes each whole
            self.ranked = tiktoken.Encoding("cuts", pat_str=r"(?s:.+)", mergeable_ranks=known, special_tokens={})

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True  # their names in a text are ordinary text
        self.kinds = _classes()
        self.known = _Known(self._cut, most)

    def _cut(self, text: str) -> bytes:
        if self.ranked:
            return array("I", self.ranked.encode_ordinary(text)).tobytes()
        return self._encode([text])[0]

    def _encode(self, texts: list[str]) -> list[bytes]:
        done = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in done]

    def __call__(self, texts: list[str]) -> list[bytes]:
        out = [b""] * len(texts)
        code = [np.frombuffer(t.encode("utf-32-le"), np.uint32) for t in texts]
        odd = [i for i, (t, c) in enumerate(zip(texts, code)) if "'" in t or (len(c) and c.max() >= _PLAIN)]
        for i, ids in zip(odd, self._encode([texts[i] for i in odd])):
            out[i] = ids
        skip = set(odd)
        rest = [i for i in range(len(texts)) if i not in skip and texts[i]]
        if not rest:
            return out
        whole = "\0".join([*(texts[i] for i in rest), ""])
        sizes = np.fromiter((len(code[i]) for i in rest), np.int64, len(rest)) + 1
        ends = np.cumsum(sizes) - 1
        points = np.frombuffer(whole.encode("utf-32-le"), np.uint32)
        kind = self.kinds[points]
        kind[ends] = _BETWEEN
        start = np.flatnonzero(np.diff(kind, prepend=255))  # of runs of one class
        before = points[start - 1] == 32  # of the first run: the last character, which is no space
        space = kind[start] == _SPACE
        after = np.append(start[1:], len(kind))
        whole_run = kind[np.minimum(after, len(kind) - 1)] == _BETWEEN
        begins = np.zeros(len(kind), bool)
        begins[start[space]] = True  # white space, without its last character if a word follows
        begins[after[space & ~whole_run] - 1] = True
        begins[start[~space & (kind[start] != _BETWEEN) & ~(before & (start > 0))]] = True
        begins[ends] = True
        first = np.flatnonzero(begins)
        last = np.append(first[1:], len(kind))
        real = kind[first] != _BETWEEN
        cuts = [whole[a:b] for a, b in zip(first[real].tolist(), last[real].tolist())]
        found = self.known.__getitem__
        edges = np.searchsorted(first[real], np.concatenate(([0], ends))).tolist()
        for i, a, b in zip(rest, edges, edges[1:]):
            out[i] = b"".join(map(found, cuts[a:b]))
        return out


def pieces(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    limit: int = LIMIT,
) -> DataFrame:
    """One row per piece: what it is, and its number among the pieces of its length in its task."""
    kind = docs.select(quoted(doc_id)).schema[0].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Encoder(tokenizer, ranks)
        task = TaskContext.get().partitionId()
        seen = np.zeros(limit + 1, np.int64)
        end = np.array([END], "<u4").tobytes()
        for batch in batches:
            for part in cut(batch, 1):
                owner, number, start, length, crc = [], [], [], [], []
                for i, ids in enumerate(encode([t or "" for t in part.column(1).to_pylist()])):
                    ids += end
                    n = len(ids) // 4
                    at = 0
                    size = n % limit or limit
                    for k in range(-(-n // limit)):
                        owner.append(i)
                        number.append(k)
                        start.append(at)
                        length.append(size)
                        crc.append(zlib.crc32(ids[4 * at : 4 * (at + size)]))
                        at, size = at + size, limit
                size = np.array(length, np.int64)
                order = np.argsort(size, kind="stable")
                ranked = size[order]
                rank = np.empty(len(size), np.int64)
                rank[order] = np.arange(len(size)) - np.searchsorted(ranked, ranked) + seen[ranked]
                seen += np.bincount(size, minlength=limit + 1)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column(0).take(pa.array(owner, pa.int64())),
                        pa.array(number, pa.int32()),
                        pa.array(start, pa.int64()),
                        pa.array(size),
                        pa.array(crc, pa.int64()),
                        pa.array(np.full(len(size), task, np.int64)),
                        pa.array(rank),
                    ],
                    ["id", "piece", "start", "length", "crc", "task", "rank"],
                )

    schema = f"id {kind}, piece int, start long, length long, crc long, task long, rank long"
    frame = docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("text"))
    return frame.mapInArrow(run, schema)


def knapsack(value: np.ndarray, most: np.ndarray, limit: int) -> np.ndarray:
    """The multiset of lengths of largest value that fits, as a count per length; ``most[n]`` of length n at most.

    Counts are taken in powers of two, so a length is a few items. Of equal values the one with long pieces wins:
    what is left then is short, and easy to place.
    """
    best = np.zeros(limit + 1)
    items = []
    for n in np.flatnonzero(most).tolist():
        left, k = min(int(most[n]), limit // n), 1
        while left:
            k = min(k, left)
            left -= k
            total = best[: limit + 1 - n * k] + value[n] * k
            taken = total >= best[n * k :] * (1 - 1e-12)
            np.copyto(best[n * k :], total, where=taken)
            items.append((n, k, taken))
            k *= 2
    count = np.zeros(limit + 1, np.int64)
    room = limit
    for n, k, taken in reversed(items):
        if room >= n * k and taken[room - n * k]:
            count[n] += k
            room -= n * k
    return count


def configurations(histogram: np.ndarray, limit: int = LIMIT) -> tuple[list[tuple[np.ndarray, float]], float]:
    """Configurations with how often the fractional solution uses them, and a bound on the number of sequences.

    ``histogram[n]``: pieces of length n. A length's price is its length times a weight that falls by a factor as the
    length is covered. The dearest configuration is used until a length in it is covered; if it leaves room, the
    fullest one is. Pricing stops when even that leaves more than a ``ROOM``-th of a sequence; what is uncovered then
    is for the rounding.

    Any prices give a bound: all pieces together cost no more than the dearest configuration does per sequence. The
    bound is the largest one that the prices of the steps, and a price of one for lengths above half, give.
    """
    lengths = np.arange(limit + 1)
    left = histogram.astype(float)
    weight = np.ones(limit + 1)
    use: dict[bytes, float] = {}
    bound = float(histogram[limit // 2 + 1 :].sum())
    step = 0
    while left.any():
        price = weight * lengths
        if step % BOUNDS == 0:
            dearest = price @ knapsack(price, histogram, limit)
            bound = max(bound, price @ histogram / dearest)
        step += 1
        open_ = np.ceil(left - 1e-9).astype(np.int64)
        config = knapsack(price, open_, limit)
        if config @ lengths < limit:
            config = knapsack(lengths.astype(float), open_, limit)
            if config @ lengths < limit - limit // ROOM:
                break
        some = config > 0
        amount = (left[some] / config[some]).min()
        use[config.tobytes()] = use.get(config.tobytes(), 0.0) + amount
        left[some] -= amount * config[some]
        left[left < 1e-6] = 0.0
        weight[some] *= np.exp(-RATE * amount * config[some] / histogram[some])
        weight /= weight.max()
    return [(np.frombuffer(k, np.int64), v) for k, v in use.items()], bound


def best_fit(histogram: np.ndarray, limit: int = LIMIT) -> list[tuple[np.ndarray, int]]:
    """Best fit, longest first, of whole lengths at a time: configurations and how often each is used.

    Equal bins are one entry, so the work depends on the number of lengths and not of pieces.
    """
    bins: list[tuple[int, int, dict[int, int]]] = []  # space, how many, content; by space
    for n in np.flatnonzero(histogram)[::-1].tolist():
        count = int(histogram[n])
        k = bisect_left(bins, n, key=lambda b: b[0])
        grown = []
        while count and k < len(bins):
            space, many, content = bins.pop(k)
            per = space // n  # the tightest bin takes all it can before the next
            full = min(many, count // per)
            if full:
                grown.append((space - per * n, full, {**content, n: per}))
            count -= full * per
            rest = many - full
            if rest and count:
                grown.append((space - count * n, 1, {**content, n: count}))
                rest, count = rest - 1, 0
            if rest:
                grown.append((space, rest, content))
        per = limit // n
        if count // per:
            grown.append((limit - per * n, count // per, {n: per}))
        if count % per:
            grown.append((limit - count % per * n, 1, {n: count % per}))
        for entry in grown:
            insort(bins, entry, key=lambda b: b[0])
    out = []
    for _, many, content in bins:
        config = np.zeros(limit + 1, np.int64)
        config[list(content)] = list(content.values())
        out.append((config, many))
    return out


def rounded(histogram: np.ndarray, limit: int = LIMIT) -> list[tuple[np.ndarray, int]]:
    """Whole uses of configurations that hold every piece: the fewest of several roundings.

    A rounding keeps the whole part of a share of each fractional use, of all configurations or of those that leave no
    room, and packs the rest best-fit. The last share is none at all: where lengths spread so evenly that no program beats best-fit, as may happen with pieces that are
    uniform over all lengths, its sequences are taken.
    """
    columns, _ = configurations(histogram, limit)
    best: list[tuple[np.ndarray, int]] = []
    lengths = np.arange(limit + 1)
    full = [(config, amount) for config, amount in columns if config @ lengths == limit]
    for share, kept in product(SHARES, (full, columns)):
        left = histogram.astype(np.int64).copy()
        made = []
        for config, amount in kept:
            some = config > 0
            times = min(int(share * amount + 1e-6), int((left[some] // config[some]).min()))
            if times:
                made.append((config, times))
                left -= times * config
        made += best_fit(left, limit)
        if not best or sum(t for _, t in made) < sum(t for _, t in best):
            best = made
    return best


def plan(histogram: np.ndarray, limit: int = LIMIT) -> dict[str, np.ndarray]:
    """Slots: for each length, which numbers go to which sequences at which place.

    Columns: length, first number, numbers per sequence, first sequence, place of the first; sorted by the first two.
    """
    rows: list[tuple[int, int, int, int, int]] = []
    given = np.zeros(limit + 1, np.int64)
    sequences = 0
    full = np.zeros(limit + 1, np.int64)
    full[limit] = 1
    rest = histogram.astype(np.int64).copy()
    rest[limit] = 0
    whole = [(full, int(histogram[limit]))] if histogram[limit] else []
    for config, times in whole + rounded(rest, limit):
        at = 0
        for n in np.flatnonzero(config)[::-1].tolist():
            per = int(config[n])
            rows.append((n, int(given[n]), per, sequences, at))
            given[n] += times * per
            at += n * per
        sequences += times
    table = np.array(sorted(rows), np.int64).reshape(-1, 5)
    return dict(zip(("length", "first", "per", "sequence", "offset"), table.T))


def pack(
    docs: DataFrame,
    tokenizer: str,
    ranks: str | None = None,
    text: str = "text",
    doc_id: str = "doc_id",
    limit: int = LIMIT,
) -> DataFrame:
    """Pieces of all documents with the sequence and the place each gets.

    Null and empty texts are the end token alone. Texts longer than ``limit`` tokens are cut into pieces of that
    length; the first may be shorter. Repeated rows are packed each for itself. An empty table gives no rows.
    """
    made = written(pieces(docs, tokenizer, ranks, text, doc_id, limit), "pieces")
    counts = written(made.groupBy("task", "length").agg(F.count(F.lit(1)).alias("n")), "lengths")
    histogram = np.zeros(limit + 1, np.int64)
    for row in counts.groupBy("length").agg(F.sum("n").alias("n")).collect():  # at most ``limit`` rows
        histogram[row["length"]] = row["n"]
    slots = docs.sparkSession.sparkContext.broadcast(plan(histogram, limit))  # its size depends on ``limit`` only

    before = Window.partitionBy("length").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    offsets = counts.select("task", "length", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("before"))

    def put(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = slots.value
        if table["length"].size:
            most = int(max(histogram.max(), 1)).bit_length()
            key = (table["length"] << most) + table["first"]
        for batch in batches:
            length, number = (batch.column(i).to_numpy(zero_copy_only=False) for i in (3, 5))
            at = np.searchsorted(key, (length << most) + number, side="right") - 1
            which = number - table["first"][at]
            per = table["per"][at]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:5],
                    pa.array(table["sequence"][at] + which // per),
                    pa.array(table["offset"][at] + which % per * length),
                ],
                ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"],
            )

    numbered = made.join(offsets, ["task", "length"]).select(
        "id", "piece", "start", "length", "crc", (F.col("before") + F.col("rank")).alias("number")
    )
    kind = made.schema["id"].dataType.simpleString()
    return numbered.mapInArrow(
        put,
        f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long",
    )
