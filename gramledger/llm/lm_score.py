"""Language-model scoring by logistic context mixing.

A text is predicted bit by bit. For every order from 0 to ``ORDERS - 1`` a hashed context (the last bytes and the bits
of the current byte so far) selects a pair of counts, and so a prediction. The predictions are stretched, weighted and
summed; a gate, made of how much the higher orders have seen, selects the weights. A last stage refines the probability
by what really followed such predictions (an adaptive probability map). Counts, weights and map are those of all training
texts, taken as distinct runs of ``ORDERS`` bytes and how often each occurs: in each of a few rounds, tasks add up the
gradient and curvature of the code length by the weights, and what followed each prediction; the sums give the Newton
step of the whole corpus, and its map. All are frozen before scoring, so the score of a byte depends on nothing but the
bytes before it, and every distinct run of ``ORDERS`` bytes of a chunk is computed once. A text ends with the byte
255, which UTF-8 never holds, so the model gives one distribution over all texts.

Tables of short contexts do not know what the corpus repeats at length. So a second prediction is that of whole phrases,
which end where the last ``ORDERS`` bytes hash to one of few values: how often a phrase occurs in all training texts. Both
are mixed phrase by phrase, in the share in which training phrases occur again. A training text's own occurrence of a phrase
does not count for it, so what is predicted is known from elsewhere.

The base score needs a count for every word of a corpus whose vocabulary grows with it, and the phrases one for every
phrase. Texts go in blocks; a block has a sorted list of its distinct words, split by ranges of the word keys, and such a
list of its phrases. Each range adds up the blocks' counts and sends every block its own back, so neither the vocabulary
nor the phrases nor the texts meet in one place.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramledger.llm.common import (
    SPACES,
    as_bytes,
    cut,
    joined,
    mixed,
    quoted,
    remainder,
    sums,
    word_keys,
    word_table,
    written,
)

ORDERS = 5
#: Slots per order, as a power of two, and slots that travel together.
TABLE_BITS = 19
PIECE = 1 << 12
#: Steps of weights and map over all texts.
ROUNDS = 3
END = b"\xff"
#: What weights and map are before a step counts for: as curvature of each weight, as predictions at each place of the map.
HELD_WEIGHT, HELD_PLACES = 1.0, 64.0
#: Distinct runs of bytes that a task adds up at a time.
ADDED = 1 << 16
#: Blocks per range of word keys, about: what one task adds up is so many blocks' words, however many there are.
RANGE_BLOCKS = 16
LEAST_RANGES, MOST_RANGES = 64, 1 << 16

#: A phrase ends at one place of so many, as a power of two.
PHRASE_BITS = 6
#: Runs that are scrambled at a time.
SCRAMBLED = 1 << 17

#: Bytes of text in a block, and those whose bits are predicted together.
BLOCK_BYTES = 4 << 20
TOGETHER = 2 << 20

WORD = word_table(SPACES)
_GATES = 27
_STEPS = 33


def runs(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte (and the end) of the texts with the bytes before it as one number; and how many per text."""
    before = ORDERS - 1
    buffer, _ = joined(texts, b"\n" * before, END)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    if not len(texts):
        return np.zeros(0, np.uint64), sizes
    value = np.zeros(len(buffer) - before, np.uint64)
    for k in range(ORDERS):
        value = (value << np.uint64(8)) | buffer[k : len(buffer) - before + k]
    keep = np.ones(len(value), bool)
    ends = np.cumsum(sizes + before)[:-1] - before
    keep[(ends[:, None] + np.arange(before)).ravel()] = False
    return value[keep], sizes


def slot(values: np.ndarray, order: int, bit: int) -> np.ndarray:
    """Where the counts for one bit of the last byte are, given ``order`` bytes before it."""
    last = values & np.uint64(255)
    node = (np.uint64(1) << np.uint64(bit)) | (last >> np.uint64(8 - bit))
    context = (values >> np.uint64(8)) & np.uint64((1 << 8 * order) - 1)
    key = (context << np.uint64(8)) | node
    if order <= 1:
        return key.astype(np.int64)  # 256 bytes by 256 nodes fit
    return (mixed(key + np.uint64(order << 56)) >> np.uint64(64 - TABLE_BITS)).astype(np.int64)


def bit_of(values: np.ndarray, bit: int) -> np.ndarray:
    return ((values >> np.uint64(7 - bit)) & np.uint64(1)).astype(np.int64)


def phrases(values: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Where the phrases of texts begin, given the :func:`runs`; their 64-bit keys, and how many each text has.

    A run that goes on as it is ends no phrase. The last phrase of a text holds its end. Equal keys are equal phrases after
    the same ``ORDERS - 1`` bytes.
    """
    begin = np.ones(len(values), bool)
    for a in range(0, len(values) - 1, SCRAMBLED):
        ends = mixed(values[a : a + SCRAMBLED]) >> np.uint64(64 - PHRASE_BITS) == 0
        begin[a + 1 : a + 1 + SCRAMBLED] = ends[: len(values) - 1 - a]
    begin[1:] &= values[1:] != values[:-1]
    first = np.cumsum(sizes) - sizes
    begin[first] = True
    starts = np.flatnonzero(begin)
    if not len(starts):
        return starts, np.zeros(0, np.uint64), sizes
    placed = np.arange(len(values), dtype=np.uint64)
    placed -= np.repeat(starts.astype(np.uint64), np.diff(starts, append=len(values)))
    placed *= np.uint64(0x9E3779B97F4A7C15)
    placed += values
    for a in range(0, len(values), SCRAMBLED):
        placed[a : a + SCRAMBLED] = mixed(placed[a : a + SCRAMBLED])
    keys = np.add.reduceat(placed, starts)
    return starts, keys, np.diff(np.searchsorted(starts, first), append=len(starts))


def distinct_runs(docs: DataFrame) -> DataFrame:
    """(run, n): every distinct run of bytes in ``docs.text``, and how often it occurs. A task adds up a block of text
    before anything moves."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch, 0, BLOCK_BYTES):
                values, n = np.unique(runs(as_bytes(part.column(0)))[0], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(values.astype(np.int64)), pa.array(n)], ["run", "n"])

    found = docs.select("text").mapInArrow(count, "run long, n long")
    return written(found.groupBy("run").agg(F.sum("n").alias("n")), "runs")


def gathered(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Runs and their numbers, about ``ADDED`` at a time."""
    held, rows = [], 0
    for batch in batches:
        held.append(batch)
        rows += batch.num_rows
        if rows >= ADDED:
            table = pa.Table.from_batches(held)
            yield table["run"].to_numpy().astype(np.uint64), table["n"].to_numpy()
            held, rows = [], 0
    if rows:
        table = pa.Table.from_batches(held)
        yield table["run"].to_numpy().astype(np.uint64), table["n"].to_numpy()


def counts(found: DataFrame) -> DataFrame:
    """(order, piece, zeros, ones): counts of all runs of :func:`distinct_runs`, a row per piece of a table.

    A task adds up its runs before anything moves; its tables have a fixed size.
    """
    size = 1 << TABLE_BITS

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tables = np.zeros((ORDERS, 2, size), np.uint64)
        some = False
        for values, n in gathered(batches):
            some = True
            for order in range(ORDERS):
                for bit in range(8):
                    at, ones = slot(values, order, bit), bit_of(values, bit)
                    for b in (0, 1):
                        pick = ones == b
                        tables[order, b] += np.bincount(at[pick], n[pick], size).astype(np.uint64)
        for order in range(ORDERS if some else 0):
            filled = tables[order].any(0).reshape(-1, PIECE).any(1)
            for piece in np.flatnonzero(filled).tolist():
                span = slice(piece * PIECE, (piece + 1) * PIECE)
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array([order], pa.int32()),
                        pa.array([piece], pa.int32()),
                        pa.array([TaskContext.get().partitionId() % 64], pa.int32()),
                        pa.array([tables[order, 0, span].tobytes()], pa.binary()),
                        pa.array([tables[order, 1, span].tobytes()], pa.binary()),
                    ],
                    ["order", "piece", "salt", "zeros", "ones"],
                )

    def add(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((2, PIECE), np.uint64)
        for batch in batches:
            for b, name in enumerate(("zeros", "ones")):
                for raw in batch.column(batch.schema.get_field_index(name)).to_pylist():
                    total[b] += np.frombuffer(raw, np.uint64)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([key[0].as_py()], pa.int32()),
                pa.array([key[1].as_py()], pa.int32()),
                pa.array([total[0].tobytes()], pa.binary()),
                pa.array([total[1].tobytes()], pa.binary()),
            ],
            ["order", "piece", "zeros", "ones"],
        )

    schema = "order int, piece int, zeros binary, ones binary"
    partial = found.mapInArrow(count, "order int, piece int, salt int, zeros binary, ones binary")
    salted = partial.groupBy("order", "piece", "salt").applyInArrow(add, schema)
    return salted.groupBy("order", "piece").applyInArrow(add, schema)


class Mixer:
    """Frozen tables, weights and map."""

    def __init__(self, zeros: np.ndarray, ones: np.ndarray):
        total = zeros + ones
        p = (ones + 0.4) / (total + 0.8)
        self.stretch = np.log(p / (1 - p)).astype(np.float32)
        self.seen = (np.digitize(total, (1, 12))).astype(np.uint8)  # 0, few, many
        self.zeros, self.ones = zeros, ones
        self.weights = np.full((_GATES, ORDERS + 1), 0.25, np.float64)
        self.weights[:, -1] = 0.0
        self.map = np.tile(1 / (1 + np.exp(-np.linspace(-8, 8, _STEPS))), (8, 1))

    def frozen(self) -> dict:
        """What scoring needs, as plain arrays that a broadcast can carry."""
        return {"stretch": self.stretch, "seen": self.seen, "weights": self.weights, "map": self.map}

    @classmethod
    def thawed(cls, state: dict) -> "Mixer":
        mixer = cls.__new__(cls)
        mixer.__dict__.update(state)
        return mixer

    def inputs(self, values: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray]:
        """Stretched predictions of all orders (and a constant), and the gate."""
        x = np.empty((len(values), ORDERS + 1), np.float32)
        x[:, -1] = 0.3
        gate = np.zeros(len(values), np.int64)
        for order in range(ORDERS):
            at = slot(values, order, bit)
            x[:, order] = self.stretch[order, at]
            if order >= ORDERS - 3:
                gate = gate * 3 + self.seen[order, at]
        return x, gate

    def refined(self, total: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Probability of a one, before and after the map, and the place in the map."""
        total = np.clip(total, -8, 8)
        place = (total + 8) * ((_STEPS - 1) / 16)
        low = np.minimum(place.astype(np.int64), _STEPS - 2)
        share = place - low
        p = 1 / (1 + np.exp(-total))
        mapped = self.map[bit, low] * (1 - share) + self.map[bit, low + 1] * share
        return p, 0.5 * (p + mapped), np.where(share > 0.5, low + 1, low)

    def left_out(self, values: np.ndarray, bit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Inputs and gate for a training text, whose own share is taken out of the counts; and the bit."""
        target = bit_of(values, bit)
        x = np.full((len(values), ORDERS + 1), 0.3)
        gate = np.zeros(len(values), np.int64)
        for order in range(ORDERS):
            at = slot(values, order, bit)
            ones = np.maximum(self.ones[order, at].astype(np.float64) - target, 0)
            zeros = np.maximum(self.zeros[order, at].astype(np.float64) - (1 - target), 0)
            p = (ones + 0.4) / (ones + zeros + 0.8)
            x[:, order] = np.log(p / (1 - p))
            if order >= ORDERS - 3:
                gate = gate * 3 + np.digitize(ones + zeros, (1, 12))
        return x, gate, target

    def added(self, values: np.ndarray, n: np.ndarray, into: dict[str, np.ndarray]) -> None:
        """Add the gradient, the curvature and the places of the map of runs that occur ``n`` times to ``into``."""
        for bit in range(8):
            x, gate, target = self.left_out(values, bit)
            p, _, place = self.refined((x * self.weights[gate]).sum(1), bit)
            order = np.argsort(gate, kind="stable")
            x, gate, error, bend = x[order], gate[order], (n * (target - p))[order], (n * p * (1 - p))[order]
            edge = np.searchsorted(gate, np.arange(_GATES + 1))
            for g in np.flatnonzero(np.diff(edge)).tolist():
                mine = slice(edge[g], edge[g + 1])
                into["slope"][g] += error[mine] @ x[mine]
                into["bend"][g] += (x[mine] * bend[mine, None]).T @ x[mine]
            into["hits"][bit] += np.bincount(place, n, _STEPS)
            into["ones"][bit] += np.bincount(place, n * target, _STEPS)

    def step(self, sums: dict[str, np.ndarray]) -> None:
        """The Newton step of the sums over all texts; what they say little about stays near what it was."""
        bend = sums["bend"] + HELD_WEIGHT * np.eye(ORDERS + 1)
        move = np.linalg.solve(bend, sums["slope"][:, :, None])[:, :, 0]
        self.weights = self.weights + np.clip(move, -1, 1)
        self.map = (sums["ones"] + HELD_PLACES * self.map) / (sums["hits"] + HELD_PLACES)
        self.map = np.clip(self.map, 1e-4, 1 - 1e-4)

    def bits(self, values: np.ndarray) -> np.ndarray:
        """Code length of the last byte of every run."""
        total = np.zeros(len(values))
        for bit in range(8):
            x, gate = self.inputs(values, bit)
            _, p, _ = self.refined((x * self.weights[gate]).sum(1), bit)
            total -= np.log2(np.where(bit_of(values, bit) == 1, p, 1 - p))
        return total

    def lengths(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Code length and key of every phrase, and the phrases per text; equal runs are computed once."""
        values, sizes = runs(texts)
        starts, keys, count = phrases(values, sizes)
        distinct, where = np.unique(values, return_inverse=True)
        del values
        each = self.bits(distinct)[where]
        return np.add.reduceat(each, starts) if len(starts) else np.zeros(0), keys, count


def mixed_lengths(bits: np.ndarray, again: np.ndarray, total: np.ndarray, share: float) -> np.ndarray:
    """Code lengths of phrases of ``bits`` by the bytes, that occur ``again`` times in a total of other phrases.

    ``share`` is the weight of the phrases' own prediction.
    """
    with np.errstate(divide="ignore"):
        known = np.log2(share * again / np.maximum(total, 1))
        return -np.logaddexp2(np.log2(1 - share) - bits, known)


def learn(docs: DataFrame, text: str = "text") -> Mixer:
    """The model of all texts of ``docs``; without any, of the uniform bits."""
    texts = docs.select(F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"))
    size = 1 << TABLE_BITS
    zeros, ones = np.zeros((ORDERS, size), np.uint64), np.zeros((ORDERS, size), np.uint64)
    found = distinct_runs(texts)
    for row in counts(found).toArrow().to_pylist():  # tables of a fixed size
        span = slice(row["piece"] * PIECE, (row["piece"] + 1) * PIECE)
        zeros[row["order"], span] = np.frombuffer(row["zeros"], np.uint64)
        ones[row["order"], span] = np.frombuffer(row["ones"], np.uint64)
    model = Mixer(zeros.astype(np.float32), ones.astype(np.float32))
    for _ in range(ROUNDS if zeros.any() or ones.any() else 0):
        model.step(sums_of_all(found, model))
    return model


def _empty_sums() -> dict[str, np.ndarray]:
    shapes = {"slope": (_GATES, ORDERS + 1), "bend": (_GATES, ORDERS + 1, ORDERS + 1), "hits": (8, _STEPS), "ones": (8, _STEPS)}
    return {name: np.zeros(shape) for name, shape in shapes.items()}


def sums_of_all(found: DataFrame, model: Mixer) -> dict[str, np.ndarray]:
    """What :meth:`Mixer.added` gives for all runs of :func:`distinct_runs`. A task sends one number per sum at most."""
    state = {"zeros": model.zeros, "ones": model.ones, "weights": model.weights, "map": model.map}
    shared = found.sparkSession.sparkContext.broadcast(state)  # tables of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer, total = Mixer.thawed(shared.value), _empty_sums()
        for values, n in gathered(batches):
            mixer.added(values, n, total)
        flat = np.concatenate([total[name].ravel() for name in total])
        used = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(flat[used])], ["place", "value"])

    table = found.mapInArrow(run, "place long, value double")
    table = table.groupBy("place").agg(F.sum("value").alias("value")).toArrow()
    out = _empty_sums()
    flat = np.zeros(sum(x.size for x in out.values()))
    flat[table["place"].to_numpy()] = table["value"].to_numpy()
    for name, ends in zip(out, np.cumsum([x.size for x in out.values()]).tolist()):
        out[name] = flat[ends - out[name].size : ends].reshape(out[name].shape)
    return out


def blocks(docs: DataFrame, model: Mixer, n: int, ranges: int) -> tuple[DataFrame, DataFrame]:
    """Texts in blocks, with the code lengths of their phrases by the bytes, and their words and phrases as numbers into the
    block's lists; and the lists, a row per block and range: the ranges of the words, then as many of the phrases."""
    shared = docs.sparkSession.sparkContext.broadcast(model.frozen())  # tables of a fixed size
    kinds = [f.dataType for f in docs.schema.fields[:n]]
    schema = T.StructType(
        [
            T.StructField("block", T.LongType()),
            T.StructField("part", T.IntegerType()),
            T.StructField("words", T.BinaryType()),
            T.StructField("trained", T.BinaryType()),
            *(T.StructField(f"c{i}", T.ArrayType(k)) for i, k in enumerate(kinds)),
            T.StructField("held_out", T.ArrayType(T.BooleanType())),
            T.StructField("size", T.ArrayType(T.LongType())),
            T.StructField("n", T.ArrayType(T.IntegerType())),
            T.StructField("phrases", T.ArrayType(T.IntegerType())),
            T.StructField("numbers", T.BinaryType()),
            T.StructField("phrase_numbers", T.BinaryType()),
            T.StructField("phrase_bits", T.BinaryType()),
        ]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        mixer = Mixer.thawed(shared.value)
        task = TaskContext.get().partitionId() << 32
        for batch in batches:
            for part in cut(batch, n, BLOCK_BYTES):
                texts = as_bytes(part.column(n))
                held_out = part.column(n + 1).to_numpy(zero_copy_only=False).astype(bool)
                few = [as_bytes(p.column(n)) for p in cut(part, n, TOGETHER)]
                bits, phrase_keys, phrase_count = (np.concatenate(x) for x in zip(*map(mixer.lengths, few)))
                size = np.fromiter(map(len, texts), np.int64, len(texts))
                buffer, at = joined([t.lower() for t in texts])
                starts, _, keys = word_keys(buffer, WORD)
                begin = np.searchsorted(starts, at)
                count = np.diff(np.append(begin, len(starts)))
                rows, numbers = [], []
                for base, its, per_text in ((0, keys, count), (ranges, phrase_keys, phrase_count)):
                    listed, number = np.unique(its, return_inverse=True)
                    learned = np.repeat(~held_out, per_text)
                    trained = np.bincount(number[learned], minlength=len(listed)).astype(np.uint32)
                    edge = np.searchsorted(listed, [np.uint64(k * (2**64 // ranges)) for k in range(ranges)])
                    edge = np.append(edge, len(listed))
                    for k in range(ranges):
                        span = slice(edge[k], edge[k + 1])
                        if edge[k + 1] > edge[k]:
                            rows.append((base + k, listed[span].tobytes(), trained[span].tobytes()))
                    numbers.append(number.astype(np.uint32).tobytes())
                m = len(rows)
                nothing = [None] * m
                columns = [
                    pa.array([task] * (m + 1), pa.int64()),
                    pa.array([r[0] for r in rows] + [-1], pa.int32()),
                    pa.array([r[1] for r in rows] + [None], pa.binary()),
                    pa.array([r[2] for r in rows] + [None], pa.binary()),
                ]

                def last(values: pa.Array) -> pa.Array:
                    ends = pa.array([0] * (m + 1) + [len(values)], pa.int32())
                    return pa.ListArray.from_arrays(ends, values)

                columns += [last(part.column(i)) for i in range(n)]
                counts = (x.astype(np.int32) for x in (count, phrase_count))
                columns += [last(pa.array(x)) for x in (held_out, size, *counts)]
                columns += [pa.array([*nothing, x], pa.binary()) for x in (*numbers, bits.astype("<f4").tobytes())]
                yield pa.RecordBatch.from_arrays(columns, [f.name for f in schema])
                task += 1

    made = written(docs.mapInArrow(run, schema), "blocks")
    texts = made.where("part < 0").drop("part", "words", "trained")
    return texts, made.where("part >= 0").select("block", "part", "words", "trained")


def totals(lists: DataFrame) -> DataFrame:
    """(block, part, counts, total, distinct, single): the training count of every listed word or phrase over all blocks; the
    sum, and how many of the range there are and occur once, stand on one of its rows."""

    def add(key: tuple, table: pa.Table) -> pa.Table:
        words = [np.frombuffer(w, np.uint64) for w in table["words"].to_pylist()]
        trained = [np.frombuffer(t, np.uint32) for t in table["trained"].to_pylist()]
        known, number = np.unique(np.concatenate(words), return_inverse=True)
        total = np.bincount(number, np.concatenate(trained), len(known)).astype(np.int64)
        sizes = np.cumsum([len(w) for w in words])[:-1]
        m = len(words)
        return pa.table(
            {
                "block": table["block"],
                "part": table["part"],
                "counts": pa.array([total[x].astype("<i8").tobytes() for x in np.split(number, sizes)], pa.binary()),
                "total": pa.array([int(total.sum())] + [0] * (m - 1), pa.int64()),
                "distinct": pa.array([int((total > 0).sum())] + [0] * (m - 1), pa.int64()),
                "single": pa.array([int((total == 1).sum())] + [0] * (m - 1), pa.int64()),
            }
        )

    return lists.groupBy("part").applyInArrow(
        add, "block long, part int, counts binary, total long, distinct long, single long"
    )


def score(
    docs: DataFrame,
    text: str = "text",
    doc_id: str = "doc_id",
    parts: int = 5,
    held: int = 1,
    range_blocks: int = RANGE_BLOCKS,
) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte).

    A row is held out if its id's remainder is ``held``; all others are learned from. Words are runs of anything but
    white space, in lower case (A-Z); every text has one end token more. Null is empty, and so has one token.
    Repeated rows are learned and scored each for itself, so to each the others are known phrase by phrase. Words and
    phrases are compared by 64-bit keys. If no row is learned from, every token is unknown to the base, and the model knows
    no context and no phrase. An empty table gives no rows.
    """
    kind = docs.select(quoted(doc_id)).schema[0].dataType.simpleString()
    frame = docs.select(
        F.col(quoted(doc_id)).alias("c0"),
        F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"),
        (remainder(F.col(quoted(doc_id)), parts) == held).alias("held_out"),
    )
    size = frame.agg(F.sum(F.octet_length("text")).alias("b"), F.count_if(~F.col("held_out")).alias("ends")).first()
    model = learn(frame.where(~F.col("held_out")))
    ranges = min(MOST_RANGES, max(LEAST_RANGES, (size["b"] or 0) // BLOCK_BYTES // range_blocks))
    texts, lists = blocks(frame, model, 1, ranges)
    found = written(totals(lists), "word-counts")
    word, phrase = F.col("part") < ranges, F.col("part") >= ranges
    row = found.agg(
        F.sum(F.when(word, F.col("total"))).alias("n"),
        F.sum(F.when(word, F.col("distinct"))).alias("v"),
        F.sum(F.when(phrase, F.col("total"))).alias("phrases"),
        F.sum(F.when(phrase, F.col("single"))).alias("single"),
    ).first()
    every = row["phrases"] or 0
    share = (every - (row["single"] or 0)) / (every + 1)  # of training phrases that occur again
    ends = size["ends"]
    tokens = (row["n"] or 0) + ends
    floor = math.log10(tokens + 0.5 * ((row["v"] or 0) + (ends > 0) + 1))

    def finish(left: pa.Table, right: pa.Table) -> pa.Table:
        right = right.sort_by("part")
        parts, split = right["counts"].to_pylist(), int(np.searchsorted(right["part"].to_numpy(), ranges))
        seen, again = (np.frombuffer(b"".join(p), "<i8") for p in (parts[:split], parts[split:]))
        number, phrase_number = (np.frombuffer(left[c][0].as_py(), np.uint32) for c in ("numbers", "phrase_numbers"))
        count = left["n"][0].values.to_numpy().astype(np.int64)
        first = np.cumsum(count) - count
        known = sums((seen > 0)[number].astype(np.int64), first, count) + (ends > 0)
        base = sums(np.log10(seen + 0.5)[number], first, count) + math.log10(ends + 0.5) - (count + 1) * floor
        per_text = left["phrases"][0].values.to_numpy().astype(np.int64)
        held_out = left["held_out"][0].values.to_numpy(zero_copy_only=False)
        own = np.repeat(~held_out, per_text).astype(np.int64)
        bits = np.frombuffer(left["phrase_bits"][0].as_py(), "<f4").astype(np.float64)
        bits = mixed_lengths(bits, again[phrase_number] - own, every - own, share)
        bits = np.add.reduceat(bits, np.cumsum(per_text) - per_text)
        size = left["size"][0].values.to_numpy()
        return pa.table(
            [
                left["c0"][0].values,
                left["held_out"][0].values,
                pa.array(count + 1),
                pa.array(known),
                pa.array(np.full(len(count), tokens)),
                pa.array(base),
                pa.array(-bits * math.log10(2)),
                pa.array(bits / np.maximum(size, 1)),
            ],
            ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score", "bits_per_byte"],
        )

    return (
        texts.groupBy("block")
        .cogroup(found.select("block", "part", "counts").groupBy("block"))
        .applyInArrow(
            finish,
            f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, "
            "base_score double, score double, bits_per_byte double",
        )
    )
