"""Toxicity by multiple-instance learning.

Only whole documents are labelled. A document is a bag of sentences; each has a logistic score of its words, and the
document's probability is their noisy-or: one minus the product of the sentences' chances to be clean. The gradient of
the document's loss flows through the noisy-or to the sentences, so the model learns which of them offend, and says so.

Learning uses a documented bounded sample of labelled rows: at most ``SAMPLE_ROWS`` documents and about
``SAMPLE_BYTES`` of their whole texts, chosen by a hash. Scoring covers every whole text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from gramledger.llm.common import as_bytes, joined, map_texts, quoted, sums, word_keys, word_table

SAMPLE_ROWS = 12_000
SAMPLE_BYTES = 32 << 20
SLOTS = 1 << 18
STEPS = 80
#: Penalty on the weights' size, per document: what a word must explain to count at all.
PENALTY = 5e-4
#: Share of the sample's documents that hold a common word. Rarer ones need evidence, and are penalised in proportion.
COMMON = 0.01
#: Bytes of the sample that are cut into words at once.
CUT = 1 << 20

WORD = word_table([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)])
_END = np.zeros(256, bool)
_END[[10, 33, 46, 63]] = True  # line end ! . ?


class Bags:
    """Texts as sentences of word slots; every sentence and text has its range in the flat arrays."""

    def __init__(self, texts: list[bytes]):
        buffer, at = joined(texts)
        raw = np.frombuffer(buffer.tobytes().lower(), np.uint8)
        starts, ends, keys = word_keys(raw, WORD)
        self.slots = (keys >> np.uint64(64 - 18)).astype(np.int64)
        stops = np.flatnonzero(_END[raw])  # a text ends with a line end, so no sentence crosses texts
        number = np.searchsorted(stops, starts)
        new = np.flatnonzero(np.diff(number, prepend=-1))
        self.first, self.count = new, np.diff(np.append(new, len(starts)))
        begin = starts[new]
        self.text_first = np.searchsorted(begin, at)
        self.text_count = np.diff(np.append(self.text_first, len(begin)))
        self.owner = np.repeat(np.arange(len(texts)), self.text_count)
        self.begin = begin - at[self.owner]
        self.end = ends[new + self.count - 1] - at[self.owner] if len(new) else begin


def telling(held: np.ndarray, hurt: np.ndarray, rate: float) -> np.ndarray:
    """Whether ``hurt`` of ``held`` texts being toxic is beyond the chance of any word (Chernoff bound)."""
    share = hurt / np.maximum(held, 1)
    with np.errstate(divide="ignore", invalid="ignore"):
        apart = np.where(share > 0, share * np.log(share / rate), 0.0)
        apart += np.where(share < 1, (1 - share) * np.log((1 - share) / (1 - rate)), 0.0)
    return (share > rate) & (held * apart >= np.log(max(2, np.count_nonzero(held))))


class Sample:
    """Sentences of the texts to learn from, with only those words that can get a weight.

    These are the words that ``COMMON`` of the texts hold, and of the rarer ones those that toxic texts hold more often
    than chance gives any of so many words. How many texts that takes grows with the logarithm of the number of words
    only, not with the sample. Texts are cut into words about ``CUT`` bytes at a time, since the arrays made for
    that take many times the text; what is kept takes some 8 bytes a word.
    """

    def __init__(self, texts: list[bytes], toxic: np.ndarray):
        held, hurt, parts, start = np.zeros(SLOTS, np.int64), np.zeros(SLOTS, np.int64), [], 0
        ends = np.cumsum([len(t) for t in texts])
        while start < len(texts):
            taken = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, taken + CUT)))
            bags = Bags(texts[start:stop])
            sentence = np.repeat(np.arange(len(bags.first)), bags.count)
            owner, slot = np.divmod(np.unique(bags.owner[sentence] * SLOTS + bags.slots), SLOTS)
            held += np.bincount(slot, minlength=SLOTS)
            hurt += np.bincount(slot[toxic[start:stop][owner]], minlength=SLOTS)
            parts.append((bags.slots.astype(np.int32), bags.count, bags.text_count))
            start = stop
        usable = (held >= COMMON * len(texts)) | telling(held, hurt, toxic.mean())
        self.penalty = PENALTY * np.minimum(1.0, held / (COMMON * len(texts)))
        slots, counts = [], []
        for words, count, _ in parts:
            kept = usable[words]
            slots.append(words[kept])
            counts.append(np.bincount(np.repeat(np.arange(len(count)), count)[kept], minlength=len(count)))
        self.slots, self.count = np.concatenate(slots), np.concatenate(counts)
        self.first = np.cumsum(self.count) - self.count
        self.sentence = np.repeat(np.arange(len(self.count), dtype=np.int32), self.count)
        self.text_count = np.concatenate([n for _, _, n in parts])
        self.text_first = np.cumsum(self.text_count) - self.text_count
        self.owner = np.repeat(np.arange(len(texts)), self.text_count)


def sentence_logits(bags: Bags | Sample, weights: np.ndarray, bias: float) -> np.ndarray:
    return bias + sums(weights[bags.slots], bags.first, bags.count)


def clean_chance(logits: np.ndarray) -> np.ndarray:
    """Natural logarithm of a sentence's chance to be clean."""
    return -np.logaddexp(0.0, logits)


def train(texts: list[bytes], labels: np.ndarray) -> tuple[np.ndarray, float]:
    """Weights and bias that minimise the documents' log loss (Adam, whole sample per step)."""
    weights, bias = np.zeros(SLOTS), -4.0
    if not len(texts) or labels.min() == labels.max():
        return weights, (4.0 if len(texts) and labels.min() == 1 else -30.0)
    bags = Sample(texts, labels == 1)
    penalty = bags.penalty
    first, second = np.zeros(SLOTS + 1), np.zeros(SLOTS + 1)
    for step in range(1, STEPS + 1):
        logits = sentence_logits(bags, weights, bias)
        clean = sums(clean_chance(logits), bags.text_first, bags.text_count)  # log of 1 - p
        p = -np.expm1(clean)
        # d loss / d log(1 - p): 1 - label/p; each sentence's share of it is its own probability
        slope = np.where(labels == 1, -(1 - p) / np.maximum(p, 1e-9), 1.0)
        toward = slope[bags.owner] * np.exp(-np.logaddexp(0.0, -logits)) / len(texts)
        pull = np.bincount(bags.slots, weights=toward[bags.sentence], minlength=SLOTS)
        at_rest = np.sign(pull) * np.maximum(np.abs(pull) - penalty, 0.0)
        grad = np.append(np.where(weights == 0, at_rest, pull + penalty * np.sign(weights)), toward.sum())
        first = 0.9 * first + 0.1 * grad
        second = 0.99 * second + 0.01 * grad**2
        move = 0.15 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-9)
        moved = weights - move[:-1]
        weights = np.where(moved * weights < 0, 0.0, moved)  # a weight that changes sides stops at zero
        bias -= move[-1]
    return weights, float(bias)


def learn(
    docs: DataFrame, labels: DataFrame, text: str = "text", doc_id: str = "doc_id", label: str = "toxic"
) -> tuple[np.ndarray, float]:
    """Model from the labelled rows of ``docs``. Null labels and ids are left out; a label of 1 beats one of 0."""
    marks = (
        labels.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(label)).cast("int").alias("y"))
        .where("id IS NOT NULL AND y IN (0, 1)")
        .groupBy("id")
        .agg(F.max("y").alias("y"))
        .orderBy(F.xxhash64("id"))
        .limit(SAMPLE_ROWS)
    )
    some = F.broadcast(marks)  # SAMPLE_ROWS rows of a key and a number
    found = docs.select(F.col(quoted(doc_id)).alias("id"), F.col(quoted(text)).alias("text")).join(some, "id")
    place = F.xxhash64("id", "text")
    sizes = found.select(place.alias("h"), F.octet_length("text").alias("n")).where("n > 0")
    total = sizes.agg(F.sum("n")).first()[0] or 0
    if total > SAMPLE_BYTES:  # whole documents in the order of their hash, up to the bound
        found = found.where(F.pmod(place, F.lit(1 << 20)) < int((1 << 20) * SAMPLE_BYTES / total))
    rows = found.where(F.octet_length("text") > 0).select("text", "y").orderBy(place, "y").toArrow()
    return train(as_bytes(rows["text"].combine_chunks()), rows["y"].to_numpy())


def score(
    docs: DataFrame,
    model: tuple[np.ndarray, float],
    text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
) -> DataFrame:
    """Carried columns with the document's probability, whether it is at least 0.5, and the worst sentence.

    The sentence is given by its number (from 0, -1 without words), its byte range in the text and its probability.
    Null, empty and wordless texts score 0. Equal sentences: the first one. Repeated rows get equal results.
    """
    weights, bias = model
    shared = docs.sparkSession.sparkContext.broadcast((weights.astype(np.float32), bias))  # SLOTS numbers

    def kernel():
        weights, bias = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            bags = Bags(as_bytes(texts))
            logits = bias + sums(weights[bags.slots].astype(np.float64), bags.first, bags.count)
            p = np.abs(-np.expm1(sums(clean_chance(logits), bags.text_first, bags.text_count)))
            some = np.flatnonzero(bags.text_count)
            worst = np.full(len(texts), -1)
            if len(some):
                top = np.full(len(texts), -np.inf)
                top[some] = np.maximum.reduceat(logits, bags.text_first[some])
                at = np.flatnonzero(logits == top[bags.owner])[::-1]
                worst[bags.owner[at]] = at
            has = worst >= 0
            show = np.where(has, worst, 0)
            pick = lambda x: np.where(has, x[show], 0) if len(x) else np.zeros(len(texts), np.int64)
            return [
                pa.array(np.minimum(p, 1.0)),
                pa.array((p >= 0.5).astype(np.int32)),
                pa.array(np.where(has, worst - bags.text_first, -1)),
                pa.array(pick(bags.begin)),
                pa.array(pick(bags.end)),
                pa.array(pick(np.exp(-np.logaddexp(0.0, -logits))).astype(np.float64)),
            ]

        return work

    fields = [
        ("score", "double"),
        ("predicted", "int"),
        ("sentence", "long"),
        ("sentence_start", "long"),
        ("sentence_end", "long"),
        ("sentence_score", "double"),
    ]
    return map_texts(docs, kernel, fields, text, carry)
