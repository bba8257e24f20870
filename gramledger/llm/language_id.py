"""Language ID by prediction by partial matching (PPM).

One byte context tree per language holds, for every context of up to ``ORDER`` bytes, how often each byte followed
it. A byte is coded at the longest known context; a byte not seen there costs an escape (method C: the number of
distinct followers over that number plus the count) and is tried one byte shorter, at last as one of 256. The
statistics are frozen after learning, so the exact code length of a byte depends on it and the bytes before it only,
and each distinct run of ``ORDER + 1`` bytes of a chunk is coded once.

Learning uses a documented bounded sample: at most about ``SAMPLE_BYTES`` of distinct whole texts per language and
``SAMPLE_TOTAL`` in all, those of smallest hash until that is reached. Every tag that has text is learned: the more there are, the
smaller the share of each. Scoring covers every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gramledger.llm.common import as_bytes, cut, joined, map_texts, quoted, written

ORDER = 4
#: Bytes of text learned per language, and in all.
SAMPLE_BYTES = 3_000_000
SAMPLE_TOTAL = 48_000_000
#: Bits of the hash that texts are chosen by, and ranges of it per doubling.
PLACES = 20
FINE = 64
#: Code lengths that are held at once: those of the sample's runs, and those of texts, in all languages. Beyond that,
#: the trees are asked anew, and fewer texts are taken together.
CELLS = 1 << 26
TEXT_CELLS = 1 << 22
#: Languages whose code lengths of a group of texts are looked up together.
LANGUAGES = 16
#: What stands before the first byte of every text.
START = b"\n" * ORDER
#: Bytes of text that are coded at once. A longer text is coded in parts, each with the ORDER bytes before it.
PART = 1 << 20


def led(text: bytes) -> list[bytes]:
    """The text in parts of at most PART bytes, each behind the ORDER bytes it follows."""
    whole = START + text
    return [whole[a : a + ORDER + PART] for a in range(0, max(1, len(text)), PART)]


def runs(parts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Every byte of the parts with the ORDER bytes before it as one number, and how many each part has."""
    buffer, _ = joined(parts, b"", b"")
    sizes = np.fromiter(map(len, parts), np.int64, len(parts)) - ORDER
    if not sizes.sum():
        return np.zeros(0, np.uint64), sizes
    value = np.zeros(len(buffer) - ORDER, np.uint64)
    for k in range(ORDER + 1):
        value = (value << np.uint64(8)) | buffer[k : len(buffer) - ORDER + k]
    keep = np.ones(len(value), bool)
    ends = np.cumsum(sizes + ORDER)[:-1] - ORDER  # a run may not cross into what leads the next part
    keep[(ends[:, None] + np.arange(ORDER)).ravel()] = False
    return value[keep], sizes


def _sample(docs: DataFrame, text: str, lang: str) -> tuple[list[str], DataFrame] | None:
    known = docs.select(F.col(quoted(lang)).cast("string").alias("lang"), F.col(quoted(text)).alias("text")).where(
        F.col("lang").isNotNull() & (F.octet_length("text") > 0)
    )
    place = F.pmod(F.xxhash64("text"), F.lit(1 << PLACES))
    # bytes of distinct texts by ranges of the hash, finer towards its start: at most PLACES * FINE rows a language
    ranges = (
        known.select("lang", F.xxhash64("text").alias("h"), F.octet_length("text").alias("n"))
        .groupBy("lang", "h")
        .agg(F.max("n").alias("n"))
        .groupBy("lang", F.floor(F.log2(F.pmod("h", F.lit(1 << PLACES)) + 1) * FINE).alias("range"))
        .agg(F.sum("n").alias("n"))
    )
    ranges = written(ranges, "language-ranges")
    tags = [r["lang"] for r in ranges.select("lang").distinct().collect()]
    if not tags:
        return None
    budget = max(1, min(SAMPLE_BYTES, SAMPLE_TOTAL // len(tags)))
    lower = Window.partitionBy("lang").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    limits = (
        ranges.withColumn("lower", F.coalesce(F.sum("n").over(lower), F.lit(0)))
        .where(F.col("lower") < budget)
        .groupBy("lang")
        .agg(F.max("range").alias("last"))
    )
    before = Window.partitionBy("lang").orderBy(place, "text").rowsBetween(Window.unboundedPreceding, -1)
    few = (
        known.join(F.broadcast(limits), "lang")  # a row per language
        .where(F.floor(F.log2(place + 1) * FINE) <= F.col("last"))
        .select("lang", "text")
        .distinct()
        .withColumn("before", F.coalesce(F.sum(F.octet_length("text")).over(before), F.lit(0)))
        .where(F.col("before") < budget)
        .select("lang", "text")
    )
    return sorted(tags), few


def learn(docs: DataFrame, text: str = "text", lang: str = "lang") -> dict | None:
    """Frozen statistics of the languages of ``docs``; None if there is nothing to learn from."""
    sample = _sample(docs, text, lang)
    if sample is None:
        return None
    names, few = sample

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in cut(batch, 1):
                tags = part.column(0)
                for tag in pc.unique(tags).to_pylist():
                    for group, _ in _groups(as_bytes(part.column(1).filter(pc.equal(tags, tag)))):
                        keys, n = np.unique(runs(group)[0], return_counts=True)
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([tag] * len(keys), pa.string()), pa.array(keys.view(np.int64)), pa.array(n)],
                            ["lang", "run", "n"],
                        )

    counts = few.mapInArrow(count, "lang string, run long, n long").groupBy("lang", "run").agg(F.sum("n").alias("n"))
    table = counts.toArrow()  # at most one row per byte of the sample
    trees = []
    for name in names:
        part = table.filter(pc.equal(table["lang"], name))
        trees.append(_tree(part["run"].to_numpy().view(np.uint64), part["n"].to_numpy().astype(np.int64)))
    known = np.unique(table["run"].to_numpy().view(np.uint64))
    if len(known) * len(names) > CELLS:  # too many languages: all their runs are looked up in the trees
        known = known[:0]
    return {
        "names": names,
        "trees": trees,
        "known": known,
        "bits": np.stack([_bits(known, t) for t in trees], 1) if len(known) else np.zeros((0, len(names)), np.float32),
    }


def _grouped(keys: np.ndarray, n: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1])))
    return keys[first], np.add.reduceat(n, first)


def _tree(keys: np.ndarray, n: np.ndarray) -> list[tuple[np.ndarray, ...]]:
    """For each order, longest first: runs and their code lengths, contexts and what their escapes cost."""
    levels: list[tuple[np.ndarray, ...]] = []
    if not len(keys):
        return levels
    for order in range(ORDER, -1, -1):
        keys, n = _grouped(keys & np.uint64((1 << 8 * (order + 1)) - 1), n)
        contexts, first, where, followers = np.unique(
            keys >> np.uint64(8), return_index=True, return_inverse=True, return_counts=True
        )
        total = np.add.reduceat(n, first) + followers
        levels.append(
            (
                keys,
                (np.log2(total[where]) - np.log2(n)).astype(np.float32),
                contexts,
                (np.log2(total) - np.log2(followers)).astype(np.float32),
            )
        )
    return levels


def _found(sorted_keys: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    at = np.minimum(np.searchsorted(sorted_keys, wanted), len(sorted_keys) - 1)
    return at, sorted_keys[at] == wanted


def _bits(values: np.ndarray, tree: list[tuple[np.ndarray, ...]]) -> np.ndarray:
    """Exact code length in bits of the last byte of every run."""
    bits = np.zeros(len(values), np.float32)
    left = np.arange(len(values))
    for level, (keys, length, contexts, escape) in enumerate(tree):
        key = values[left] & np.uint64((1 << 8 * (ORDER - level + 1)) - 1)
        at, hit = _found(keys, key)
        bits[left[hit]] += length[at[hit]]
        left, key = left[~hit], key[~hit]
        at, hit = _found(contexts, key >> np.uint64(8))
        bits[left[hit]] += escape[at[hit]]
    bits[left] += 8.0
    return bits


def _groups(texts: list[bytes]) -> Iterator[tuple[list[bytes], list[int]]]:
    """Parts of the texts, about PART bytes at a time, and the number of the text that each belongs to."""
    group, owner, held = [], [], 0
    for i, text in enumerate(texts):
        for part in led(text):
            if held and held + len(part) > PART + ORDER:
                yield group, owner
                group, owner, held = [], [], 0
            group.append(part)
            owner.append(i)
            held += len(part)
    if group:
        yield group, owner


def code_lengths(texts: list[bytes], model: dict) -> np.ndarray:
    """Bits that each language's model needs for each text: one row per text, one column per language."""
    out = np.zeros((len(texts), len(model["names"])))
    for group, owner in _groups(texts):
        values, sizes = runs(group)
        if not len(values):
            continue
        distinct, where = np.unique(values, return_inverse=True)
        if len(model["known"]):
            at, hit = _found(model["known"], distinct)
        else:
            at, hit = np.zeros(len(distinct), np.int64), np.zeros(len(distinct), bool)
        rest = distinct[~hit]
        some = np.flatnonzero(sizes)
        first = np.cumsum(sizes)[some] - sizes[some]
        for start in range(0, len(model["names"]), LANGUAGES):
            trees = model["trees"][start : start + LANGUAGES]
            table = np.empty((len(distinct), len(trees)), np.float32)
            table[hit] = model["bits"][at[hit], start : start + LANGUAGES]
            for k, tree in enumerate(trees):
                table[~hit, k] = _bits(rest, tree)
                part = np.add.reduceat(table[where, k], first, dtype=np.float64)
                np.add.at(out[:, start + k], np.array(owner)[some], part)
    return out


def predict(
    docs: DataFrame,
    model: dict | None,
    text: str = "text",
    carry: tuple[str, ...] = ("doc_id",),
    names: tuple[str, str, str] = ("lang_pred", "score", "bits_per_byte"),
) -> DataFrame:
    """Carried columns with the predicted language, its share among the learned ones, and bits per byte.

    The share is that of the language's probability of the text in the sum over all learned languages. Null texts
    and texts without a letter are ``und`` with score 0 and null bits per byte; so is every text if nothing was
    learned. Equal code lengths go to the first tag in alphabetical order. Repeated rows get equal results.
    """
    shared = docs.sparkSession.sparkContext.broadcast(model)  # bounded by SAMPLE_TOTAL

    def kernel():
        frozen = shared.value

        def work(texts: pa.Array) -> list[pa.Array]:
            letters = pc.fill_null(pc.match_substring_regex(texts, r"\p{L}"), False).to_numpy(zero_copy_only=False)
            if frozen is None:
                none = pa.nulls(len(texts), pa.float64())
                return [pa.array(["und"] * len(texts)), pc.fill_null(none, 0.0), none]
            raw = [t if some else b"" for t, some in zip(as_bytes(texts), letters)]
            best, least, share = np.zeros(len(raw), np.int64), np.zeros(len(raw)), np.zeros(len(raw))
            few = max(1, TEXT_CELLS // len(frozen["names"]))
            for start in range(0, len(raw), few):
                span = slice(start, start + few)
                bits = code_lengths(raw[span], frozen)
                best[span] = bits.argmin(1)
                least[span] = bits.min(1)
                share[span] = 1 / np.exp2(np.maximum(least[span, None] - bits, -1000)).sum(1)
            size = np.maximum(1, np.fromiter(map(len, raw), np.int64, len(raw)))
            return [
                pa.array([frozen["names"][k] if some else "und" for k, some in zip(best.tolist(), letters)]),
                pa.array(np.where(letters, share, 0.0)),
                pa.array(least / size, mask=~letters),
            ]

        return work

    fields = list(zip(names, ("string", "double", "double")))
    return map_texts(docs, kernel, fields, text, carry)


def rejects(pred: str = "lang_pred", bits: str = "bits_per_byte", most_bits: float = 8.0) -> "F.Column":
    """Whether a predicted row belongs to no learned language.

    It has no letter, or even the best model needs as many bits as the plain bytes have.
    """
    return (F.col(quoted(pred)) == "und") | (F.coalesce(F.col(quoted(bits)), F.lit(0.0)) >= most_bits)
