"""BPE encoding and decoding of whole texts by tree concatenation.

A long text is halved until its parts are short, wherever the middle falls: in a sentence, in a word, in a run of
letters without any space. The parts are encoded by themselves, in parallel, as if each were a whole text. Then
neighbours are concatenated up the tree. What is wrong in the ids of two neighbours is wrong close to the place where
they meet, so a window around it is encoded again and grows until it agrees with the ids of both sides. There are two
ways to agree:

* The window starts and ends at places where any text is split, whatever stands around them: at white space, beside a
  number, between a letter and a sign (an apostrophe may start a contraction, so it counts only after a letter). The
  ids of the window then replace those of both sides between the places.
* Inside one unsplit run, the window is a number of tokens of each side. If its first token is the left side's own and
  its last the right side's own, both edges are pairs that stand in valid encodings, and a sequence of tokens is the
  encoding of its text if all its adjacent pairs are. The suffix that marks the end of a word is left out where the
  run goes on.

A window that reaches both ends is the text itself, so the loop ends, and its result is the tokenizer's in any case.

Parts of texts longer than ``PART`` are rows of their own and encoded by different tasks; shorter texts are halved
within a task. Short parts are encoded a stretch without white space at a time; stretches seen before are looked up.
"""

from __future__ import annotations

import json
import os
import re
import unicodedata
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramledger.llm.common import cut, quoted, written

#: Characters of a part that is encoded by itself, and of a text's parts that are rows of their own.
LEAF = 1 << 13
PART = 1 << 16
#: Characters to either side of a join that the first window has.
WINDOW = 16
#: Stretches a task remembers, at most, and the longest of them in characters.
REMEMBERED = 400_000
LONGEST = 64

_WHITE = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"  # what the tokenizer's pattern calls space
_SPACES = re.compile(f"[{_WHITE}]+")
_SPACE, _LETTER, _NUMBER, _APOSTROPHE, _SIGN, _UNSURE = range(6)


def _composing() -> frozenset[str]:
    """Characters that may melt into the one before them, besides marks."""
    second = {chr(c) for c in (*range(0x1161, 0x1176), *range(0x11A8, 0x11C3))}
    for code in range(0x110000):
        pair = unicodedata.decomposition(chr(code)).split()
        if len(pair) == 2 and not pair[0].startswith("<"):
            second.add(chr(int(pair[1], 16)))
    return frozenset(second)


def _byte_names() -> list[str]:
    """How byte-level vocabularies write a byte: as itself if it can be seen, else as the next letter from 256 on."""
    seen = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = (b for b in range(0x100) if b not in seen)
    names = {b: chr(b) for b in seen} | {b: chr(0x100 + i) for i, b in enumerate(hidden)}
    return [names[b] for b in range(0x100)]


class Kinds(dict):
    """How the tokenizer's pattern sees a character; unsure if that may depend on the characters around it."""

    def __init__(self):
        super().__init__()
        self.composing = _composing()

    def __missing__(self, c: str) -> int:
        category = unicodedata.category(c)
        if _SPACES.match(c):
            kind = _SPACE
        elif category[0] == "M" or category == "Cn" or c in self.composing:
            kind = _UNSURE
        elif unicodedata.normalize("NFC", c) != c or len(c.lower()) != 1:
            kind = _UNSURE
        elif unicodedata.category(c.lower())[0] != category[0]:
            kind = _UNSURE
        elif c == "'":
            kind = _APOSTROPHE
        else:
            kind = _LETTER if category[0] == "L" else _NUMBER if category[0] == "N" else _SIGN
        self[c] = kind
        return kind


class Codec:
    """Encodes and decodes with a tokenizer of words of letters, single numbers and runs of signs, with word ends."""

    def __init__(self, spec: str, leaf: int = LEAF, window: int = WINDOW):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.models import BPE

        self.leaf_size, self.window = leaf, window
        self.tokenizer = Tokenizer.from_str(spec)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        content = json.loads(spec)
        model = content["model"]
        self.suffix = model["end_of_word_suffix"]
        merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in model["merges"]]
        self.ended = BPE(vocab=model["vocab"], merges=merges, end_of_word_suffix=self.suffix)
        self.open = BPE(vocab=model["vocab"], merges=merges)
        self.specials = [t["content"] for t in content["added_tokens"]]
        names = {**{i: t for t, i in model["vocab"].items()}, **{t["id"]: t["content"] for t in content["added_tokens"]}}
        self.names = [names.get(i, "") for i in range(max(names) + 1)]
        self.ends = np.array([n.endswith(self.suffix) or n in self.specials for n in self.names])
        self.kinds = Kinds()
        self.known: dict[str, bytes] = {}
        self.words: dict[str, bytes] = {}
        # characters of one or two bytes that the normalizer only lowers, and the pattern for lowered ones
        sure = [c for c in map(chr, range(0x250)) if self.kinds[c] not in (_SPACE, _UNSURE)]
        letters, numbers = (re.escape("".join(c for c in sure if self.kinds[c] == k)) for k in (_LETTER, _NUMBER))
        self.plain = re.compile(f"[{re.escape(''.join(sure))}]+")
        self.pattern = re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{letters}{numbers}]+")
        self.byte_names = _byte_names()

    # whole texts

    def encode(self, text: str) -> np.ndarray:
        return self._half(text, 0, len(text))

    def decode(self, ids: np.ndarray) -> str:
        return " ".join(map(self.names.__getitem__, ids.tolist()))

    def _half(self, text: str, start: int, end: int) -> np.ndarray:
        middle = self.place(text, (start + end) // 2, end) if end - start > self.leaf_size else end
        if middle == end:
            return self.leaf(text[start:end])
        left, right = self._half(text, start, middle), self._half(text, middle, end)
        return self.join(text, start, middle, end, left, right)

    def place(self, text: str, at: int, end: int) -> int:
        """First place from ``at`` on where a text may be cut: in no special token, before no mark."""
        while at < end and (self.kinds[text[at]] == _UNSURE or self._within_special(text, at)):
            at += 1
        return at

    def joined(self, text: str, places: Sequence[int], ids: Sequence[np.ndarray]) -> np.ndarray:
        """Ids of the text from those of its parts, which start at ``places``; the last place is its end."""
        if len(ids) == 1:
            return ids[0]
        half = len(ids) // 2
        left = self.joined(text, places[: half + 1], ids[:half])
        right = self.joined(text, places[half:], ids[half:])
        return self.join(text, places[0], places[half], places[-1], left, right)

    # short parts

    def leaf(self, text: str) -> np.ndarray:
        """Ids of a part as if it were all."""
        odd = any(c in text for c in "\x1c\x1d\x1e\x1f")  # white space to Python, but not to the tokenizer
        stretches = _SPACES.split(text) if odd else text.split()
        known = self.known
        new = list({s for s in stretches if s and s not in known})
        if new:
            if len(known) > REMEMBERED:
                known.clear()
                new = list({s for s in stretches if s})
            if len(self.words) > REMEMBERED:
                self.words.clear()
            other = []
            for s in new:
                if self.plain.fullmatch(s) and not any(t in s for t in self.specials):
                    known[s] = b"".join(map(self._word, self.pattern.findall(s.lower())))
                else:
                    other.append(s)
            for s, e in zip(other, self.tokenizer.encode_batch_fast(other, add_special_tokens=False)):
                known[s] = array("i", e.ids).tobytes()
        out = np.frombuffer(b"".join([known[s] for s in stretches if s]), "<i4")
        for s in new:
            if len(s) > LONGEST:
                del known[s]
        return out

    def _word(self, word: str) -> bytes:
        """Ids of one word of the pattern."""
        ids = self.words.get(word)
        if ids is None:
            symbols = word if word.isalpha() and word.isascii() else self._symbols(word)
            ids = array("i", [t.id for t in self.ended.tokenize(symbols)]).tobytes()
            if len(word) <= LONGEST:
                self.words[word] = ids
        return ids

    def _symbols(self, word: str) -> str:
        return "".join(map(self.byte_names.__getitem__, word.encode()))

    # joins

    def join(self, text: str, start: int, at: int, end: int, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """Ids of ``text[start:end]`` from those of ``text[start:at]`` and ``text[at:end]``."""
        if self._splits(text, at):
            return np.concatenate((left, right))
        size = self.window
        while True:
            low, high = max(start, at - size), min(end, at + size)
            first = next((i for i in range(at - 1, max(low, start + 1) - 1, -1) if self._splits(text, i)), None)
            last = next((i for i in range(at + 1, min(high, end - 1) + 1) if self._splits(text, i)), None)
            first = start if first is None and low == start else first
            last = end if last is None and high == end else last
            if first is not None and last is not None:
                before, after = len(self.leaf(text[first:at])), len(self.leaf(text[at:last]))
                again = self.leaf(text[first:last])
                return np.concatenate((left[: len(left) - before], again, right[after:]))
            if self._one_run(text, start, at):
                found = self._run(left, right, max(2, size // 8))
                if found is not None:
                    return found
            size *= 2

    def _within_special(self, text: str, at: int) -> bool:
        return any(text.find(s, max(0, at - len(s) + 1), at + len(s) - 1) >= 0 for s in self.specials)

    def _splits(self, text: str, at: int) -> bool:
        """Whether every text is split between these two characters."""
        one, two = self.kinds[text[at - 1]], self.kinds[text[at]]
        if one == _SPACE or two == _SPACE:
            return True
        if one == _UNSURE or two == _UNSURE or self._within_special(text, at):
            return False
        if one == _NUMBER or two == _NUMBER:
            return True
        return (one == _LETTER) != (two == _LETTER) and one != _APOSTROPHE

    def _one_run(self, text: str, start: int, at: int) -> bool:
        """Whether the last word of the left side and the first of the right are parts of one word."""
        near = [self.kinds[c] for c in text[max(start, at - 3) : at]]
        kind = self.kinds[text[at]]
        return (
            kind in (_LETTER, _SIGN)
            and near[-1] == kind
            and _APOSTROPHE not in near
            and not any(text.find(s, max(0, at - len(s)), at + len(s)) >= 0 for s in self.specials)
        )

    def _run(self, left: np.ndarray, right: np.ndarray, size: int) -> np.ndarray | None:
        """Both sides of one run joined, if a window of ``size`` tokens of each side agrees with both."""
        before, after = left[-size:], right[:size]
        borders = np.flatnonzero(self.ends[before[:-1]])
        from_start = len(borders) > 0 or size >= len(left)
        before = before[borders[-1] + 1 :] if len(borders) else before
        borders = np.flatnonzero(self.ends[after])
        to_end = len(borders) > 0
        after = after[: borders[0] + 1] if to_end else after
        names = [self.names[i] for i in (*before.tolist(), *after.tolist())]
        names[len(before) - 1] = names[len(before) - 1].removesuffix(self.suffix)
        if to_end:
            names[-1] = names[-1].removesuffix(self.suffix)
        again = np.array([t.id for t in (self.ended if to_end else self.open).tokenize("".join(names))], "<i4")
        if not (from_start or again[0] == before[0]) or not (to_end or again[-1] == after[-1]):
            return None
        return np.concatenate((left[: len(left) - len(before)], again, right[len(after) :]))


def _lists(ids: Sequence[np.ndarray]) -> pa.Array:
    ends = np.concatenate(([0], np.cumsum([len(i) for i in ids]))).astype(np.int32)
    values = np.concatenate(ids) if len(ids) else np.zeros(0, np.int32)
    return pa.ListArray.from_arrays(pa.array(ends), pa.array(values.astype(np.int32)))


def encode(
    docs: DataFrame,
    tokenizer: str,
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    names: Sequence[str] = ("ids", "decoded"),
    leaf: int = LEAF,
    part: int = PART,
) -> DataFrame:
    """One row per row of ``docs``: the columns of ``carry``, the ids of the text, and those ids decoded.

    The ids are what the tokenizer gives without special tokens of its own; names of special tokens that stand in a
    text are those tokens. Decoding keeps them. A null text is encoded like an empty one, to no ids and an empty
    text. Repeated rows give repeated rows, an empty table none. Columns of ``docs`` that are not carried are not
    read; choose ``names`` if a carried column is called like them. ``tokenizer`` is a file of the driver's machine
    and sent to the tasks. A task holds one text at a time, or about a megabyte of short ones.
    """
    spark = docs.sparkSession
    with open(tokenizer, encoding="utf-8") as file:
        spec = spark.sparkContext.broadcast(file.read())  # the vocabulary, whatever the data
    kept = len(carry)
    plain = docs.select(
        *(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(carry)),
        F.coalesce(F.col(quoted(text)), F.lit("")).alias("text"),
    )
    carried = plain.schema.fields[:kept]
    found = [T.StructField("ids", T.ArrayType(T.IntegerType())), T.StructField("decoded", T.StringType())]
    schema = T.StructType([*carried, *found])

    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec.value, leaf)
        for batch in batches:
            for some in cut(batch, kept):
                ids = [codec.encode(t) for t in some.column(kept).to_pylist()]
                decoded = pa.array([codec.decode(i) for i in ids], pa.string())
                yield pa.RecordBatch.from_arrays([*some.columns[:kept], _lists(ids), decoded], schema.names)

    def parts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec.value, leaf)
        for batch in batches:
            for some in cut(batch, kept, 1):
                content = some.column(kept)[0].as_py()
                places = [0]
                while places[-1] < len(content):
                    places.append(codec.place(content, min(places[-1] + part, len(content)), len(content)))
                pieces = [content[a:b] for a, b in zip(places, places[1:])]
                owner = pa.array(np.zeros(len(pieces), np.int64))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(c.take(owner) for c in some.columns[:kept]),
                        some.column(kept + 1).take(owner),
                        pa.array(range(len(pieces)), pa.int32()),
                        pa.array(pieces, pa.string()),
                    ],
                    [*schema.names[:kept], "row", "part", "piece"],
                )

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec.value, leaf)
        for batch in batches:
            for some in cut(batch, 2):
                ids = [codec.encode(t) for t in some.column(2).to_pylist()]
                yield pa.RecordBatch.from_arrays([*some.columns, _lists(ids)], ["row", "part", "piece", "ids"])

    def concatenated(group: pa.Table) -> pa.Table:
        codec = Codec(spec.value, leaf)
        group = group.sort_by("part")
        pieces = group.column("piece").to_pylist()
        places = np.concatenate(([0], np.cumsum([len(p) for p in pieces]))).tolist()
        lists = group.column("ids").combine_chunks()
        ids = codec.joined("".join(pieces), places, [lists[i].values.to_numpy() for i in range(len(pieces))])
        columns = [group.column("row").slice(0, 1), _lists([ids]), pa.array([codec.decode(ids)], pa.string())]
        return pa.table(columns, names=["row", "ids", "decoded"])

    long = F.length("text") > part
    cuts = plain.where(long).withColumn("row", F.monotonically_increasing_id())
    table = T.StructType([*carried, T.StructField("row", T.LongType()), T.StructField("part", T.IntegerType())])
    cuts = written(cuts.mapInArrow(parts, table.add("piece", "string")), "parts")
    dealt = cuts.select("row", "part", "piece").repartition("row", "part")
    encoded = dealt.mapInArrow(pieces, "row long, part int, piece string, ids array<int>")
    texts = encoded.groupBy("row").applyInArrow(concatenated, "row long, ids array<int>, decoded string")
    firsts = cuts.where("part = 0").drop("part", "piece")
    rest = firsts.join(texts, "row").select(*schema.names)
    result = plain.where(~long).mapInArrow(whole, schema).unionAll(rest)
    return result.toDF(*carry, *names)
