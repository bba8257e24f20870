"""Names in texts, by hashes: short names whole, long ones by a piece of fixed width.

A name of up to ``WHOLE`` characters is looked up as it is. One pass over a text rolls the hashes of its beginnings; where
some name begins like that, the hash goes on to the lengths that names have, and what equals one is compared character by
character. So a short name found is a match, with nothing left to check, and texts are read once.

A longer name is found by one of its pieces: a text that holds the name holds the piece. What that costs is the number of
places of the piece in the texts, times the number of names that are looked up by it. Both are estimated by count-min
sketches over all texts and all names, so that a piece is chosen for being rare where it is looked for. The sketches have
a fixed size, whatever the data.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import Broadcast, TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

#: Rows of a sketch and counters in each; an estimate is too high by a few per 2^16 of all pieces at most.
SKETCH_ROWS, SKETCH_BITS = 3, 16
#: Bits of the filter of pieces that are looked up at all.
FILTER_BITS = 24
#: Characters that a task turns into numbers at a time; a longer text is taken alone.
CHUNK = 1 << 17
#: Texts that are Python strings at a time, however many an Arrow batch holds.
ROWS = 256
#: Longest name that is looked up whole, and the widths of the beginnings by which that is done.
WHOLE, BEGINNINGS = 32, (1, 2, 3, 4, 8)
#: Slots per name in the tables of beginnings and names, as a power of two, and bounds of a table's size.
SPARE_BITS, LEAST_BITS, MOST_BITS = 8, 16, 22
#: Characters that fit into a number as they are: up to that length equal keys are equal strings.
EXACT, CHARACTER_BITS = 3, 21
#: Cells of a table of texts and strings that is filled instead of sorting pairs.
CELLS = 1 << 22
#: A block of texts ends with so many characters, or with so many pieces found in its texts.
BLOCK_CHARS, BLOCK_FOUND = 1 << 22, 1 << 20

_FACTOR = np.uint64(0x9E3779B97F4A7C15)
_SHIFT = np.uint64(29)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> _SHIFT)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> _SHIFT)


class Places:
    """The places of several texts, one after the other, and the hash of the piece at each."""

    def __init__(self, texts: Sequence[str]):
        self.codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32).astype(np.uint64)
        sizes = np.fromiter(map(len, texts), np.int64, len(texts))
        ends = np.cumsum(sizes)
        self.row = np.repeat(np.arange(len(texts)), sizes)
        self.at = np.arange(len(self.codes)) - np.repeat(ends - sizes, sizes)
        self.left = np.repeat(ends, sizes) - np.arange(len(self.codes))

    def pieces(self, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Text, place in it and hash of every piece of ``width`` characters."""
        n = max(0, len(self.codes) - width + 1)
        value = np.full(n, width, np.uint64)
        for j in range(width):
            value = value * _FACTOR + self.codes[j : n + j]
        whole = self.left[:n] >= width
        return self.row[:n][whole], self.at[:n][whole], _mixed(value[whole])


def slots(hashes: np.ndarray) -> np.ndarray:
    """Counter of each piece in every row of a sketch."""
    rows = [
        (_mixed(hashes + _FACTOR * np.uint64(r + 1)) >> np.uint64(64 - SKETCH_BITS)).astype(np.int64) + (r << SKETCH_BITS)
        for r in range(SKETCH_ROWS)
    ]
    return np.stack(rows)


def filter_bit(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - FILTER_BITS)).astype(np.int64)


def chunks(column: pa.Array) -> Iterator[tuple[int, Sequence[str]]]:
    """Runs of texts with ``CHUNK`` characters together, or one text; and the number of the first."""
    for first in range(0, len(column), ROWS):
        texts = column.slice(first, ROWS).to_pylist()
        start, held = 0, 0
        for i, text in enumerate(texts):
            if held and held + len(text) > CHUNK:
                yield first + start, texts[start:i]
                start, held = i, 0
            held += len(text)
        yield first + start, texts[start:]


def _slices(some: Sequence[str], overlap: int) -> Iterator[Sequence[str]]:
    """A run of texts as it is, but a text beyond ``CHUNK`` in parts that overlap: a piece starts in the first
    ``CHUNK`` characters of one part only."""
    if len(some) > 1 or not some or len(some[0]) <= CHUNK:
        yield some
    else:
        for start in range(0, len(some[0]), CHUNK):
            yield [some[0][start : start + CHUNK + overlap]]


def sketch(texts: DataFrame, column: str, widths: Sequence[int]) -> np.ndarray:
    """Count-min sketch of all pieces in a column. A task sends at most one number per counter."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(SKETCH_ROWS << SKETCH_BITS, np.int64)
        for batch in batches:
            for part in (part for _, some in chunks(batch.column(0)) for part in _slices(some, max(widths, default=1) - 1)):
                places = Places(part)
                for width in widths:
                    _, at, hashes = places.pieces(width)
                    count += np.bincount(slots(hashes[at < CHUNK]).ravel(), minlength=len(count))
        used = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(count[used])], ["slot", "n"])

    counted = texts.where(F.col(column).isNotNull()).select(column).mapInArrow(run, "slot long, n long")
    total = counted.groupBy("slot").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(SKETCH_ROWS << SKETCH_BITS, np.int64)
    out[total.column("slot").to_numpy()] = total.column("n").to_numpy()
    return out


def cheapest_pieces(words: DataFrame, name: str, widths: Sequence[int], in_texts: np.ndarray, in_names: np.ndarray) -> DataFrame:
    """Each name with its width, the widest that fits, and the piece of that width that costs least.

    Of equal costs the one that fewer names share is taken, then the first. The empty name has neither.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start, some in chunks(batch.column(0)):
                size = np.fromiter(map(len, some), np.int64, len(some))
                fits = np.array([0, *widths])[np.searchsorted(widths, size, side="right")]
                piece: list[str | None] = [None] * len(some)
                places = Places(some)
                for width in widths:
                    row, at, hashes = places.pieces(width)
                    mine = fits[row] == width
                    row, at, found = row[mine], at[mine], slots(hashes[mine])
                    shared, placed = in_names[found].min(axis=0), in_texts[found].min(axis=0)
                    order = np.lexsort((at, shared, shared.astype(float) * placed, row))
                    first = order[np.flatnonzero(np.diff(row[order], prepend=-1))]
                    for r, a in zip(row[first].tolist(), at[first].tolist()):
                        piece[r] = some[r][a : a + width]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(start, len(some)), pa.array(fits, pa.int32()), pa.array(piece, pa.string())],
                    [name, "_width", "_piece"],
                )

    return words.select(name).mapInArrow(run, _with(words.select(name), ("_width", "int"), ("_piece", "string")))


def piece_filter(lookup: DataFrame) -> np.ndarray:
    """One bit per hash of a piece that is looked up; as many bits whatever the number of names."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(1 << FILTER_BITS, bool)
        for batch in batches:
            for _, some in chunks(batch.column(0)):
                bits[filter_bit(_own_hashes(some))] = True
        used = np.flatnonzero(bits)
        yield pa.RecordBatch.from_arrays([pa.array(used >> 16), pa.array(used & 0xFFFF)], ["part", "bit"])

    def packed(part: pa.Table) -> pa.Table:
        bits = np.zeros(1 << 16, bool)
        bits[part.column("bit").to_numpy()] = True
        return pa.table({"part": part.column("part").slice(0, 1), "bits": [np.packbits(bits).tobytes()]})

    used = lookup.where(F.col("_piece").isNotNull()).select("_piece").mapInArrow(run, "part long, bit long").distinct()
    out = np.zeros((1 << (FILTER_BITS - 16), 1 << 13), np.uint8)
    for row in used.groupBy("part").applyInArrow(packed, "part long, bits binary").collect():
        out[row["part"]] = np.frombuffer(row["bits"], np.uint8)
    return out.ravel()


def _own_hashes(pieces: Sequence[str]) -> np.ndarray:
    """Hash of each piece, which is a whole text here."""
    out = np.zeros(len(pieces), np.uint64)
    places = Places(pieces)
    for width in set(map(len, pieces)) - {0}:
        row, at, hashes = places.pieces(width)
        size = np.fromiter(map(len, pieces), np.int64, len(pieces))[row]
        out[row[size == width]] = hashes[size == width]
    return out


def known_pieces(parts: DataFrame, segment: str, widths: Sequence[int], bits: np.ndarray) -> DataFrame:
    """The columns of ``parts`` but ``segment``, with ``_piece``: a row per distinct piece that passes the filter.

    A task gives each row back once, with its pieces as an array, so no other column is copied for every piece.
    """
    at = parts.columns.index(segment)
    rest = [c for c in parts.columns if c != segment]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = [i for i in range(batch.num_columns) if i != at]
            for start, some in chunks(batch.column(at)):
                places = Places(some)
                found: list[set[str]] = [set() for _ in some]
                for width in widths:
                    row, place, hashes = places.pieces(width)
                    bit = filter_bit(hashes)
                    passed = (bits[bit >> 3] >> (7 - (bit & 7)).astype(np.uint8)) & 1 == 1
                    for r, a in zip(row[passed].tolist(), place[passed].tolist()):
                        found[r].add(some[r][a : a + width])
                yield pa.RecordBatch.from_arrays(
                    [
                        *(batch.column(i).slice(start, len(some)) for i in kept),
                        pa.array([sorted(f) for f in found], pa.list_(pa.string())),
                    ],
                    [*rest, "_pieces"],
                )

    schema = T.StructType([*parts.select(*rest).schema.fields, T.StructField("_pieces", T.ArrayType(T.StringType()))])
    return parts.mapInArrow(run, schema).select(*rest, F.explode("_pieces").alias("_piece"))


class Known(NamedTuple):
    """Names of up to ``WHOLE`` characters: their lengths, and for every slot whether a name begins or is hashed there."""

    lengths: list[int]
    begins: np.ndarray
    wholes: np.ndarray
    bits: int


def table_bits(names: int) -> int:
    return min(MOST_BITS, max(LEAST_BITS, int(names).bit_length() + SPARE_BITS))


def _beginning(length: int) -> int:
    return max(w for w in BEGINNINGS if w <= length)


def _slot(keys: np.ndarray, bits: int) -> np.ndarray:
    return ((keys * np.uint64(0xBF58476D1CE4E5B9)) >> np.uint64(64 - bits)).view(np.int64)


def _key(values: np.ndarray, length: int) -> np.ndarray:
    return values + np.uint64((0x94D049BB133111EB * length) & (2**64 - 1))


def _roll(values: np.ndarray, codes: np.ndarray, j: int) -> None:
    """Take the character number ``j`` into the values, in place."""
    if j < EXACT:
        values <<= np.uint64(CHARACTER_BITS)
    else:
        values *= _FACTOR
    values += codes


def _codes(texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
    """The characters of several texts, one after the other, and where each text ends."""
    codes = np.frombuffer("".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
    return codes, np.cumsum(np.fromiter(map(len, texts), np.int64, len(texts)))


def name_hashes(names: Sequence[str], bits: int) -> tuple[np.ndarray, np.ndarray]:
    """Slot of the beginning of each name, and its key."""
    codes, ends = _codes(names)
    wide, size = codes.astype(np.uint64), np.diff(ends, prepend=0)
    slot, keys = np.zeros(len(names), np.int64), np.zeros(len(names), np.uint64)
    for length in np.unique(size).tolist():
        mine = np.flatnonzero(size == length)
        start, value = ends[mine] - length, np.zeros(len(mine), np.uint64)
        for j in range(length):
            _roll(value, wide[start + j], j)
            if j + 1 == _beginning(length):
                slot[mine] = _slot(_key(value, j + 1), bits)
        keys[mine] = _key(value, length)
    return slot, keys


def likely(codes: np.ndarray, ends: np.ndarray, known: Known) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """Per length of names: the texts and places where such a name may stand, and the key of what stands there."""
    wide = codes.astype(np.uint64)
    values, width = np.zeros(len(codes), np.uint64), 0
    for begin in sorted({_beginning(n) for n in known.lengths}):
        while width < begin:
            values = values[: max(0, len(codes) - width)]
            _roll(values, wide[width:], width)
            width += 1
        at = np.flatnonzero(known.begins[_slot(_key(values, begin), known.bits)])
        text, value, done = np.searchsorted(ends, at, side="right"), values[at], begin
        for length in (n for n in known.lengths if _beginning(n) == begin):
            inside = at + length <= ends[text]
            at, text, value = at[inside], text[inside], value[inside]
            if not len(at):
                break
            for j in range(done, length):
                _roll(value, wide[at + j], j)
            done = length
            key = _key(value, length)
            hit = np.flatnonzero(known.wholes[_slot(key, known.bits)])
            yield length, text[hit], at[hit], key[hit]


def _pairs(a: np.ndarray, b: np.ndarray, n: int, m: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct pairs of numbers below ``n`` and ``m``, in order."""
    pairs = a * m + b
    if n * m <= CELLS:
        cells = np.zeros(n * m, bool)
        cells[pairs] = True
        pairs = np.flatnonzero(cells)
    else:
        pairs = np.unique(pairs)
    return np.divmod(pairs, max(1, m))


def _same(a: np.ndarray, at: np.ndarray, b: np.ndarray, other: np.ndarray, length: int) -> np.ndarray:
    """Whether ``length`` characters are the same from ``at`` in ``a`` and from ``other`` in ``b`` on; their keys are."""
    same = np.ones(len(at), bool)
    for j in range(length if length > EXACT else 0):  # the keys are the strings
        same &= a[at + j] == b[other + j]
    return same


class NameTable:
    """Distinct names of up to ``WHOLE`` characters, to be found in texts by one task."""

    def __init__(self, names: pa.Array):
        self.names = names
        listed = names.to_pylist()
        self.codes, ends = _codes(listed)
        self.sizes = np.fromiter(map(len, listed), np.int64, len(listed))
        self.starts = ends - self.sizes
        self.bits = table_bits(len(listed))
        slot, self.keys = name_hashes(listed, self.bits)
        self.order = np.argsort(self.keys).astype(np.int32)
        self.first = np.full(1 << self.bits, -1, np.int32)
        self.first[_slot(self.keys, self.bits)] = np.arange(len(listed))
        begins = np.zeros(1 << self.bits, bool)
        begins[slot] = True
        self.known = Known(sorted(set(map(len, listed))), begins, self.first >= 0, self.bits)
        same = np.flatnonzero(np.diff(self.keys[self.order]) == 0)
        self.twins = {int(i): listed[i] for i in self.order[np.concatenate([same, same + 1])]}  # of one key: searched for

    def _equal_keys(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which keys some name has (one of the names, should several share it), and that name."""
        name = self.first[_slot(keys, self.bits)]
        equal = self.keys[name] == keys
        if not equal.all():  # the slot holds another name, or the key is no name's
            rest = np.flatnonzero(~equal)
            place = np.searchsorted(self.keys, keys[rest], sorter=self.order)
            name[rest] = self.order[np.minimum(place, len(self.order) - 1)]
            equal = self.keys[name] == keys
        return equal, name

    def found(self, texts: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """Text and name of every pair of which the text holds the name, each once, in the order of the texts."""
        codes, ends = _codes(texts)
        pairs = [(np.zeros(0, np.int64),) * 2]
        for length, text, at, key in likely(codes, ends, self.known):
            equal, name = self._equal_keys(key)
            equal &= self.sizes[name] == length
            if not equal.all():
                text, at, name = text[equal], at[equal], name[equal]
            same = _same(codes, at, self.codes, self.starts[name], length)
            pairs.append((text, name) if same.all() else (text[same], name[same]))
        for i, twin in self.twins.items():
            holds = np.flatnonzero([twin in text for text in texts])
            pairs.append((holds, np.full(len(holds), i)))
        text, name = (np.concatenate(x) for x in zip(*pairs))
        return _pairs(text, name, len(texts), len(self.names))


def names_in_texts(texts: DataFrame, key: str, text: str, name: str, shared: Broadcast) -> DataFrame:
    """(key, names): for each text that holds some of the shared names, those names, as an array."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = shared.value
        if "table" not in held:  # once per worker process, not once per task
            held["table"] = NameTable(held["names"])
        table = held["table"]
        for batch in batches:
            for start, some in chunks(batch.column(1)):
                parts = list(_slices(some, WHOLE - 1))
                found = [table.found(part) for part in parts]
                row, number = found[0] if len(found) == 1 else (0, np.unique(np.concatenate([n for _, n in found])))
                count = np.bincount(np.broadcast_to(row, len(number)), minlength=len(some))
                some_found = np.flatnonzero(count)
                ends = pa.array(np.append(0, np.cumsum(count[some_found])), pa.int32())
                lists = pa.ListArray.from_arrays(ends, table.names.take(pa.array(number)))
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(some_found + start)), lists], [key, name])

    return texts.select(key, text).mapInArrow(run, _listed(texts, key, name))


def known_names(words: DataFrame, name: str, lengths: Sequence[int], count: int) -> Known:
    """What :func:`blocks_of_texts` needs of any number of names; the tables have a bounded size."""
    bits = table_bits(count)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        used = np.zeros(2 << bits, bool)
        for batch in batches:
            for _, some in chunks(batch.column(0)):
                slot, keys = name_hashes(some, bits)
                used[slot] = True
                used[_slot(keys, bits) + (1 << bits)] = True
        for part in np.flatnonzero(used.reshape(-1, 1 << 16).any(1)).tolist():
            packed = np.packbits(used[part << 16 : (part + 1) << 16]).tobytes()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([packed], pa.binary())], ["part", "bits"])

    def either(parts: pa.Table) -> pa.Table:
        bits = np.bitwise_or.reduce([np.frombuffer(b, np.uint8) for b in parts["bits"].to_pylist()])
        return pa.table({"part": parts["part"].slice(0, 1), "bits": [bits.tobytes()]})

    schema = "part long, bits binary"
    found = words.select(name).mapInArrow(run, schema).groupBy("part").applyInArrow(either, schema).collect()
    used = np.zeros(2 << bits, bool)
    for row in found:
        used[row["part"] << 16 : (row["part"] + 1) << 16] = np.unpackbits(np.frombuffer(row["bits"], np.uint8)).astype(bool)
    return Known(sorted(lengths), used[: 1 << bits], used[1 << bits :], bits)


def _strings(some: Sequence[str], known: Known, seen: np.ndarray) -> Iterator[tuple[list[str], np.ndarray, np.ndarray]]:
    """Strings found in some texts that may be names, and the pairs of a string's number and a text that holds it.

    A string may come again. ``seen`` has a place for every slot, for the numbers of what was found there.
    """
    whole = "".join(some)
    codes, ends = _codes(some)
    for length, text, at, key in likely(codes, ends, known):
        slot, every = _slot(key, known.bits), np.arange(len(key))
        seen[slot] = every
        like = seen[slot]
        same = (key == key[like]) & _same(codes, at, codes, at[like], length)
        like[~same] = every[~same]  # another string in the same slot
        alone = np.flatnonzero(like == every)
        seen[slot[alone]] = 0
        every[alone] = np.arange(len(alone))
        strings = [whole[a : a + length] for a in at[alone].tolist()]
        yield strings, *_pairs(every[like], text, len(strings), len(some))


class Block:
    """Texts of a task that are looked at together: every string that may be a name, with the texts that hold it."""

    def __init__(self, known: Known) -> None:
        self.known, self.seen = known, np.zeros(1 << known.bits, np.int64)
        self.keys: list[pa.Array] = []
        self.rows = self.chars = self.found = 0
        self.numbers: dict[str, int] = {}
        self.pairs: list[np.ndarray] = []

    def add(self, keys: pa.Array, some: Sequence[str]) -> None:
        for part in _slices(some, WHOLE - 1):
            for strings, number, text in _strings(part, self.known, self.seen):
                mine = np.fromiter((self.numbers.setdefault(s, len(self.numbers)) for s in strings), np.int64, len(strings))
                self.pairs.append(mine[number] << 32 | (text + self.rows))
                self.found += len(text)
        self.keys.append(keys)
        self.rows += len(some)
        self.chars += sum(map(len, some))

    def full(self) -> bool:
        return self.chars >= BLOCK_CHARS or self.found >= BLOCK_FOUND

    def batch(self, number: int, names: Sequence[str]) -> pa.RecordBatch:
        """A row per string, with the texts that hold it, and a last one with the keys of the block's texts."""
        pairs = np.unique(np.concatenate([np.zeros(0, np.int64), *self.pairs]))
        ends = np.searchsorted(pairs, np.arange(len(self.numbers) + 1) << 32)
        at = pa.array((pairs & 0xFFFFFFFF).astype(np.int32))
        n = len(self.numbers)
        keys = pa.concat_arrays(self.keys)
        columns = [
            pa.array(np.full(n + 1, number)),
            pa.array([*self.numbers, None], pa.string()),
            pa.concat_arrays([pa.ListArray.from_arrays(pa.array(ends, pa.int32()), at), pa.nulls(1, pa.list_(pa.int32()))]),
            pa.ListArray.from_arrays(pa.array([0] * (n + 1) + [len(keys)], pa.int32()), keys),
        ]
        return pa.RecordBatch.from_arrays(columns, names)


def blocks_of_texts(texts: DataFrame, key: str, text: str, shared: Broadcast) -> DataFrame:
    """(_block, _piece, _at, _keys): per block of texts and string in them that may be one of the known names a row with the
    numbers of the texts that hold it; and a row per block with the keys of its texts."""
    names = ["_block", "_piece", "_at", "_keys"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, number = Known(*shared.value), TaskContext.get().partitionId() << 32
        block = Block(known)
        for batch in batches:
            for start, some in chunks(batch.column(1)):
                block.add(batch.column(0).slice(start, len(some)), some)
                if block.full():
                    yield block.batch(number, names)
                    number, block = number + 1, Block(known)
        if block.rows:
            yield block.batch(number, names)

    schema = T.StructType(
        [
            T.StructField("_block", T.LongType()),
            T.StructField("_piece", T.StringType()),
            T.StructField("_at", T.ArrayType(T.IntegerType())),
            T.StructField("_keys", T.ArrayType(texts.schema[key].dataType)),
        ]
    )
    return texts.select(key, text).mapInArrow(run, schema)


def names_by_text(found: DataFrame, keys: DataFrame, key: str, name: str) -> DataFrame:
    """(key, names) out of ``found`` (_of, name, _at) and the ``keys`` (_block, _keys) of the same blocks."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        lists = right["_at"].combine_chunks()
        text = lists.flatten().to_numpy()
        number = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy())
        held = left["_keys"].combine_chunks().flatten()
        count = np.bincount(text, minlength=len(held))
        some = np.flatnonzero(count)
        names = right[name].combine_chunks().take(pa.array(number[np.argsort(text, kind="stable")]))
        ends = pa.array(np.append(0, np.cumsum(count[some])), pa.int32())
        return pa.table([held.take(pa.array(some)), pa.ListArray.from_arrays(ends, names)], [key, name])

    element = keys.schema["_keys"].dataType.elementType
    schema = T.StructType([T.StructField(key, element), T.StructField(name, T.ArrayType(T.StringType()))])
    return keys.groupBy("_block").cogroup(found.groupBy("_of")).applyInArrow(run, schema)


def _listed(texts: DataFrame, key: str, name: str) -> T.StructType:
    return T.StructType([texts.schema[key], T.StructField(name, T.ArrayType(T.StringType()))])


def _with(df: DataFrame, *added: tuple[str, str]) -> T.StructType:
    new = [T.StructField(n, T.IntegerType() if t == "int" else T.StringType()) for n, t in added]
    return T.StructType([*df.schema.fields, *new])
