"""What several operators share: passes over whole texts, words as 64-bit keys, and the held-out split."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramledger.session import materialize, settings

#: Bytes of text that a Python worker turns into arrays at once, which take some 50 times as much. One longer text is
#: taken alone.
CHUNK = 1 << 20

#: White space that separates words: space and the control characters 9 to 13.
SPACES = (9, 10, 11, 12, 13, 32)


#: Lets Spark delete a finished query's shuffle files at once, not when the driver happens to collect its garbage.
TIDY = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": True}


def written(df: DataFrame, tag: str) -> DataFrame:
    """``df`` written to the shared folder and read back; its shuffle files are not needed any more and go."""
    with settings(df.sparkSession, TIDY):
        return materialize(df, tag)


def discard(*tables: DataFrame) -> None:
    """Delete tables that :func:`written` made, once everything that reads them has been written itself.

    No lineage leads to them then, so a lost executor needs none of their files again.
    """
    for table in tables:
        spark = table.sparkSession
        for name in {file.rsplit("/", 1)[0] for file in table.inputFiles()}:
            path = spark._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def unused(names: Sequence[str], wanted: str) -> str:
    """``wanted``, with underscores added until no column has the name (names ignore case)."""
    taken = {n.lower() for n in names}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def remainder(doc_id: Column, parts: int) -> Column:
    """crc32 of the id as text, modulo ``parts``; a null id counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % parts


def cut(batch: pa.RecordBatch, column: int, limit: int = CHUNK) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with at most ``limit`` bytes of text each, or one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    start, held = 0, 0
    for i, n in enumerate(sizes.tolist()):
        if held and held + n > limit:
            yield batch.slice(start, i - start)
            start, held = i, 0
        held += n
    if start < batch.num_rows:
        yield batch.slice(start)


def map_texts(
    docs: DataFrame,
    kernel: Callable[[], Callable[[pa.Array], list[pa.Array]]],
    fields: Sequence[tuple[str, str]],
    text: str = "text",
    carry: Sequence[str] = ("doc_id",),
    limit: int = CHUNK,
) -> DataFrame:
    """One row per row of ``docs``: the columns of ``carry``, then ``fields`` as the kernel computes them.

    ``kernel()`` is called once per task and returns a function from an array of texts to one array per field.
    Rows stay where they are; nothing is shuffled.
    """
    columns = list(carry) if text in carry else [*carry, text]
    at, kept = columns.index(text), len(carry)
    added = T.StructType([T.StructField(n, T._parse_datatype_string(t)) for n, t in fields])
    schema = T.StructType([*docs.select(*map(quoted, carry)).schema.fields, *added.fields])
    names = [f"c{i}" for i in range(len(schema))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = kernel()
        for batch in batches:
            for part in cut(batch, at, limit):
                yield pa.RecordBatch.from_arrays([*part.columns[:kept], *work(part.column(at))], names)

    plain = docs.select(*(F.col(quoted(c)).alias(f"c{i}") for i, c in enumerate(columns)))
    result = plain.mapInArrow(run, T.StructType([T.StructField(n, f.dataType) for n, f in zip(names, schema)]))
    return result.toDF(*(f.name for f in schema))


def quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def as_bytes(texts: pa.Array) -> list[bytes]:
    """UTF-8 bytes of every text; null is empty."""
    return [b or b"" for b in texts.cast(pa.binary()).to_pylist()]


def joined(texts: Sequence[bytes], before: bytes = b"", after: bytes = b"\n") -> tuple[np.ndarray, np.ndarray]:
    """All texts in one array of bytes, and where each starts; ``before`` and ``after`` surround each of them."""
    buffer = np.frombuffer(b"".join(part for t in texts for part in (before, t, after)), np.uint8)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + len(before) + len(after)
    starts = np.concatenate(([0], np.cumsum(sizes)[:-1])) + len(before) if len(texts) else np.zeros(0, np.int64)
    return buffer, starts


def mixed(x: np.ndarray) -> np.ndarray:
    """Bijective scrambling of 64-bit values, so that any of their bits may be used."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def word_table(separators: Sequence[int]) -> np.ndarray:
    """For each byte, whether it is part of a word."""
    table = np.ones(256, bool)
    table[list(separators)] = False
    return table


_seeds = np.random.Generator(np.random.PCG64(20240501))
_LETTER = _seeds.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_PLACE = _seeds.integers(1, 2**63, 4096, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def word_keys(buffer: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and 64-bit key of every word of ``buffer``.

    The key is a multilinear hash of the word's bytes: letters and places have random odd factors.
    """
    inside = is_word[buffer]
    edge = np.flatnonzero(np.diff(inside, prepend=False, append=False))
    starts, ends = edge[::2], edge[1::2]
    if not len(starts):
        return starts, ends, np.zeros(0, np.uint64)
    sizes = ends - starts
    first = np.concatenate(([0], np.cumsum(sizes)[:-1]))
    letters = _LETTER[buffer[inside]]
    place = np.arange(len(letters), dtype=np.int64) - np.repeat(first, sizes)
    if sizes.max() > len(_PLACE):  # places repeat in very long words; their number of rounds is a factor too
        letters *= mixed((place // len(_PLACE)).astype(np.uint64)) * np.uint64(2) + np.uint64(1)
    letters *= _PLACE[place % len(_PLACE)]
    return starts, ends, mixed(np.add.reduceat(letters, first) + sizes.astype(np.uint64))


def sums(values: np.ndarray, first: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sum of each run of ``counts[i]`` values that starts at ``first[i]``; 0 for an empty run."""
    total = np.concatenate((np.zeros(1, values.dtype), np.cumsum(values)))
    return total[first + counts] - total[first]
