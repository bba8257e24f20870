"""Approximate nearest neighbours by a forest of hash prefixes (LSH forest).

A tree gives every vector a long string of bits, each the side of a random hyperplane it lies on, and is the sorted
array of these strings. A query goes down each tree to its longest matching prefix; then all trees are climbed together,
one bit at a time, until the prefixes match enough vectors in all, which is a share of the shard's and not a fixed
count, so that recall does not fall as shards fill. Those are compared by their exact cosine.

The vectors are dealt to shards by a hash of their id, each with a forest of its own; the query set visits every shard
and the best of all shards remain. A task reads its rows as a stream, for each shard the vectors first and then the
queries, of which it holds no more than a block at a time. There is no cap on a prefix: the last step up takes all it finds. Equal
vectors are one entry of the index that stands for its smallest ids, as many as can be in a result, so a hot vector
costs a row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from gramledger.llm.common import quoted, written

TREES = 24
DEPTH = 32
#: Vectors per shard.
SHARD_ROWS = 4096
#: Hits per query and shard before the climb stops, summed over the trees: this many times the shard's vectors, and at
#: least ENOUGH. Chosen by recall against brute force on a table of 2,000 and on full shards.
SHARE = 1.2
ENOUGH = 400
#: Queries that visit a shard together, and those that a task holds.
QUERY_BLOCK = 512
SEED = 7


def hyperplanes(size: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64([SEED, size])).standard_normal((size, TREES * DEPTH))


def strings(vectors: np.ndarray, planes: np.ndarray) -> np.ndarray:
    """Hash string of every vector in every tree, as numbers: one row per tree."""
    side = (vectors @ planes > 0).reshape(len(vectors), TREES, DEPTH)
    return (side * (np.uint64(1) << np.arange(DEPTH - 1, -1, -1, dtype=np.uint64))).sum(2, dtype=np.uint64).T.copy()


class Forest:
    def __init__(self, vectors: np.ndarray):
        self.vectors = vectors
        self.norms = np.sqrt((vectors * vectors).sum(1))
        self.planes = hyperplanes(vectors.shape[1])
        keys = strings(vectors, self.planes)
        self.order = np.argsort(keys, axis=1, kind="stable")
        self.keys = np.take_along_axis(keys, self.order, 1)

    def candidates(self, queries: np.ndarray, enough: int) -> list[np.ndarray]:
        """Entries found for each query: all that share its prefixes at the depth where there are enough."""
        keys = strings(queries, self.planes)
        low = np.zeros((TREES, len(queries)), np.int64)
        high = np.full((TREES, len(queries)), len(self.vectors))
        left = np.arange(len(queries))
        for depth in range(DEPTH, -1, -1):
            drop = np.uint64(DEPTH - depth)
            for t in range(TREES):
                prefix = keys[t, left] >> drop << drop
                last = prefix | ((np.uint64(1) << drop) - np.uint64(1))
                low[t, left] = np.searchsorted(self.keys[t], prefix, "left")
                high[t, left] = np.searchsorted(self.keys[t], last, "right")
            left = left[(high[:, left] - low[:, left]).sum(0) < enough]
            if not len(left):
                break
        return [
            np.unique(np.concatenate([self.order[t, low[t, q] : high[t, q]] for t in range(TREES)]))
            for q in range(len(queries))
        ]

    def scores(self, query: np.ndarray, at: np.ndarray) -> np.ndarray:
        return (self.vectors[at] @ query) / (self.norms[at] * np.sqrt(query @ query))


def valid(vectors: DataFrame, vec_id: str, embedding: str) -> DataFrame:
    """(vec_id, v) of the vectors that take part: no null or non-finite component, not all zero."""
    v = F.col(quoted(embedding)).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        vectors.select(F.col(quoted(vec_id)).cast("long").alias("vec_id"), v.alias("v"))
        .where(F.col("vec_id").isNotNull() & F.col("v").isNotNull())
        .where(~bad & F.exists("v", lambda x: x != 0))
    )


class Shard:
    """The vectors of a shard, gathered part by part, and a forest for each length of them."""

    def __init__(self):
        self.parts: list[tuple[pa.Array, pa.Array]] = []
        self.forests: dict[int, tuple[Forest, list[list[int]]]] | None = None

    def add(self, part: pa.RecordBatch) -> None:
        self.parts.append((part.column(3), part.column(4)))

    def forest(self, width: int) -> tuple[Forest, list[list[int]]] | None:
        if self.forests is None:
            self.forests = {}
            if self.parts:
                vectors, ids = (pa.concat_arrays(x) for x in zip(*self.parts))
                for w, (at, values) in by_width(vectors).items():
                    self.forests[w] = Forest(values), ids.take(pa.array(at)).to_pylist()
            self.parts = []
        return self.forests.get(width)


def by_width(vectors: pa.Array) -> dict[int, tuple[np.ndarray, np.ndarray]]:
    """For each length of vectors, where they are and their numbers, one row per vector."""
    widths = np.diff(vectors.offsets.to_numpy())
    found = {}
    for width in np.unique(widths).tolist():
        at = np.flatnonzero(widths == width)
        found[width] = at, vectors.take(pa.array(at)).flatten().to_numpy().astype(np.float64).reshape(-1, width)
    return found


def blocks(batch: pa.RecordBatch, limit: int) -> Iterator[pa.RecordBatch]:
    """Slices of at most ``limit`` rows that are all of one shard, and all vectors or all queries."""
    shard, asks = batch.column(0).to_numpy(), batch.column(1).to_numpy(zero_copy_only=False)
    edges = np.flatnonzero((shard[1:] != shard[:-1]) | (asks[1:] != asks[:-1])) + 1
    for a, b in zip([0, *edges.tolist()], [*edges.tolist(), batch.num_rows]):
        for start in range(a, b, limit):
            yield batch.slice(start, min(limit, b - start))


def answers(shard: Shard, asked: pa.RecordBatch, k: int, enough: int, share: float) -> pa.RecordBatch:
    """(query_id, vec_id, score): the ``k`` best of the shard for each query of a block."""
    out: list[tuple[int, int, float]] = []
    for width, (rows, queries) in by_width(asked.column(3)).items():
        known_here = shard.forest(width)
        if known_here is None:
            continue
        forest, ids = known_here
        names = asked.column(2).take(pa.array(rows)).to_pylist()
        hits = max(enough, int(share * len(forest.vectors)))
        for q, at in enumerate(forest.candidates(queries, hits)):
            score = forest.scores(queries[q], at)
            best: list[tuple[float, int]] = []
            own, floor = names[q], np.inf
            for i in np.argsort(-score, kind="stable").tolist():
                s = float(score[i])
                if len(best) > k and s < floor:  # equal scores go on, since the smaller id wins
                    break
                known = ids[at[i]]
                if own in known and np.array_equal(forest.vectors[at[i]], queries[q]):
                    known = known.copy()
                    known.remove(own)
                best += [(s, other) for other in known]
                floor = s
            best.sort(key=lambda b: (-b[0], b[1]))
            out += [(own, other, s) for s, other in best[:k]]
    kinds = (pa.int64(), pa.int64(), pa.float64())
    return pa.RecordBatch.from_arrays(
        [pa.array([o[i] for o in out], kind) for i, kind in enumerate(kinds)], ["query_id", "vec_id", "score"]
    )


def nearest(
    vectors: DataFrame,
    queries: DataFrame | None = None,
    k: int = 5,
    every: int = 50,
    vec_id: str = "vec_id",
    embedding: str = "embedding",
    enough: int = ENOUGH,
    shard_rows: int = SHARD_ROWS,
    share: float = SHARE,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` best found for each query, by cosine, ties to the smaller id.

    Queries are the rows whose id is divisible by ``every`` unless given. A row is no candidate of its own query;
    other rows of the same id are, each for itself. Vectors that are null, zero or hold null or non-finite components take no
    part, nor do null ids; vectors of another length than the query's are not compared. Empty tables give no rows.
    """
    rows = valid(vectors, vec_id, embedding)
    asked = (
        rows.where(F.col("vec_id") % every == 0) if queries is None else valid(queries, vec_id, embedding)
    ).dropDuplicates(["vec_id", "v"])
    # copies of a vector: the smallest k + 1 ids can be in a result, one of them being the query itself
    mark = F.xxhash64("v").alias("mark")
    few = Window.partitionBy("mark", "v").orderBy("vec_id")
    entries = (
        rows.select(mark, "v", "vec_id")
        .withColumn("n", F.row_number().over(few))
        .where(F.col("n") <= k + 1)
        .groupBy("mark", "v")
        .agg(F.sort_array(F.collect_list("vec_id")).alias("ids"))
    )
    entries = written(entries.drop("mark"), "entries")
    asked = written(asked, "queries")
    total = entries.count()
    shards = max(1, -(-total // shard_rows))
    shard = F.pmod(F.xxhash64("v", F.lit(1)), F.lit(shards))
    dealt = entries.select(shard.alias("shard"), F.lit(False).alias("asks"), F.lit(None).cast("long").alias("vec_id"), "v", "ids")
    every_shard = asked.select(
        F.explode(F.sequence(F.lit(0).cast("long"), F.lit(shards - 1).cast("long"))).alias("shard"),
        F.lit(True).alias("asks"),
        "vec_id",
        "v",
        F.lit(None).cast("array<bigint>").alias("ids"),
    )
    # a shard's rows come one after the other, its vectors before the queries
    stream = dealt.union(every_shard).repartition("shard").sortWithinPartitions("shard", "asks")

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, shard = -1, None
        for batch in batches:
            for part in blocks(batch, QUERY_BLOCK):
                if part.column(0)[0].as_py() != at:
                    at, shard = part.column(0)[0].as_py(), Shard()
                if part.column(1)[0].as_py():
                    yield answers(shard, part, k, enough, share)
                else:
                    shard.add(part)

    found = stream.mapInArrow(search, "query_id long, vec_id long, score double")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        found.withColumn("rank", F.row_number().over(order))
        .where(F.col("rank") <= k)
        .select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")
    )
