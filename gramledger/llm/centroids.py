"""Centroid clustering: rounds of exact assignment by the threshold algorithm, and of integer means.

Vectors are scaled to whole numbers, so every distance and every mean is exact and no order of summation shows.

Assignment. Each dimension has its list of centroid values in ascending order. For a vector, every list is walked
outward from the vector's own value, one centroid per step and dimension, nearest first. A centroid met for the first
time gets its exact distance. After a step, a centroid not met in any list is at least as far as the sum of the
squared gaps at the lists' frontiers; the walk of a vector stops when that sum is strictly greater than its best
distance, so that all ties have been met and the smaller number wins.

A round reads the vectors once, where they lie. A task sends one row per centroid and dimension, whatever the number
of vectors, and those are added up by Spark; the driver sees ``k`` times the number of dimensions.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramledger.llm.common import quoted, written

SCALE = 1024
#: Vectors walked at a time; some 20 arrays of this many rows are alive.
BLOCK = 4096
#: Below this size of a component, all sums of a walk are safe in 64 bits (up to 2^7 dimensions).
SAFE = 1 << 27
LARGEST = (1 << 63) - 1


def whole_numbers(vectors: DataFrame, dims: int, scale: int, vec_id: str, vector: str) -> DataFrame:
    """``vec_id`` and ``v``, the scaled components, of the vectors that take part."""
    def usable(x: Column) -> Column:
        scaled = x.cast("double") * float(scale)
        return F.coalesce((scaled >= -(2.0**63)) & (scaled < 2.0**63), F.lit(False))  # NaN is above all numbers

    column = F.col(quoted(vector))
    kept = vectors.where((F.size(column) == dims) & F.forall(column, usable))
    scaled = F.transform(column, lambda x: F.floor(x.cast("double") * float(scale)).cast("long"))
    return kept.select(F.col(quoted(vec_id)).alias("vec_id"), scaled.alias("v"))


def matrix(column: pa.Array, dims: int) -> np.ndarray:
    """The vectors of a batch as rows; as Python's own whole numbers if 64 bits might not do for the sums."""
    x = column.flatten().to_numpy(zero_copy_only=False).reshape(-1, dims)
    safe = x.size == 0 or (int(x.max()) < SAFE and int(x.min()) > -SAFE and dims <= 128)
    return x if safe else x.astype(object)


def nearest(x: np.ndarray, centroids: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Number of the nearest centroid of every row, the smaller one of equals, and the squared distance."""
    if x.dtype == object or np.abs(centroids.astype(object)).max() >= SAFE:
        x, centroids = x.astype(object), centroids.astype(object)
    rows, (k, dims) = len(x), centroids.shape
    order = np.argsort(centroids, axis=0, kind="stable")  # per dimension: which centroid is at which place
    lists = np.take_along_axis(centroids, order, axis=0)
    far = (1 << 200) if x.dtype == object else np.int64(1 << 40)
    lists = np.concatenate([np.full((1, dims), -far), lists, np.full((1, dims), far)]).astype(x.dtype)
    high = np.empty((rows, dims), np.int64)  # place in the list of the next value at or above the vector's
    for d in range(dims):
        high[:, d] = np.searchsorted(lists[1:-1, d], x[:, d]) + 1
    low = high - 1
    column = np.arange(dims)
    best = np.full(rows, (1 << 400) if x.dtype == object else LARGEST, x.dtype)
    which = np.full(rows, k, np.int64)
    met = np.zeros((rows, k), bool)
    walking = np.arange(rows)
    for _ in range(k):
        xs, lo, hi = x[walking], low[walking], high[walking]
        below, above = xs - lists[lo, column], lists[hi, column] - xs
        up = above < below
        gap = np.where(up, above, below)
        seen = np.zeros((len(walking), k), bool)
        np.put_along_axis(seen, order[np.where(up, hi, lo) - 1, column], True, axis=1)
        seen &= ~met[walking]
        met[walking] |= seen
        for c in np.flatnonzero(seen.any(axis=0)):
            some = walking[seen[:, c]]
            distance = ((x[some] - centroids[c]) ** 2).sum(axis=1)
            better = (distance < best[some]) | ((distance == best[some]) & (c < which[some]))
            best[some[better]], which[some[better]] = distance[better], c
        high[walking], low[walking] = hi + up, lo - ~up
        frontier = (gap**2).sum(axis=1)
        walking = walking[~(frontier > best[walking]).astype(bool)]
        if not len(walking):
            break
    return which, best


def blocks(batch: pa.RecordBatch, dims: int) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    for start in range(0, batch.num_rows, BLOCK):
        part = batch.slice(start, BLOCK)
        yield part, matrix(part.column("v"), dims)


def moved(table: DataFrame, centroids: np.ndarray) -> np.ndarray:
    """Each centroid at the floored mean of its vectors; one without vectors stays."""
    k, dims = centroids.shape

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros((k, dims), object), np.zeros(k, np.int64)
        for batch in batches:
            for _, x in blocks(batch, dims):
                which, _ = nearest(x, centroids)
                count += np.bincount(which, minlength=k)
                for c in np.unique(which):
                    total[c] += x[which == c].sum(axis=0).astype(object)
        some = np.flatnonzero(count)
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(np.repeat(some, dims), pa.int32()),
                pa.array(np.tile(np.arange(dims), len(some)), pa.int32()),
                pa.array([int(s) for s in total[some].ravel()], pa.decimal128(38, 0)),
                pa.array(np.repeat(count[some], dims), pa.int64()),
            ],
            ["cluster", "dim", "total", "n"],
        )

    sent = table.select("v").mapInArrow(run, "cluster int, dim int, total decimal(38,0), n long")
    means = centroids.copy()
    for row in sent.groupBy("cluster", "dim").agg(F.sum("total").alias("total"), F.sum("n").alias("n")).collect():
        means[row["cluster"], row["dim"]] = int(row["total"]) // row["n"]  # k * dims rows
    return means


def cluster(
    vectors: DataFrame,
    k: int = 8,
    rounds: int = 10,
    dims: int = 64,
    scale: int = SCALE,
    salt: str = "3:",
    vec_id: str = "vec_id",
    vector: str = "embedding",
) -> DataFrame:
    """One row per vector that takes part: vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256.

    A vector takes part if it has ``dims`` components, none null, NaN or infinite, and all of them still fit 64 bits
    when scaled. The ``k`` vectors with the smallest sha256 of ``salt`` and their id (a null id is the empty text)
    are the first centroids; ids that tie go by their components. Fewer vectors give fewer centroids. Repeated rows
    are vectors of their own and may be centroids that are equal, of which the smaller number gets all vectors. An
    empty table gives no rows. Other columns are not read. A distance or a sum beyond 64 bits is given as the largest
    long; which centroid is nearest is still decided exactly.
    """
    spark = vectors.sparkSession
    table = written(whole_numbers(vectors, dims, scale, vec_id, vector), "vectors")
    name = F.concat(F.lit(salt), F.coalesce(F.col("vec_id").cast("string"), F.lit("")))
    first = table.orderBy(F.sha2(name.cast("binary"), 256), "vec_id", "v").limit(k).collect()
    schema = T.StructType(
        [
            table.schema["vec_id"],
            T.StructField("cluster", T.IntegerType()),
            T.StructField("distance", T.LongType()),
            T.StructField("cluster_inertia", T.LongType()),
            T.StructField("inertia", T.LongType()),
            T.StructField("centroid_sha256", T.StringType()),
        ]
    )
    if not first:
        return spark.createDataFrame([], schema)
    centroids = np.array([row["v"] for row in first], np.int64)
    for _ in range(rounds):
        centroids = moved(table, centroids)

    def last(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, x in blocks(batch, dims):
                which, distance = nearest(x, centroids)
                if distance.dtype == object:
                    distance = np.array([min(int(d), LARGEST) for d in distance], np.int64)
                yield pa.RecordBatch.from_arrays(
                    [part.column("vec_id"), pa.array(which, pa.int32()), pa.array(distance, pa.int64())],
                    ["vec_id", "cluster", "distance"],
                )

    found = written(table.mapInArrow(last, T.StructType(schema.fields[:3])), "assigned")
    exact = F.sum(F.col("distance").cast("decimal(38,0)")).alias("total")
    sums = {row["cluster"]: int(row["total"]) for row in found.groupBy("cluster").agg(exact).collect()}
    return found.select(
        "vec_id",
        "cluster",
        "distance",
        looked_up({c: min(n, LARGEST) for c, n in sums.items()}, "long"),
        F.lit(min(sum(sums.values()), LARGEST)).cast("long").alias("inertia"),
        looked_up({c: digest(centroids[c]) for c in sums}, "string"),
    ).toDF(*schema.names)


def looked_up(values: dict[int, object], kind: str) -> Column:
    """The value of the row's cluster."""
    pairs = [F.lit(x).cast(t) for c, v in values.items() for x, t in ((c, "int"), (v, kind))]
    return F.element_at(F.create_map(*pairs), F.col("cluster"))


def digest(centroid: Sequence[int]) -> str:
    return sha256(",".join(str(int(x)) for x in centroid).encode()).hexdigest()


def cluster_sql(k: int = 8, rounds: int = 10, dims: int = 64, scale: int = SCALE, salt: str = "3:") -> str:
    """The same as SQL: every distance of every round, without lists or stopping."""
    steps = [
        f"""kept AS MATERIALIZED (
        SELECT row_number() OVER (ORDER BY sha256('{salt}' || vec_id::VARCHAR), vec_id) - 1 AS r, vec_id,
               list_transform(embedding, lambda x: floor({scale} * x::DOUBLE)::HUGEINT) AS v
        FROM embeddings WHERE len(embedding) = {dims}
          AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x::DOUBLE))) = {dims}),
    parts AS MATERIALIZED (SELECT r, d, v[d] AS x FROM kept, unnest(range(1, {dims} + 1)) AS t(d)),
    c0 AS MATERIALIZED (SELECT r::INTEGER AS c, d, x FROM parts WHERE r < {k})"""
    ]
    for i in range(rounds + 1):
        steps.append(
            f"""a{i} AS MATERIALIZED (SELECT r, arg_min(c, (s, c)) AS c, min(s) AS s FROM (
        SELECT r, c, sum((parts.x - c{i}.x) * (parts.x - c{i}.x)) AS s FROM parts JOIN c{i} USING (d) GROUP BY r, c)
        GROUP BY r)"""
        )
        if i < rounds:
            steps.append(
                f"""c{i + 1} AS MATERIALIZED (SELECT c, d, coalesce(m, x) AS x FROM c{i} LEFT JOIN (
        SELECT c, d, (sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*) AS m
        FROM parts JOIN a{i} USING (r) GROUP BY c, d) USING (c, d))"""
            )
    return f"""
    WITH {", ".join(steps)},
    totals AS (SELECT c, sum(s)::BIGINT AS n FROM a{rounds} GROUP BY c),
    names AS (SELECT c, sha256(string_agg(x::VARCHAR, ',' ORDER BY d)) AS h FROM c{rounds} GROUP BY c)
    SELECT vec_id, c::INTEGER AS cluster, s::BIGINT AS distance, n AS cluster_inertia,
           (SELECT sum(n)::BIGINT FROM totals) AS inertia, h AS centroid_sha256
    FROM kept JOIN a{rounds} USING (r) JOIN totals USING (c) JOIN names USING (c)"""
