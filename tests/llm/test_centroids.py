"""Centroid clustering against plain rounds over Python's whole numbers."""

from __future__ import annotations

import hashlib
import math

import numpy as np
import pytest

from gramledger.llm import centroids

SCHEMA = "vec_id long, embedding array<double>, cluster string, v int"


def plain(rows, k, rounds, dims):
    """Distances to all centroids, no lists, no early stop."""
    kept = [
        (i, [math.floor(1024 * x) for x in e])
        for i, e, *_ in rows
        if e is not None and len(e) == dims and all(x is not None and math.isfinite(x) for x in e)
    ]
    kept = [(i, v) for i, v in kept if all(-(2**63) <= x < 2**63 for x in v)]
    name = lambda i: hashlib.sha256(f"3:{'' if i is None else i}".encode()).hexdigest()
    order = sorted(kept, key=lambda r: (name(r[0]), r[0] is not None, r[0] or 0, r[1]))
    centre = [list(v) for _, v in order[:k]]
    assign = lambda v: min((sum((a - b) ** 2 for a, b in zip(v, c)), n) for n, c in enumerate(centre))
    for _ in range(rounds):
        found = [assign(v)[1] for _, v in kept]
        for n in range(len(centre)):
            mine = [v for (_, v), f in zip(kept, found) if f == n]
            if mine:
                centre[n] = [sum(x) // len(mine) for x in zip(*mine)]
    out = [(i, *assign(v)[::-1]) for i, v in kept]
    top = 2**63 - 1
    inertia = {n: min(top, sum(min(d, top) for _, f, d in out if f == n)) for _, n, _ in out}
    whole = min(top, sum(min(d, top) for *_, d in out))
    sha = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centre]
    return sorted(((i, n, min(d, top), inertia[n], whole, sha[n]) for i, n, d in out), key=str)


def test_nearest_with_ties_and_early_stops():
    rng = np.random.default_rng(5)
    for spread in (2, 40, 5000):
        x, c = rng.integers(-spread, spread, (700, 6)), rng.integers(-spread, spread, (9, 6))
        c[7] = c[2]
        distance = ((x[:, None] - c[None]) ** 2).sum(axis=2)
        which, best = centroids.nearest(x, c)
        assert (which == distance.argmin(axis=1)).all() and (best == distance.min(axis=1)).all()
        exact, _ = centroids.nearest(x.astype(object), c)
        assert (exact == which).all()


@pytest.mark.parametrize("k", [1, 5])
def test_rounds_on_awkward_rows(spark, k):
    rng = np.random.default_rng(7)
    rows = [(i, rng.normal(size=4).tolist(), "mine", 1) for i in range(60)]
    rows += [rows[3], rows[3], (3, [0.5, 0.5, 0.5, 0.5], None, None), (None, [1.0, -2.0, 0.25, 0.0], "x", 1)]
    rows += [(70, None, "x", 1), (71, [], "x", 1), (72, [1.0, None, 0.0, 0.0], "x", 1), (73, [1.0] * 5, "x", 1)]
    rows += [(74, [float("nan"), 0.0, 0.0, 0.0], "x", 1), (75, [0.0, float("inf"), 0.0, 0.0], "x", 1)]
    rows += [(76, [0.0, 0.0, 0.0, 0.0], "x", 1), (77, [1e14, 2.0, -1e15, 0.0], "x", 1), (78, [1e300, 0.0, 0.0, 0.0], "x", 1)]
    frame = spark.createDataFrame(rows, SCHEMA).repartition(4)
    found = centroids.cluster(frame, k=k, rounds=4, dims=4)
    assert found.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256"]
    assert sorted(map(tuple, found.collect()), key=str) == plain(rows, k, 4, 4)


def test_few_and_no_vectors(spark):
    frame = spark.createDataFrame([(5, [1.0, 2.0], "a", 1), (6, [1.0, 2.0], "a", 1)], SCHEMA)
    assert [tuple(r)[1:5] for r in centroids.cluster(frame, k=8, dims=2).collect()] == [(0, 0, 0, 0)] * 2
    assert centroids.cluster(frame.where("vec_id > 9"), k=8, dims=2).count() == 0
