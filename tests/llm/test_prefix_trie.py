"""The trie against one of plain dictionaries, with conversations cut over tasks and shards."""

from __future__ import annotations

import hashlib
import random
import re
import zlib
from collections import defaultdict

import numpy as np
import pytest

from gramledger import session
from gramledger.llm import prefix_trie

SCHEMA = "conv_id long, turn long, role string, text string, depth int, conv string"


def plain(rows):
    turns = defaultdict(list)
    for conv, turn, role, text, *_ in rows:
        if conv is not None:
            role, text = role or "", text or ""
            tie = hashlib.md5(f"{len(role)}:{role}{text}".encode()).hexdigest()
            turns[conv].append(((turn is not None, turn or 0, tie), (role, text)))
    turns = {c: [x for _, x in sorted(t)] for c, t in turns.items()}
    members = defaultdict(list)
    ends = defaultdict(list)
    for c in sorted(turns):
        h = zlib.crc32(str(c).encode()) % 4
        first = c - int(np.fmod(c, 20))
        whole = tuple(turns.get(first, [])[:h] + turns[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children = defaultdict(list)
    for q in members:
        if q:
            children[q[:-1]].append(q)
    saved, leaves = {}, {}
    for q in sorted(members, key=len, reverse=True):
        words = len(re.findall("[^\x20\x09-\x0d]+", q[-1][1])) if q else 0
        saved[q] = (len(members[q]) - 1) * words + sum(saved[k] for k in children[q])
        leaves[q] = sum(leaves[k] for k in children[q]) if children[q] else 1
    return sorted(
        (
            (min(members[q]), len(q), min(members[q[:-1]]) if q else None, len(members[q]), len(children[q]), leaves[q],
             saved[q], hashlib.sha256(",".join(map(str, sorted(ends[q]))).encode()).hexdigest())
            for q in members
        ),
        key=str,
    )


def rows():
    rng = random.Random(2)
    texts = ["a b", "c", "", None, "d  e\tf", "g h", "x " * 300]
    out = []
    for c in [*range(-45, 130), *range(400, 420)]:
        for t in range(rng.randrange(1, 7)):
            out.append((c, rng.choice([t, t, t, None]), rng.choice(["user", "bot", None]), rng.choice(texts), 1, "x"))
    for c in (140, 141, 143, 300):  # long ones that share most of their turns
        out += [(c, t, "user", f"t{t % 5}" if t < 900 else f"{c} {t}", 1, "x") for t in range(1000)]
    out += [(500 + c, t, "user", "same all over", 1, "x") for c in range(300) for t in range(3)]
    out += [(None, 1, "user", "no conversation", 1, "x"), out[0], out[0], out[7], (900, None, None, None, None, None)]
    return out


@pytest.mark.parametrize("adaptive, shard", [(True, prefix_trie.SHARD), (False, 97)])
def test_equals_dictionaries(spark, adaptive, shard):
    data = rows()
    frame = spark.createDataFrame(data, SCHEMA).repartition(5)
    with session.settings(spark, {"spark.sql.adaptive.enabled": adaptive, "spark.sql.shuffle.partitions": 7}):
        found = prefix_trie.trie(frame, shard=shard)
        assert sorted(map(tuple, found.collect()), key=str) == plain(data)


def test_heavy_parents(spark, monkeypatch):
    monkeypatch.setattr(prefix_trie, "HEAVY", 3)
    data = rows()[:900]
    found = prefix_trie.trie(spark.createDataFrame(data, SCHEMA))
    assert sorted(map(tuple, found.collect()), key=str) == plain(data)


def test_one_conversation_holds_nearly_all(spark):
    data = [(7, t, "user", str(t % 3), 1, "x") for t in range(6000)] + [(c, 0, "user", "0", 1, "x") for c in range(40)]
    with session.settings(spark, {"spark.sql.adaptive.enabled": False}):
        found = prefix_trie.trie(spark.createDataFrame(data, SCHEMA).repartition(6), shard=500)
        got = sorted(map(tuple, found.collect()), key=str)
    members = plain(data[-40:] + data[:60])  # the brute force holds all prefixes, so it gets a shorter one
    shorter = prefix_trie.trie(spark.createDataFrame(data[-40:] + data[:60], SCHEMA))
    assert sorted(map(tuple, shorter.collect()), key=str) == members
    assert len(got) - len(members) == 6000 - 60 and max(r[1] for r in got) - max(r[1] for r in members) == 6000 - 60


def test_turnless_and_empty(spark):
    short = next(c for c in range(1, 20) if zlib.crc32(str(c).encode()) % 4)
    data = [(short, 0, "user", "taken away", 1, "x")]
    found = prefix_trie.trie(spark.createDataFrame(data, SCHEMA)).collect()
    assert list(map(tuple, found)) == plain(data) and len(found) == 1
    assert prefix_trie.trie(spark.createDataFrame([], SCHEMA)).count() == 0


def test_slots_are_minimal_and_checked():
    rng = np.random.default_rng(3)
    keys = rng.integers(0, 2**62, (5000, 2)).astype(np.uint64)
    slots = prefix_trie.Slots(keys)
    assert sorted(slots.find(keys).tolist()) == list(range(5000))
    assert (slots.find(keys + np.uint64(1)) == -1).all() and (slots.find(keys[:0]) == -1).all()


def test_bases_change_if_keys_clash(spark, monkeypatch):
    weak = prefix_trie.Powers

    class Weak(weak):
        def __init__(self, seed):
            super().__init__(seed)
            if seed == 20240601:
                self.base = np.ones(4, np.uint64)  # the order of turns does not matter any more

    monkeypatch.setattr(prefix_trie, "Powers", Weak)
    data = [(c, t, "user", x, 1, "x") for c, q in ((0, "abc"), (20, "bac"), (40, "cab")) for t, x in enumerate(q)]
    found = prefix_trie.trie(spark.createDataFrame(data, SCHEMA))
    assert sorted(map(tuple, found.collect()), key=str) == plain(data)
