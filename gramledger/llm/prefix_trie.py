"""Prefix trie of conversations over flat arrays behind a minimal perfect hash.

A node is a distinct sequence of first turns. Its key is a digest that can be computed piecewise: the turns' keys times
powers of a base, in four prime fields. Conversations are range-partitioned by id and turn, so one of any length is cut
over many tasks; each task runs its digests from its own first row, and what the tasks before it hold of the same
conversation (one number of turns and one digest per task) is put in front afterwards.

Counts of a node come from grouping by key, which adds up within tasks first. Sums over subtrees are made in shards,
blocks of conversations:

1. the distinct digests of a shard get slots of a minimal perfect hash, which is checked against the digest stored in
   the slot, so an unknown parent is told from a known one;
2. every node of the whole trie is counted in one shard only, that of its smallest member, whose path holds all the
   ancestors; its values are scattered into flat arrays;
3. the arrays are added up through the array of parent slots, deepest first.

A shard gives one row per node with anything in it, and Spark adds these up by key. Where a conversation is cut between
shards, the lower one hands on a single total, which is then added to the rows above.

Equal keys are checked to stand for equal last turns at equal depths. As parents' keys follow from these, that leaves no
collision undetected; if there is one, other bases are taken.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from gramledger.llm.common import mixed, quoted, written

PRIME = np.uint64((1 << 31) - 1)
HALF = np.uint64((1 << 30) - 1)
LOW = np.uint64((1 << 31) - 1)
WORD = r"[^\x20\x09-\x0D]+"
#: Ids are rebuilt in groups of this many from the group's first one, by at most ``CYCLE - 1`` turns.
GROUP, CYCLE = 20, 4
#: Rows of a shard.
SHARD = 1 << 17
#: Bytes of ids in one row on their way to a node's digest.
PIECE = 1 << 14
#: Parents with more than this share of all nodes as children are looked up in a broadcast of them.
HEAVY = 2000


class Powers:
    """Powers of one base per field."""

    def __init__(self, seed: int):
        rng = np.random.Generator(np.random.PCG64(seed))
        self.base = rng.integers(1 << 20, int(PRIME) - 1, 4, dtype=np.uint64)
        self.table = np.ones((1, 4), np.uint64)

    def upto(self, n: int) -> np.ndarray:
        """Powers 0 to ``n``."""
        while len(self.table) <= n:
            step = self.one(len(self.table))
            self.table = np.concatenate((self.table, self.table * step % PRIME))
        return self.table

    def one(self, n: int) -> np.ndarray:
        return np.array([pow(int(b), n, int(PRIME)) for b in self.base], np.uint64)


def fields(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    """Four numbers below the prime from a turn's key, two longs of 60 bits."""
    a, b = one.astype(np.uint64), two.astype(np.uint64)
    return np.stack((a >> np.uint64(30), a & HALF, b >> np.uint64(30), b & HALF), axis=1)


def packed(digest: np.ndarray) -> list[pa.Array]:
    """A digest of four fields as two longs."""
    return [pa.array((digest[:, i] << np.uint64(31) | digest[:, i + 1]).astype(np.int64)) for i in (0, 2)]


def unpacked(one: np.ndarray, two: np.ndarray) -> np.ndarray:
    a, b = one.astype(np.uint64), two.astype(np.uint64)
    return np.stack((a >> np.uint64(31), a & LOW, b >> np.uint64(31), b & LOW), axis=1)


class Slots:
    """Minimal perfect hash of distinct digests, two longs each.

    A level gives a place to every digest that is alone in its cell of a bitmap and leaves the rest to the next level;
    the slot is the rank of the cell. ``table`` holds the digest of each slot.
    """

    def __init__(self, keys: np.ndarray):
        self.levels: list[tuple[np.ndarray, np.ndarray]] = []
        rest, before = keys, 0
        while len(rest):
            cell = self._cell(rest, len(self.levels), 2 * len(rest))
            alone = np.bincount(cell, minlength=2 * len(rest)) == 1
            self.levels.append((alone, np.cumsum(alone) - 1 + before))
            before += int(alone.sum())
            rest = rest[~alone[cell]]
        self.table = np.zeros((len(keys), 2), np.uint64)
        self.table[self._place(keys)] = keys

    @staticmethod
    def _cell(keys: np.ndarray, level: int, size: int) -> np.ndarray:
        salted = mixed(keys[:, 0] + np.uint64(0x9E3779B97F4A7C15) * np.uint64(level + 1)) ^ keys[:, 1]
        return (mixed(salted) % np.uint64(size)).astype(np.int64)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        slot = np.full(len(keys), -1, np.int64)
        rest = np.arange(len(keys))
        for level, (alone, rank) in enumerate(self.levels):
            cell = self._cell(keys[rest], level, len(alone))
            here = alone[cell]
            slot[rest[here]] = rank[cell[here]]
            rest = rest[~here]
        return slot

    def find(self, keys: np.ndarray) -> np.ndarray:
        """Slot of each digest; -1 for one that has none."""
        slot = self._place(keys)
        held = slot >= 0
        held[held] = (self.table[slot[held]] == keys[held]).all(axis=1)
        return np.where(held, slot, -1)


def turn_rows(conversations: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    """What the trie needs of a turn: its place, its key and its words. The texts stay where they are."""
    who, what = (F.coalesce(F.col(quoted(c)).cast("string"), F.lit("")) for c in (role, text))
    key = F.md5(F.concat(F.length(who).cast("string"), F.lit(":"), who, what).cast("binary"))
    return conversations.where(F.col(quoted(conv_id)).isNotNull()).select(
        F.col(quoted(conv_id)).cast("long").alias("conv"),
        F.col(quoted(turn)).cast("long").alias("turn"),
        *(F.conv(F.substring(key, at, 15), 16, 10).cast("long").alias(n) for at, n in ((1, "k1"), (16, "k2"))),
        F.regexp_count(what, F.lit(WORD)).cast("long").alias("words"),
        F.monotonically_increasing_id().alias("row"),
    )


def rebuilt(turns: DataFrame) -> DataFrame:
    """The turns that every conversation has after it was rebuilt: those it takes over (``place`` 1, 2, ...), its own."""
    order = Window.partitionBy("conv").orderBy("turn", "k1", "k2", "row")
    heads = turns.withColumn("place", F.row_number().over(order)).where(F.col("place") < CYCLE)
    heads = written(heads.select("conv", "place", "k1", "k2", "words", "row"), "heads")
    taken = F.crc32(F.col("conv").cast("string").cast("binary")) % CYCLE
    dropped = heads.where(F.col("place") <= taken).select("row")
    own = turns.join(dropped, "row", "left_anti").withColumn("place", F.lit(CYCLE))
    wants = heads.where("place = 1").select("conv", (F.col("conv") - F.col("conv") % GROUP).alias("first"), taken.alias("h"))
    given = heads.select(F.col("conv").alias("first"), "place", "k1", "k2", "words", "row")
    taken_over = wants.join(given, "first").where("place <= h").withColumn("turn", F.lit(None).cast("long"))
    columns = ("conv", "place", "turn", "k1", "k2", "words", "row")
    return own.select(*columns).unionAll(taken_over.select(*columns))


def paths(spark, turns: DataFrame, seed: int) -> DataFrame:
    """One row per conversation and depth: the node's key and its parent's, the last turn, whether it is the end."""
    order = ("conv", "place", "turn", "k1", "k2", "row")
    names = "part", "conv", "n", "d1", "d2", "b1", "b2", "k1", "k2", "words", "ends", "opens", "last"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers, part = Powers(seed), TaskContext.get().partitionId()
        opener, conv, count, digest = None, None, 0, np.zeros(4, np.uint64)
        held = None

        def out(last: bool) -> pa.RecordBatch:
            size = len(held["conv"])
            held["last"][-1] = last
            columns = [held[n] for n in ("conv", "n")], [held[n] for n in ("k1", "k2", "words", "ends", "opens", "last")]
            return pa.RecordBatch.from_arrays(
                [
                    pa.array(np.full(size, part, np.int32)),
                    *map(pa.array, columns[0]),
                    *packed(held["digest"]),
                    *packed(held["before"]),
                    *map(pa.array, columns[1]),
                ],
                list(names),
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            ids, k1, k2, words = (batch.column(i).to_numpy() for i in range(4))
            begin = np.flatnonzero(np.concatenate(([True], ids[1:] != ids[:-1])))
            sizes = np.diff(np.append(begin, len(ids)))
            goes_on = conv is not None and ids[0] == conv
            if held:
                held["ends"][-1] = not goes_on
                yield out(False)
            opener = ids[0] if opener is None else opener
            earlier = np.zeros(len(begin), np.int64)
            earlier[0] = count if goes_on else 0
            n = np.arange(len(ids)) - np.repeat(begin - earlier, sizes) + 1
            turn = fields(k1, k2) * powers.upto(int(n.max()))[n] % PRIME
            total = np.concatenate((np.zeros((1, 4), np.uint64), np.cumsum(turn, axis=0)))  # below 2^64: 2^33 rows
            front = np.zeros((len(begin), 4), np.uint64)
            front[0] = digest if goes_on else 0
            after = (total[1:] - np.repeat(total[begin], sizes, axis=0) + np.repeat(front, sizes, axis=0)) % PRIME
            before = (after + PRIME - turn) % PRIME
            conv, count, digest = ids[-1], int(n[-1]), after[-1]
            held = {
                "conv": ids, "n": n, "digest": after, "before": before, "k1": k1, "k2": k2, "words": words,
                "ends": np.concatenate((ids[1:] != ids[:-1], [True])), "opens": ids == opener,
                "last": np.zeros(len(ids), bool),
            }
        if held:
            yield out(True)

    dealt = turns.repartitionByRange(*order).sortWithinPartitions(*order).select("conv", "k1", "k2", "words")
    schema = "part int, conv long, n long, d1 long, d2 long, b1 long, b2 long, k1 long, k2 long, words long, ends boolean"
    table = written(dealt.mapInArrow(run, f"{schema}, opens boolean, last boolean"), "paths")

    # one row per task: the conversation it starts with, and how far it got with its last one
    first = {r["part"]: r["conv"] for r in table.where("opens and n = 1").select("part", "conv").collect()}
    last = {r["part"]: r for r in table.where("last").select("part", "conv", "n", "d1", "d2", "opens").collect()}
    powers, put_before, cut = Powers(seed), {}, set()
    conv, count, digest = None, 0, np.zeros(4, np.uint64)
    previous = None
    for part in sorted(first):
        if first[part] == conv:
            put_before[part] = (count, digest)
            cut.add(previous)
        else:
            count, digest = 0, np.zeros(4, np.uint64)
        row = last[part]
        own = unpacked(np.array([row["d1"]]), np.array([row["d2"]]))[0]
        if not row["opens"]:
            count, digest = 0, np.zeros(4, np.uint64)
        digest = (digest + powers.one(count) * own) % PRIME
        conv, count, previous = row["conv"], count + row["n"], part
    if not put_before:
        return table.withColumnRenamed("n", "depth").drop("part", "opens", "last")

    def mended(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = Powers(seed)
        for batch in batches:
            part, conv, n, d1, d2, b1, b2, k1, k2, words, ends, opens, last = (
                c.to_numpy(zero_copy_only=False) for c in batch.columns
            )
            n, ends = n.copy(), ends.copy()
            digest, before = unpacked(d1, d2), unpacked(b1, b2)
            for p in np.unique(part).tolist():
                if p in put_before:
                    count, front = put_before[p]
                    some = (part == p) & opens
                    n[some] += count
                    for d in (digest, before):
                        d[some] = (front + powers.one(count) * d[some]) % PRIME
                if p in cut:
                    ends[(part == p) & last] = False
            rest = [pa.array(x) for x in (k1, k2, words, ends)]
            yield pa.RecordBatch.from_arrays(
                [pa.array(conv), pa.array(n), *packed(digest), *packed(before), *rest],
                ["conv", "depth", "d1", "d2", "b1", "b2", "k1", "k2", "words", "ends"],
            )

    return table.select(*names).mapInArrow(
        mended,
        "conv long, depth long, d1 long, d2 long, b1 long, b2 long, k1 long, k2 long, words long, ends boolean",
    )


def shard_sums(rows: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], tuple[int, int, int, int] | None]:
    """Sums over the subtrees of a shard, and what goes on to the rows above it.

    ``rows`` come in the order of conversation and depth. Those with ``values`` are nodes to be counted, the others
    say where paths lead. Only the first conversation can lack its upper rows.
    """
    keys = np.stack((rows["d1"], rows["d2"]), axis=1).astype(np.uint64)
    order = np.lexsort((keys[:, 1], keys[:, 0]))
    new = np.concatenate(([True], (keys[order[1:]] != keys[order[:-1]]).any(axis=1)))
    slots = Slots(keys[order[new]])
    slot = slots.find(keys)
    size = len(slots.table)
    depth, parent = np.zeros(size, np.int64), np.zeros(size, np.int64)
    depth[slot] = rows["depth"]
    parent[slot] = slots.find(np.stack((rows["b1"], rows["b2"]), axis=1).astype(np.uint64))
    parent[depth == 1] = -1  # the root is not in the arrays
    saved, leaves = np.zeros(size, np.int64), np.zeros(size, np.int64)
    np.add.at(saved, slot, rows["saved"])
    np.add.at(leaves, slot, rows["leaf"])
    deepest = np.argsort(-depth, kind="stable")
    levels = np.flatnonzero(np.diff(depth[deepest])) + 1
    for level in np.split(deepest, levels):
        inner = level[parent[level] >= 0]
        np.add.at(saved, parent[inner], saved[inner])
        np.add.at(leaves, parent[inner], leaves[inner])
    above = None
    top = slot[0]
    if rows["depth"][0] > 1 and parent[top] < 0:
        above = int(rows["conv"][0]), int(rows["depth"][0]) - 1, int(saved[top]), int(leaves[top])
    some = np.flatnonzero((saved != 0) | (leaves != 0))
    found = slots.table[some].astype(np.int64)
    return {"d1": found[:, 0], "d2": found[:, 1], "saved": saved[some], "leaf": leaves[some]}, above


def subtree_sums(path: DataFrame, nodes: DataFrame, shard: int) -> DataFrame:
    """Per key: ``saved`` and ``leaf`` of ``nodes`` (conv, depth, keys, values), summed over subtrees."""
    names = ["conv", "depth", "d1", "d2", "b1", "b2", "saved", "leaf"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []

        def out(rows: np.ndarray) -> pa.RecordBatch:
            found, above = shard_sums(dict(zip(names, rows)))
            none = np.zeros(len(found["d1"]), np.int64)
            columns = [none - 1, none, found["d1"], found["d2"], found["saved"], found["leaf"]]
            if above:
                conv, depth, saved, leaf = above
                columns = [np.append(c, x) for c, x in zip(columns, (depth, conv, 0, 0, saved, leaf))]
            return pa.RecordBatch.from_arrays(
                list(map(pa.array, columns)), ["above", "conv", "d1", "d2", "saved", "leaf"]
            )

        for batch in batches:
            held.append(np.stack([batch.column(n).to_numpy() for n in names]))
            while sum(h.shape[1] for h in held) >= shard:
                rows = np.concatenate(held, axis=1)
                ends = np.flatnonzero(rows[0, 1:] != rows[0, :-1]) + 1  # between conversations if there is a place
                ends = ends[ends <= shard]
                at = int(ends[-1]) if len(ends) else shard
                yield out(rows[:, :at])
                held = [rows[:, at:]]
        if held and sum(h.shape[1] for h in held):
            yield out(np.concatenate(held, axis=1))

    zero = F.lit(0).cast("long")
    rows = path.select(*names[:6], zero.alias("saved"), zero.alias("leaf")).unionAll(nodes.select(*names))
    dealt = rows.repartitionByRange("conv", "depth").sortWithinPartitions("conv", "depth")
    sums = written(
        dealt.mapInArrow(run, "above long, conv long, d1 long, d2 long, saved long, leaf long"), "shard-sums"
    )
    handed: dict[int, list[tuple[int, int, int]]] = {}
    for r in sums.where("above >= 0").collect():  # one row per shard at most
        handed.setdefault(r["conv"], []).append((r["above"], r["saved"], r["leaf"]))
    below = {c: _from_below(np.array(sorted(rows), np.int64)) for c, rows in handed.items()}
    parts = sums.where("above < 0").select("d1", "d2", "saved", "leaf")

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wanted = np.array(sorted(below), np.int64)
        for batch in batches:
            conv, depth, d1, d2 = (c.to_numpy() for c in batch.columns)
            added = np.zeros((len(conv), 2), np.int64)
            for c in np.intersect1d(conv, wanted).tolist():
                depths, totals = below[c]
                some = conv == c
                added[some] = totals[np.searchsorted(depths, depth[some])]
            some = added.any(axis=1)
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[some]) for x in (d1, d2, added[:, 0], added[:, 1])], ["d1", "d2", "saved", "leaf"]
            )

    if handed:
        upper = path.select("conv", "depth", "d1", "d2")
        parts = parts.unionAll(upper.mapInArrow(add, "d1 long, d2 long, saved long, leaf long"))
    return parts.groupBy("d1", "d2").agg(F.sum("saved").alias("saved_tokens"), F.sum("leaf").alias("n_leaves"))


def _from_below(rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Depths to which totals are handed, ascending, and for each place among them the sum of those at or after it."""
    totals = np.concatenate((rows[:, 1:], np.zeros((1, 2), np.int64)))
    return rows[:, 0], np.cumsum(totals[::-1], axis=0)[::-1]


def end_digests(ends: DataFrame) -> DataFrame:
    """Per key, the digest of the ids that end there, in ascending order.

    The ids are sorted and written as text in ranges, so a node where a third of all conversations end is many
    tasks' work; one task then reads its few large pieces in order and holds one of them.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            d1, d2, conv = (c.to_numpy() for c in batch.columns)
            new = np.concatenate(([True], (d1[1:] != d1[:-1]) | (d2[1:] != d2[:-1])))
            new[:: PIECE // 16] = True
            at = np.flatnonzero(new)
            names = list(map(str, conv.tolist()))
            text = [",".join(names[a:b]) for a, b in zip(at.tolist(), [*at[1:].tolist(), len(names)])]
            yield pa.RecordBatch.from_arrays(
                [pa.array(d1[at]), pa.array(d2[at]), pa.array(conv[at]), pa.array(text)], ["d1", "d2", "first", "ids"]
            )

    def digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, sha = None, None
        for batch in batches:
            done = []
            for one, two, ids in zip(*(batch.column(i).to_pylist() for i in (0, 1, 3))):
                if (one, two) == node:
                    sha.update(b",")
                else:
                    if node:
                        done.append((*node, sha.hexdigest()))
                    node, sha = (one, two), hashlib.sha256()
                sha.update(ids.encode())
            yield _ended(done)
        if node:
            yield _ended([(*node, sha.hexdigest())])

    order = ("d1", "d2", "conv")
    text = ends.select(*order).repartitionByRange(*order).sortWithinPartitions(*order)
    text = text.mapInArrow(pieces, "d1 long, d2 long, first long, ids string").repartition("d1", "d2")
    return text.sortWithinPartitions("d1", "d2", "first").mapInArrow(digests, "d1 long, d2 long, ends_sha256 string")


def _ended(rows: list[tuple[int, int, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) or [(), (), ()]
    kinds = pa.int64(), pa.int64(), pa.string()
    return pa.RecordBatch.from_arrays(
        [pa.array(c, k) for c, k in zip(columns, kinds)], ["d1", "d2", "ends_sha256"]
    )


def with_parents(nodes: DataFrame, total: int, root: int) -> DataFrame:
    """``nodes`` with their parent's smallest member; a parent of very many children is not joined by its key."""
    heavy = F.col("n_children") > max(HEAVY, total // HEAVY)  # at most HEAVY parents
    of = [F.col("d1").alias("b1"), F.col("d2").alias("b2"), F.col("conv_id").alias("parent_conv_id")]
    large = F.broadcast(nodes.where(heavy & (F.col("depth") > 0)).select(*of))
    inner = nodes.where("depth > 1")
    parts = [
        inner.join(large, ["b1", "b2"]),
        inner.join(large, ["b1", "b2"], "left_anti").join(nodes.where(~heavy & (F.col("depth") > 0)).select(*of), ["b1", "b2"]),
        nodes.where("depth = 1").withColumn("parent_conv_id", F.lit(root)),
        nodes.where("depth = 0").withColumn("parent_conv_id", F.lit(None).cast("long")),
    ]
    names = [*nodes.columns, "parent_conv_id"]
    whole = parts[0].select(*names)
    for part in parts[1:]:
        whole = whole.unionAll(part.select(*names))
    return whole


def trie(
    conversations: DataFrame,
    conv_id: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    shard: int = SHARD,
) -> DataFrame:
    """One row per node: conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256.

    Turns go by their number, null first; equal numbers by a digest of role and text, so repeated rows are turns of
    their own that stand side by side. Null roles and texts are empty. Rows without a conversation id take no part. A
    table without conversations gives no rows, one whose conversations all lost their turns gives the root. Other
    columns are not read. Texts are read once, where they lie, however long.
    """
    spark = conversations.sparkSession
    turns = written(turn_rows(conversations, conv_id, turn, role, text), "turns")
    # every conversation has turns of its own before it is rebuilt
    convs = turns.groupBy("conv").agg(F.lit(True).alias("had"))
    members = turns.agg(F.min("conv").alias("least")).collect()[0]["least"]
    if members is None:
        return spark.createDataFrame([], RESULT)
    whole = written(rebuilt(turns), "rebuilt")
    for seed in range(20240601, 20240701):
        path = paths(spark, whole, seed)
        sides = [f(c).alias(f"{n}_{c}") for c in ("k1", "k2") for n, f in (("least", F.min), ("most", F.max))]
        grouped = path.groupBy("d1", "d2", "depth").agg(
            F.count(F.lit(1)).alias("n_convs"),
            F.min("conv").alias("conv_id"),
            F.min("words").alias("words"),
            F.min("b1").alias("b1"),
            F.min("b2").alias("b2"),
            *sides,
        )
        clash = (F.col("least_k1") != F.col("most_k1")) | (F.col("least_k2") != F.col("most_k2"))
        nodes = written(grouped.withColumn("clash", clash).drop(*(f"{n}_{c}" for n in ("least", "most") for c in ("k1", "k2"))), "nodes")
        several = nodes.groupBy("d1", "d2").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
        if nodes.where("clash").isEmpty() and several.isEmpty():
            break
    else:
        raise ValueError("digests of different prefixes are equal for every base")

    children = nodes.groupBy(F.col("b1").alias("d1"), F.col("b2").alias("d2"), (F.col("depth") - 1).alias("depth"))
    children = children.agg(F.count(F.lit(1)).alias("n_children"))
    counted = nodes.drop("clash").join(children, ["d1", "d2", "depth"], "left").na.fill(0, ["n_children"])
    counted = written(counted, "counted")
    value = ((F.col("n_convs") - 1) * F.col("words")).alias("saved")
    valued = counted.select(
        F.col("conv_id").alias("conv"), "depth", "d1", "d2", "b1", "b2", value,
        (F.col("n_children") == 0).cast("long").alias("leaf"),
    )
    sums = subtree_sums(path, valued, shard)

    turnless = convs.join(path.where("depth = 1").select("conv"), "conv", "left_anti").select("conv")
    zero = F.lit(0).cast("long")
    ends = path.where("ends").select("d1", "d2", "conv").unionAll(turnless.select(zero, zero, "conv"))
    total = valued.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum("saved"), zero).alias("saved"),
        F.coalesce(F.sum("leaf"), zero).alias("leaf"),
        F.coalesce(F.sum((F.col("depth") == 1).cast("long")), zero).alias("top"),
    ).collect()[0]
    n_convs = convs.count()
    root = spark.createDataFrame(
        [(0, 0, 0, n_convs, members, total["top"], total["saved"], max(total["leaf"], int(not total["n"])))],
        "d1 long, d2 long, depth long, n_convs long, conv_id long, n_children long, saved_tokens long, n_leaves long",
    )
    columns = ["d1", "d2", "depth", "conv_id", "parent_conv_id", "n_convs", "n_children"]
    none = F.lit(None).cast("long")
    above = root.select("d1", "d2", "depth", "n_convs", "conv_id", "n_children", none.alias("b1"), none.alias("b2"))
    every = counted.select(*above.columns).unionAll(above)
    every = with_parents(every, total["n"], members).select(*columns)
    sums = sums.unionAll(root.select("d1", "d2", "saved_tokens", "n_leaves"))
    found = every.join(sums, ["d1", "d2"], "left").join(end_digests(ends), ["d1", "d2"], "left")
    return found.select(
        "conv_id",
        "depth",
        "parent_conv_id",
        "n_convs",
        "n_children",
        filled("n_leaves"),
        filled("saved_tokens"),
        F.coalesce("ends_sha256", F.lit(hashlib.sha256(b"").hexdigest())).alias("ends_sha256"),
    )


def filled(name: str) -> Column:
    return F.coalesce(F.col(name), F.lit(0).cast("long")).alias(name)


RESULT = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, "
    "saved_tokens long, ends_sha256 string"
)


def trie_sql(table: str = "conversations") -> str:
    """The same as SQL: prefixes as lists, every node counted at each of its ancestors."""
    crc = """xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''),
        lambda x: ascii(x)::BIGINT)), lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda x, y:
        CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384) ELSE x // 2 END)), 4294967295)"""
    return f"""
    WITH t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM {table}
        WHERE conv_id IS NOT NULL),
    o AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
        md5(length(role) || ':' || role || text)) AS p FROM t),
    c AS (SELECT conv_id, {crc} % {CYCLE} AS h FROM (SELECT DISTINCT conv_id FROM t)),
    r AS (SELECT c.conv_id, 0 AS phase, p, role, text FROM c JOIN o ON o.conv_id = c.conv_id - c.conv_id % {GROUP}
            AND p <= h
        UNION ALL SELECT conv_id, 1, p, role, text FROM o JOIN c USING (conv_id) WHERE p > h),
    s AS (SELECT conv_id, {{'role': role, 'text': text}} AS x, text,
        row_number() OVER (PARTITION BY conv_id ORDER BY phase, p) AS d FROM r),
    whole AS (SELECT conv_id, list(x ORDER BY d) AS q FROM s GROUP BY conv_id),
    full_q AS (SELECT conv_id, coalesce(q, []) AS q FROM c LEFT JOIN whole USING (conv_id)),
    paths AS (SELECT conv_id, d, q[:d] AS prefix, len(q) = d AS ends FROM full_q, unnest(range(0, len(q) + 1)) AS u(d)),
    nodes AS (SELECT min(conv_id) AS conv_id, d AS depth, prefix, count(*) AS n_convs, sha256(coalesce(
            string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
            CASE WHEN d = 0 THEN 0 ELSE len(regexp_extract_all(prefix[d].text, '[^\\x20\\x09-\\x0D]+')) END AS words
        FROM paths GROUP BY d, prefix),
    kids AS (SELECT depth - 1 AS depth, prefix[:depth - 1] AS prefix, count(*) AS n FROM nodes WHERE depth > 0
        GROUP BY ALL),
    n AS (SELECT nodes.*, coalesce(kids.n, 0) AS n_children FROM nodes LEFT JOIN kids USING (depth, prefix)),
    sums AS (SELECT a AS depth, prefix[:a] AS prefix, sum((n_convs - 1) * words)::BIGINT AS saved,
            sum((n_children = 0)::BIGINT)::BIGINT AS leaves
        FROM n, unnest(range(0, depth + 1)) AS u(a) GROUP BY ALL)
    SELECT n.conv_id, n.depth::BIGINT AS depth, up.conv_id AS parent_conv_id, n.n_convs, n.n_children,
           leaves AS n_leaves, saved AS saved_tokens, n.ends_sha256
    FROM n JOIN sums USING (depth, prefix) LEFT JOIN nodes AS up ON up.depth = n.depth - 1
        AND up.prefix = n.prefix[:n.depth - 1]"""
