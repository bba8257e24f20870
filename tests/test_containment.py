"""Containment join and best match against brute force, for every strategy."""

from __future__ import annotations

import contextlib
import io

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from pyspark.sql import types as T

from gramledger.operators.best_match import best_match, longest_then_worst
from gramledger.operators.containment import best_contained, contains_join

STRATEGIES = ["scan", "grams", "shuffle"]

TEXTS = [
    (1, "cold gear"),
    (2, "Injection, rituximab, 10 mg"),
    (3, ""),
    (4, None),
    (5, "100% pure_oil \\ mix"),
    (6, "a"),
    (7, "straße 😀ab and more"),
    (8, "no hit here"),
    (9, "line one\nline two has cold gears"),
]
NAMES = [
    ("OLD", 2),
    ("COLD", 1),
    ("COLD GEAR", 3),
    ("RITUXIMAB", 2),
    ("%", 1),
    ("PURE_OIL", 1),
    ("\\", 4),
    ("A", 3),
    ("😀AB", 1),
    ("ONE\nLINE", 2),
    ("MG", 1),
    ("XYZ", 1),
    (None, 1),
]


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


def brute(texts, names):
    rows = set()
    for key, text in texts:
        hits = [(n, s) for n, s in names if text is not None and n is not None and n in text.upper()]
        rows |= {(key, n, s) for n, s in hits} or {(key, None, None)}
    return rows


def frames(spark, texts, names):
    return (
        spark.createDataFrame(texts, "k long, text string"),
        spark.createDataFrame(names, "name string, severity int"),
    )


def joined(left, right, **options):
    rows = contains_join(left, right, "k", "text", "name", **options).collect()
    assert len(rows) == len({tuple(r) for r in rows})
    return {(r["k"], r["name"], r["severity"]) for r in rows}


@pytest.mark.parametrize("strategy", STRATEGIES)
@pytest.mark.parametrize("extra", [[], [("", 4)]], ids=["plain", "empty-name"])
def test_equals_brute_force(spark, strategy, extra):
    left, right = frames(spark, TEXTS, NAMES + extra)
    assert joined(left, right, strategy=strategy) == brute(TEXTS, NAMES + extra)


def test_names_beyond_one_task(spark):
    left, right = frames(spark, TEXTS, NAMES)
    assert joined(left, right, strategy="scan", scan_chars=10) == brute(TEXTS, NAMES)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_no_names_at_all(spark, strategy):
    left, right = frames(spark, TEXTS, [])
    assert joined(left, right, strategy=strategy) == {(k, None, None) for k, _ in TEXTS}


def test_min_name_length(spark):
    left, right = frames(spark, TEXTS, NAMES + [("", 1)])
    kept = [n for n in NAMES if n[0] is not None and len(n[0]) >= 3]
    assert joined(left, right, min_name_len=3) == brute(TEXTS, kept)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_repeated_names_keep_all_their_rows(spark, strategy):
    left, right = frames(spark, [(1, "cold gear")], [("OLD", 1), ("OLD", 2)])
    assert joined(left, right, strategy=strategy) == {(1, "OLD", 1), (1, "OLD", 2)}


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    texts=st.lists(st.text("ab é,", max_size=30), min_size=1, max_size=25),
    names=st.lists(st.text("AB É,", max_size=11), max_size=25, unique=True),
)
def test_random_texts(spark, texts, names):
    keyed, ranked = list(enumerate(texts)), [(n, len(n) % 4) for n in names]
    left, right = frames(spark, keyed, ranked)
    wanted = brute(keyed, ranked)
    for strategy in STRATEGIES:
        assert joined(left, right, strategy=strategy) == wanted
    assert joined(left, right, strategy="scan", scan_chars=20) == wanted


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_best_contained_is_join_then_best(spark, strategy):
    left, right = frames(spark, TEXTS, NAMES + [("COLD", 4), ("GEAR", 1)])
    order = longest_then_worst("name", "severity")
    two_steps = best_match(contains_join(left, right, "k", "text", "name"), "k", order)
    one_step = best_contained(left, right, "k", "text", "name", order, strategy=strategy)
    assert one_step.count() == len(TEXTS)
    assert sorted(map(tuple, one_step.select("k", "name", "severity").collect())) == sorted(
        map(tuple, two_steps.select("k", "name", "severity").collect())
    )


def test_equal_lengths_severity_then_name(spark):
    rows = [(1, "BB", 2), (1, "AA", 1), (2, "BB", 1), (2, "AA", 1), (3, None, None)]
    df = spark.createDataFrame(rows, "k long, name string, severity int")
    best = best_match(df, "k", longest_then_worst("name", "severity"))
    assert {r["k"]: r["name"] for r in best.collect()} == {1: "AA", 2: "AA", 3: None}


def test_hot_piece_spreads_over_salts(spark):
    """One name in every text: the shuffled pieces of that name fall into several partitions."""
    left = spark.range(4000).select(F.col("id").alias("k"), F.lit("always the same").alias("text"))
    right = spark.createDataFrame([("THE SAME", 1), ("NEVER SEEN", 1)], "name string, severity int")
    rows = contains_join(left, right, "k", "text", "name", strategy="shuffle")
    assert rows.where("name = 'THE SAME'").count() == rows.count() == 4000
    assert "_salt" in plan_of(rows)


def test_plans_have_no_nested_loop(spark):
    left, right = frames(spark, TEXTS, NAMES)
    for strategy in STRATEGIES:
        plan = plan_of(contains_join(left, right, "k", "text", "name", strategy=strategy))
        assert "NestedLoop" not in plan and "Cartesian" not in plan


def test_scan_moves_no_text(spark):
    left, right = frames(spark, TEXTS, NAMES)
    order = longest_then_worst("name", "severity")
    for df in (
        contains_join(left, right, "k", "text", "name"),
        best_contained(left, right, "k", "text", "name", order),
    ):
        plan = plan_of(df)
        assert "ArrowEvalPython" in plan
        assert "hashpartitioning" not in plan and "Sort" not in plan


def test_best_match_prunes_ahead_of_the_shuffle(spark):
    left, right = frames(spark, TEXTS, NAMES)
    df = contains_join(left, right, "k", "text", "name", strategy="grams")
    plan = plan_of(best_match(df, "k", longest_then_worst("name", "severity")))
    assert "WindowGroupLimit" in plan


def test_names_too_many_for_a_way_take_the_next(spark, monkeypatch):
    from gramledger.operators import containment

    left, right = frames(spark, TEXTS, NAMES)
    assert "_salt" not in plan_of(contains_join(left, right, "k", "text", "name", scan_chars=10))
    monkeypatch.setattr(containment, "BROADCAST_CHARS", 10)
    monkeypatch.setattr(containment, "BROADCAST_BYTES", 10)
    moved = contains_join(left, right, "k", "text", "name", strategy="grams")
    assert "_salt" in plan_of(moved)
    assert {(r["k"], r["name"], r["severity"]) for r in moved.collect()} == brute(TEXTS, NAMES)
    with pytest.raises(ValueError, match="strategy"):
        contains_join(left, right, "k", "text", "name", strategy="guess")


def test_without_the_automaton_package(spark, monkeypatch):
    from gramledger.operators import containment

    monkeypatch.setattr(containment, "automaton_available", lambda: False)
    left, right = frames(spark, TEXTS, NAMES)
    df = contains_join(left, right, "k", "text", "name")
    assert "ArrowEvalPython" not in plan_of(df)
    assert {(r["k"], r["name"], r["severity"]) for r in df.collect()} == brute(TEXTS, NAMES)


@pytest.mark.parametrize("strategy", STRATEGIES)
def test_texts_longer_than_a_segment(spark, monkeypatch, strategy):
    from gramledger.operators import containment

    monkeypatch.setattr(containment, "SEGMENT", 10)
    texts = TEXTS + [(20, "0123456789 cold gear 0123456789 cold gears again, rituximab 10 mg, one\nline")]
    left, right = frames(spark, texts, NAMES)
    assert joined(left, right, strategy=strategy) == brute(texts, NAMES)


def test_piece_that_is_in_every_text_is_not_looked_up(spark):
    """Each name's only piece of its own stands in every text; what all names share stands in none but a few."""
    from gramledger.operators import pieces

    n = 300
    numbers = " ".join(f"{i:08d}" for i in range(n))
    texts = [(k, numbers + (f" QZXWVUTS{k:08d} end" if k % 50 == 0 else "")) for k in range(200)]
    left = spark.createDataFrame(texts, "k long, t string").repartition(4)
    right = spark.createDataFrame([(f"QZXWVUTS{i:08d}",) for i in range(n)], "w string")
    widths = [1, 2, 3, 4, 8]
    in_texts, in_names = pieces.sketch(left, "t", widths), pieces.sketch(right, "w", widths)
    lookup = pieces.cheapest_pieces(right, "w", widths, in_texts, in_names)
    chosen = {r["w"]: r["_piece"] for r in lookup.collect()}
    assert all(not piece.isdigit() for piece in chosen.values())
    found = pieces.known_pieces(left.select("k", "t"), "t", widths, pieces.piece_filter(lookup))
    assert found.join(lookup, "_piece").count() < 2 * n  # rarest among the names: one candidate per name and text, 60,000
    for strategy in ("scan", "grams", "shuffle"):
        matched = contains_join(left, right, "k", "t", "w", strategy=strategy).where("w IS NOT NULL")
        assert sorted((r["k"], r["w"]) for r in matched.collect()) == [(k, f"QZXWVUTS{k:08d}") for k in (0, 50, 100, 150)]


def test_sketch_never_counts_too_low(spark):
    from gramledger.operators import pieces

    texts = ["abcabcab", "", "a\0b\0", "\U0001f602x\U0001f602x\U0001f602", "ab" * 700, None, "ß" * 9]
    frame = spark.createDataFrame([(t,) for t in texts], "t string").repartition(3)
    for width in (1, 2, 4, 8):
        counted = pieces.sketch(frame, "t", [width])
        for piece in {t[i : i + width] for t in texts if t for i in range(len(t) - width + 1)}:
            real = sum(t.startswith(piece, i) for t in texts if t for i in range(len(t)))
            estimate = counted[pieces.slots(pieces._own_hashes([piece]))].min()
            assert real <= estimate <= real + 2


def test_memory_of_a_task_does_not_grow_with_the_batch():
    """Each of the tasks' parts holds as much for a batch of many rich texts as for one of few."""
    import pyarrow as pa
    from gramledger.operators import containment, pieces

    class Shared:
        value = {"names": [f"{i:03d}" for i in range(1000)]}

    every = " ".join(Shared.value["names"])
    with pytest.MonkeyPatch.context() as patch:
        patch.setattr(containment.F, "arrow_udf", lambda run, returns: run)
        for rows in (100, 2000):
            batch = pa.array([every] * rows)
            found = list(containment._finder(Shared, T.ArrayType(T.StringType()))(iter([batch])))
            assert sum(map(len, found)) == rows and max(len(f.values) for f in found) < containment.FOUND + 1000
            assert all(sorted(set(x)) == sorted(x) and len(x) == 1000 for x in found[-1].to_pylist())
            taken = [(start, len(some), sum(map(len, some))) for start, some in pieces.chunks(batch)]
            assert sum(n for _, n, _ in taken) == rows and [s for s, _, _ in taken][1:] == [s + n for s, n, _ in taken][:-1]
            assert max(size for _, _, size in taken) <= pieces.CHUNK and max(n for _, n, _ in taken) <= pieces.ROWS


def test_no_text_is_copied_for_each_of_its_pieces(spark):
    """What a task hands back of a text is its row, once, with the pieces as an array."""
    import pyarrow as pa
    from gramledger.operators import pieces

    sent = []

    class Parts:
        columns = ["k", "_segment", "_around"]

        def select(self, *columns):
            return spark.createDataFrame([], "k long, _around string")

        def mapInArrow(self, run, schema):  # noqa: N802
            batch = pa.RecordBatch.from_pydict({"k": [1, 2], "_segment": ["abcd" * 9, ""], "_around": ["x" * 10**6, "y"]})
            sent.extend(run(iter([batch])))
            return spark.createDataFrame([], schema)

    bits = pieces.piece_filter(spark.createDataFrame([("AB",), ("abcd",), ("bc",), ("d",)], "_piece string"))
    pieces.known_pieces(Parts(), "_segment", [1, 2, 4], bits)
    rows = [r for b in sent for r in b.to_pylist()]
    assert [(r["k"], r["_pieces"]) for r in rows] == [(1, ["abcd", "bc", "d"]), (2, [])]
    assert sum(b.num_rows for b in sent) == 2


def test_sketch_of_a_text_in_parts(spark, monkeypatch):
    from gramledger.operators import pieces

    text = "".join(chr(97 + i * i % 23) for i in range(1000))
    frame = spark.createDataFrame([(text,), ("abc",)], "t string").coalesce(1)
    whole = pieces.sketch(frame, "t", [1, 3, 8])
    monkeypatch.setattr(pieces, "CHUNK", 10)
    assert max(len(p) for p in pieces._slices([text], 7) for p in p) == 17
    assert sum(len(p) for p in pieces._slices([text], 0) for p in p) == len(text)
    slots = [pieces.slots(pieces.Places([t]).pieces(w)[2]).ravel() for t in (text, "abc") for w in (1, 3, 8)]
    import numpy as np

    assert (whole == np.bincount(np.concatenate(slots), minlength=len(whole))).all()
    parts = [p for p in pieces._slices([text], 7)]
    mine = []
    for p in parts:
        for w in (1, 3, 8):
            _, at, hashes = pieces.Places(p).pieces(w)
            mine.append(pieces.slots(hashes[at < 10]).ravel())
    mine += slots[3:]
    assert (whole == np.bincount(np.concatenate(mine), minlength=len(whole))).all()


@pytest.mark.parametrize("strategy", ["grams", "shuffle"])
def test_short_names_take_one_look_at_a_text(spark, monkeypatch, strategy):
    """No sketch of the texts is made, and no candidate is compared with its text again."""
    from gramledger.operators import containment

    monkeypatch.setattr(containment, "sketch", lambda *args: pytest.fail("the texts were read for a sketch"))
    left, right = frames(spark, TEXTS, NAMES + [("", 4), ("N" * 32, 1)])
    df = contains_join(left, right, "k", "text", "name", strategy=strategy)
    assert "Contains" not in plan_of(df)
    assert {(r["k"], r["name"], r["severity"]) for r in df.collect()} == brute(TEXTS, NAMES + [("", 4)])


@pytest.mark.parametrize("strategy", ["grams", "shuffle"])
def test_names_around_the_longest_that_is_looked_up_whole(spark, strategy):
    text = "".join(chr(97 + i * i % 23) for i in range(400)).upper()
    names = [(text[i : i + n], n) for i, n in ((3, 1), (5, 8), (7, 31), (11, 32), (13, 33), (17, 34), (19, 150))]
    texts = [(1, text), (2, text[100:] + text[:100]), (3, "none"), (4, None), (5, text[7:38]), (6, "")]
    left, right = frames(spark, texts, names + [("", 0), ("Z" * 40, 3)])
    assert joined(left, right, strategy=strategy) == brute(texts, names + [("", 0)])


@pytest.mark.parametrize("strategy", ["grams", "shuffle"])
def test_name_over_the_edge_of_a_part_of_a_long_text(spark, strategy):
    from gramledger.operators import pieces

    filler = "." * (pieces.CHUNK - 4)
    texts = [(1, filler + "cold gear" + filler + "cold"), (2, "gear"), (3, "cold " * 3)]
    names = [("COLD GEAR", 1), ("COLD", 2), ("GEAR", 3), ("." * 32, 4), ("R.", 5)]
    left, right = frames(spark, texts, names)
    assert joined(left, right, strategy=strategy) == brute(texts, names)


@pytest.mark.parametrize("shared_key", [False, True])
def test_tables_of_names_are_exact(monkeypatch, shared_key):
    """Also where names and other strings have one key."""
    import random

    import numpy as np
    import pyarrow as pa
    from gramledger.operators import pieces

    if shared_key:
        own = pieces._key
        few = lambda values, length: np.full(len(values), length % 2, np.uint64)
        monkeypatch.setattr(pieces, "_key", lambda values, length: (own if length <= pieces.EXACT else few)(values, length))
    some = random.Random(5)
    for letters in ("ab", "abc ", "aé\U0001f600 \0") * 8:
        texts = ["".join(some.choices(letters, k=some.randrange(60))) for _ in range(5)]
        names = {"".join(some.choices(letters, k=some.choice([1, 2, 3, 5, 8, 9, 20]))) for _ in range(9)}
        names = sorted(names | {t[3:20] for t in texts if len(t) > 3})
        wanted = [(i, n) for i, t in enumerate(texts) for n in names if n in t]
        table = pieces.NameTable(pa.array(names, pa.string()))
        assert sorted((i, names[n]) for i, n in zip(*(x.tolist() for x in table.found(texts)))) == wanted
        block = pieces.Block(table.known)
        block.add(pa.array(range(5)), texts)
        rows = block.batch(7, ["_block", "_piece", "_at", "_keys"]).to_pylist()
        assert rows[-1] == {"_block": 7, "_piece": None, "_at": None, "_keys": [0, 1, 2, 3, 4]}
        assert sorted((i, r["_piece"]) for r in rows[:-1] if r["_piece"] in names for i in r["_at"]) == wanted


def test_a_block_sends_a_string_once():
    """What meets the names is a row per string and block of texts, whatever the number of texts that hold it."""
    import pyarrow as pa
    from gramledger.operators import pieces

    known = pieces.NameTable(pa.array(["cold", "gear"])).known
    block = pieces.Block(known)
    for start in range(0, 4000, 200):
        block.add(pa.array(range(start, start + 200)), ["cold gears, cold"] * 200)
    rows = block.batch(1, ["_block", "_piece", "_at", "_keys"]).to_pylist()
    assert {r["_piece"] for r in rows[:2]} == {"cold", "gear"} and len(rows) == 3
    assert rows[0]["_at"] == rows[1]["_at"] == rows[2]["_keys"] == list(range(4000))


@pytest.mark.parametrize("strategy", ["grams", "shuffle"])
def test_rows_of_one_key(spark, strategy):
    """A repeated key was never refused: ``grams`` gives each of its rows the names of all, ``shuffle`` one row per text."""
    left = spark.createDataFrame([(1, "cold gear"), (1, "cold gear"), (2, "x"), (None, "gear")], "k int, t string")
    right = spark.createDataFrame([("COLD",), ("GEAR",)], "name string")
    rows = contains_join(left, right, "k", "t", "name", strategy=strategy).collect()
    times = 2 if strategy == "grams" else 4
    wanted = [(1, "COLD")] * times + [(1, "GEAR")] * times + [(2, None), (None, "GEAR")]
    assert sorted(((r["k"], r["name"]) for r in rows), key=str) == sorted(wanted, key=str)
