"""The training-data operators against brute force, and the same awkward rows for each of them."""

from __future__ import annotations

import hashlib
import random
import textwrap
import tracemalloc
import zlib
from collections import Counter
from pathlib import Path

import compare
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

import corpus_pipeline
from gramledger.llm import (
    decontamination,
    language_id,
    license_scan,
    lm_score,
    neighbours,
    packing,
    queries,
    simhash,
    suffix_dedup,
    toxicity,
    url_filter,
)
from gramledger.session import shared_folder

FOLDER = "/root/testdata/sf0.001"
DOCS = "doc_id long, text string, lang string, score string, n_bytes int"
needs_tables = pytest.mark.skipif(not Path(FOLDER).exists(), reason="driver tables are not here")


def words(rng: random.Random, n: int) -> str:
    return " ".join(rng.choice("the of and in erth ananon tion stre wh ly ou ha ndor".split()) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    """Nulls, empty and very long texts, repeated rows and ids, other scripts, periods, shared passages."""
    rng = random.Random(3)
    passage = words(rng, 120)
    long_text = words(rng, 20_000)
    out = [
        (1, None, "en", "x", 1),
        (2, "", None, "x", 1),
        (None, "The end.", "en", None, None),
        (3, "  \t\n", "en", "x", 1),
        (4, "ab" * 700, "en", "x", 1),
        (5, long_text, "en", "x", 1),
        (6, passage + " one. " + words(rng, 30), "en", "x", 1),
        (7, words(rng, 25) + " two. " + passage, "en", "x", 1),
        (8, "日本語 é ü <|endoftext|> it's " * 40, "fr", "x", 1),
        (9, long_text[500:2000], "en", "x", 1),
    ]
    out += [(10 + i, words(rng, 40 + i), "en", "x", 1) for i in range(20)]
    out += [(40 + i, "Le où été élève garçon " * (3 + i), "fr", "x", 1) for i in range(6)]
    return out + [out[6], out[7], (6, "another text of the same id", "en", "x", 1)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, DOCS).repartition(5)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], DOCS)


def test_repeated_passages(docs, rows, empty):
    counts = Counter(b[i : i + 400] for _, t, *_ in rows for b in [(t or "").encode()] for i in range(len(b) - 399))
    wanted = Counter()
    for doc_id, text, *_ in rows:
        data = (text or "").encode()
        gone = np.zeros(len(data), bool)
        for i in range(len(data) - 399):
            if counts[data[i : i + 400]] > 1:
                gone[i : i + 400] = True
        left = np.frombuffer(data, np.uint8)[~gone].tobytes()
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        wanted[doc_id, len(data), int(gone.sum()), spans, hashlib.sha256(left).hexdigest()] += 1
    assert Counter(map(tuple, suffix_dedup.remove_repeats(docs).collect())) == wanted
    assert suffix_dedup.remove_repeats(empty).count() == 0


def test_repeats_too_short_to_be_removed_are_told(spark, tmp_path):
    rng = random.Random(8)
    letters = "abcdefghijklmnopqrstuvwxyz"
    own = lambda n: " ".join("".join(rng.choices(letters, k=5)) for _ in range(n))
    short, long_ = own(55), own(90)  # 329 and 539 bytes
    texts = [f"{own(150)} {short} {own(150)}", f"{own(90)} {short} {own(60)}", own(300), None, "ab" * 600]
    texts += [f"{own(100)} {long_} {own(40)}", f"{long_} {own(200)}"]
    spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op1_suffix_dedup(spark, str(tmp_path)).collect()}
    assert found[0].asDict().keys() == {"doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "longest_repeat"}
    told = {i: (r["n_removed"] > 0, r["longest_repeat"]) for i, r in found.items()}
    assert all(not told[i][0] and 128 <= told[i][1] <= 331 for i in (0, 1))
    assert told[2] == told[3] == (False, 0) and told[4] == (True, 1200)
    assert all(told[i][0] and 539 <= told[i][1] <= 541 for i in (5, 6))


def test_simhash_components(docs, rows, empty):
    def mark(text):
        w = (text or "").encode().lower().split()
        shingles = [b" ".join(w[i : i + 3]) for i in range(len(w) - 2)] or ([b" ".join(w)] if w else [])
        h = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
        return sum(1 << k for k in range(64) if 2 * sum(x >> k & 1 for x in h) > len(h))

    marks = [(doc_id, mark(text)) for doc_id, text, *_ in rows]
    group = list(range(len(marks)))
    for _ in marks:
        for i, (_, a) in enumerate(marks):
            group[i] = min(group[j] for j, (_, b) in enumerate(marks) if (a ^ b).bit_count() <= 2)
    least = {}
    for g, (doc_id, _) in zip(group, marks):
        if doc_id is not None:
            least[g] = min(least.get(g, doc_id), doc_id)
    wanted = Counter((d, f"{m:016x}", least.get(g)) for g, (d, m) in zip(group, marks))
    for block_rows in (512, 4):
        found = simhash.near_duplicates(docs, block_rows=block_rows)
        assert Counter(map(tuple, found.collect())) == wanted
    assert simhash.near_duplicates(empty).count() == 0


def test_simhash_index_is_exact():
    rng = np.random.default_rng(1)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    flips = np.uint64(1) << rng.integers(0, 64, (40, 30, 2)).astype(np.uint64)
    marks = np.unique(np.bitwise_xor.reduce(flips, 2) ^ base[:, None])
    index = simhash.Index(marks)
    found = {(int(marks[q]), int(index.marks[n])) for a, b in index.search(marks, 2) for q, n in zip(a, b)}
    near = np.bitwise_count(marks[:, None] ^ marks) <= 2
    assert found == {(int(marks[i]), int(marks[j])) for i, j in zip(*np.nonzero(near))}


def test_simhash_search_has_bounded_memory(spark):
    rng = np.random.default_rng(2)
    marks = np.unique(rng.integers(0, 2**63, 512, dtype=np.uint64))
    queries_ = np.concatenate((marks, rng.integers(0, 2**63, 16384 - len(marks), dtype=np.uint64)))
    index = simhash.Index(marks)
    tracemalloc.start()
    label = simhash._labels(len(queries_), index.search(queries_, 64))  # all are near: no branch is left out
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert (label == 0).all() and peak < 100e6
    # and a task of a stage has one Python worker, not one for each step
    frame = spark.createDataFrame([(int(m),) for m in marks], "fp long")
    plan = simhash.links(frame, block_rows=32)._jdf.queryExecution().executedPlan().toString()
    assert plan.count("MapInArrow ") == 1


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(50)] + [(1000, 1000 + i) for i in range(1, 40)]
    found = dict(map(tuple, simhash.components(spark.createDataFrame(links, "a long, b long")).collect()))
    assert found == {**{i: 0 for i in range(51)}, **{1000 + i: 1000 for i in range(40)}}


def test_packing_round_trip(docs, rows, empty):
    from tokenizers import Tokenizer

    paths = queries.tokenizer_paths()
    tokenizer = Tokenizer.from_file(paths[0])
    tokenizer.encode_special_tokens = True
    wanted = Counter()
    for doc_id, text, *_ in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        at, size = 0, len(ids) % 1024 or 1024
        for piece in range(-(-len(ids) // 1024)):
            part = np.array(ids[at : at + size], "<u4").tobytes()
            wanted[doc_id, piece, at, size, zlib.crc32(part)] += 1
            at, size = at + size, 1024
    for ranks in (paths[1], None):
        found = packing.pack(docs, paths[0], ranks).collect()
        assert Counter(tuple(r)[:5] for r in found) == wanted
        held = {}
        for r in sorted(found, key=lambda r: (r["sequence_id"], r["offset"])):
            assert held.get(r["sequence_id"], 0) == r["offset"]
            held[r["sequence_id"]] = r["offset"] + r["length"]
        assert max(held.values()) <= 1024
        assert len(held) <= -(-sum(held.values()) // 1024) + 1
    assert packing.pack(empty, *paths).count() == 0


def test_packing_plan_is_near_the_bound():
    rng = np.random.default_rng(2)
    histogram = np.bincount(rng.integers(1, 1025, 20_000), minlength=1025)
    table = packing.plan(histogram)
    least = (histogram * np.arange(1025)).sum() / 1024
    assert least <= table["sequence"].max() + 1 <= 1.02 * max(least, histogram[513:].sum())


@pytest.mark.parametrize("kind", ["short", "wide", "uniform", "few"])
def test_configurations_carry_the_packing(kind):
    rng = np.random.default_rng(4)
    limit = 256
    sizes = {
        "short": np.clip(rng.lognormal(3.8, 0.7, 20_000), 1, limit - 1),
        "wide": np.clip(rng.lognormal(4.4, 0.9, 20_000), 1, limit - 1),
        "uniform": rng.integers(1, limit, 20_000),
        "few": rng.choice([150, 100, 53, 3, 1], 20_000),
    }[kind].astype(np.int64)
    histogram = np.bincount(sizes, minlength=limit + 1)
    columns, bound = packing.configurations(histogram, limit)
    assert columns and all(c @ np.arange(limit + 1) <= limit and (c <= histogram).all() for c, _ in columns)
    covered = sum(c * amount for c, amount in columns)
    assert (covered <= histogram + 1e-3).all() and covered.sum() > 0.9 * histogram.sum()
    made = packing.rounded(histogram, limit)
    assert (sum(c * times for c, times in made) == histogram).all()
    number, plain = (sum(times for _, times in bins) for bins in (made, packing.best_fit(histogram, limit)))
    assert bound <= number <= plain and number <= 1.01 * bound + np.count_nonzero(histogram)
    if kind in ("short", "wide"):  # the program's own bins, not best-fit's
        assert number < plain and any((c == d).all() for c, _ in made for d, _ in columns)


def test_knapsack_by_brute_force():
    rng = np.random.default_rng(6)
    for _ in range(40):
        most = rng.integers(0, 3, 13)
        most[0] = 0
        value = rng.random(13)
        best = {0: 0.0}
        for n in range(1, 13):
            for _ in range(most[n]):
                for room, worth in list(best.items()):
                    if room + n <= 12:
                        best[room + n] = max(best.get(room + n, 0.0), worth + value[n])
        found = packing.knapsack(value, most, 12)
        assert (found <= most).all() and found @ np.arange(13) <= 12
        assert found @ value == pytest.approx(max(best.values()))


def test_language_and_rejection(docs, empty):
    model = language_id.learn(docs)
    found = {r["doc_id"]: r for r in language_id.predict(docs, model).collect()}
    assert [found[k]["lang_pred"] for k in (1, 2, 3, 5, 41)] == ["und", "und", "und", "en", "fr"]
    assert all(0 <= r["score"] <= 1 for r in found.values())
    none = language_id.learn(empty)
    assert none is None and language_id.predict(docs, none).where("lang_pred != 'und'").count() == 0


def test_every_language_is_learned(spark, monkeypatch):
    rng = random.Random(9)
    letters = [chr(0x4E00 + i) for i in range(70 * 6)]  # six letters of its own for each of 70 languages
    text = lambda k, n: "".join(rng.choice(letters[6 * k : 6 * k + 6] + [" "]) for _ in range(n))
    rows = [(k, text(k, 400 - k), f"x{k:02}") for k in range(70)]
    asked = spark.createDataFrame([(k, text(k, 60)) for k in range(70)], "doc_id long, text string")
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = {r["doc_id"]: tuple(r) for r in language_id.predict(asked, language_id.learn(docs)).collect()}
    assert all(found[k][1] == f"x{k:02}" for k in range(70))
    monkeypatch.setattr(language_id, "CELLS", 0)  # trees instead of a table, and few texts together
    monkeypatch.setattr(language_id, "TEXT_CELLS", 200)
    again = {r["doc_id"]: tuple(r) for r in language_id.predict(asked, language_id.learn(docs)).collect()}
    assert all(again[k] == pytest.approx(found[k]) for k in range(70))


def test_language_sample_is_filled(spark, monkeypatch):
    monkeypatch.setattr(language_id, "SAMPLE_BYTES", 20_000)
    rng = random.Random(10)
    text = lambda n: "".join(rng.choice("abcdefgh ") for _ in range(n))
    rows = [(text(1000), "copies") for _ in range(100)] + [(text(1000), "copies")] * 10_000
    rows += [(text(20), "long") for _ in range(30)] + [(text(3_000_000), "long") for _ in range(2)]
    _, few = language_id._sample(spark.createDataFrame(rows, "text string, lang string"), "text", "lang")
    found = {}
    for r in few.collect():
        found.setdefault(r["lang"], []).append(r["text"])
    assert len(found["copies"]) == len(set(found["copies"])) == 20
    assert sum(map(len, found["long"])) >= 600  # all short ones, or a long one and what is before it


def test_ppm_probabilities_sum_to_less_than_one():
    values, _ = language_id.runs(language_id.led(b"abracadabra " * 20))
    keys, n = np.unique(values, return_counts=True)
    tree = language_id._tree(keys, n)
    after = np.uint64(int.from_bytes(b"abra", "big") << 8) + np.arange(256, dtype=np.uint64)
    total = np.exp2(-language_id._bits(after, tree).astype(float)).sum()
    assert 0.5 < total <= 1.0 + 1e-6


def test_ppm_codes_long_texts_in_parts(monkeypatch):
    text = words(random.Random(8), 900).encode()
    texts = [text, b"", text[:7], text[100:2500]]
    keys, n = np.unique(language_id.runs(language_id.led(text[:3000]))[0], return_counts=True)
    tree = language_id._tree(keys, n)
    model = {"names": ["a"], "trees": [tree], "known": keys, "bits": language_id._bits(keys, tree)[:, None]}
    whole = language_id.code_lengths(texts, model)
    values = np.array([int.from_bytes((language_id.START + text)[i : i + 5], "big") for i in range(len(text))], np.uint64)
    assert whole[0, 0] == pytest.approx(language_id._bits(values, tree).sum(dtype=float))
    monkeypatch.setattr(language_id, "PART", 64)
    assert language_id.code_lengths(texts, model) == pytest.approx(whole)


def test_toxicity_finds_the_sentence(spark):
    rng = random.Random(5)
    rows = [(i, ". ".join(words(rng, 8) for _ in range(6)), 0) for i in range(300)]
    rows += [(1000 + i, f"{words(rng, 9)}. you utter clown {words(rng, 3)}. {words(rng, 9)}.", 1) for i in range(80)]
    docs = spark.createDataFrame([r[:2] for r in rows] + [(9, None), (9, "")], "doc_id long, text string")
    labels = spark.createDataFrame([(r[0], r[2]) for r in rows] + [(None, 1), (5000, None)], "doc_id long, toxic int")
    found = toxicity.score(docs, toxicity.learn(docs, labels))
    by_id = {r["doc_id"]: r for r in found.collect()}
    assert sum(by_id[i]["predicted"] for i in range(300) if i != 9) <= 3
    assert sum(by_id[1000 + i]["predicted"] for i in range(80)) >= 77
    assert sum(by_id[1000 + i]["sentence"] == 1 for i in range(80)) >= 77
    none = labels.where("false")
    assert toxicity.score(docs, toxicity.learn(docs, none)).where("predicted = 1").count() == 0


def test_toxicity_learns_rare_insults():
    """Ten insults, each in 0.3 % of the documents, among thousands of words as rare."""
    rng = random.Random(5)
    texts, labels = [], []
    for i in range(6000):
        sentences = [[f"w{int(rng.paretovariate(0.6))}" for _ in range(10)] for _ in range(4)]
        if i % 1000 < 30:
            sentences[rng.randrange(4)].insert(rng.randrange(10), f"insult{i % 10}")
        texts.append(". ".join(map(" ".join, sentences)).encode())
        labels.append(int(i % 1000 < 30))
    weights, bias = toxicity.train(texts[:4000], np.array(labels[:4000]))
    bags = toxicity.Bags(texts[4000:])
    logits = toxicity.sentence_logits(bags, weights, bias)
    predicted = -np.expm1(toxicity.sums(toxicity.clean_chance(logits), bags.text_first, bags.text_count)) >= 0.5
    toxic = np.array(labels[4000:]) == 1
    assert predicted[toxic].sum() >= 54  # of 60
    assert predicted[~toxic].sum() <= 5


def test_language_model_base_and_distribution(docs, rows, empty):
    def tokens(text):
        return [w for w in (text or "").encode().lower().split()] + ["end"]

    held = [zlib.crc32(str("" if d is None else d).encode()) % 5 == 1 for d, *_ in rows]
    counts = Counter(w for h, (_, t, *_) in zip(held, rows) if not h for w in tokens(t))
    n, v = sum(counts.values()), len(counts)
    wanted = Counter()
    for h, (doc_id, text, *_) in zip(held, rows):
        w = tokens(text)
        base = sum(np.log10((counts[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        wanted[doc_id, h, len(w), sum(counts[x] > 0 for x in w), n, round(base, 6)] += 1
    found = lm_score.score(docs).collect()
    assert Counter((*tuple(r)[:5], round(r["base_score"], 6)) for r in found) == wanted
    assert all(r["score"] < 0 for r in found)
    assert lm_score.score(empty).count() == 0
    model = lm_score.Mixer(np.ones((lm_score.ORDERS, 1 << 19), "f4"), np.ones((lm_score.ORDERS, 1 << 19), "f4"))
    every = np.uint64(0x6162636465) * np.uint64(256) + np.arange(256, dtype=np.uint64)
    assert np.exp2(-model.bits(every)).sum() == pytest.approx(1.0)


def test_language_model_learns_from_all_texts(spark):
    """Weights and map are those of a plain loop over every text, of which there is more than half a megabyte."""
    rng = np.random.default_rng(7)
    words = [bytes(rng.integers(97, 110, rng.integers(2, 8)).tolist()).decode() for _ in range(300)]
    texts = [" ".join(rng.choice(words, 3000)) for _ in range(50)]
    frame = spark.createDataFrame([(t,) for t in [*texts, None, ""]], "text string").repartition(5)
    model = lm_score.learn(frame)
    values, sizes = lm_score.runs([t.encode() for t in [*texts, "", ""]])
    assert len(values) > 1 << 19
    plain = lm_score.Mixer(model.zeros, model.ones)
    begun = plain.bits(values).sum()
    for _ in range(lm_score.ROUNDS):
        sums = lm_score._empty_sums()
        plain.added(values, np.ones(len(values)), sums)
        assert (sums["hits"].sum(1) == len(values)).all()
        plain.step(sums)
    assert np.allclose(model.weights, plain.weights) and np.allclose(model.map, plain.map)
    assert plain.bits(values).sum() < begun


def test_language_model_knows_what_the_corpus_repeats(spark):
    """A text that is learned from twice is told from the others; its score is that of a plain mix, phrase by phrase."""
    rng = np.random.default_rng(11)
    words = ["".join(map(chr, rng.integers(97, 110, rng.integers(2, 8)))) for _ in range(60)]
    texts = [" ".join(rng.choice(words, 150)) for _ in range(120)]
    twice = set(range(0, 30))
    rows = [(i, t) for i, t in enumerate(texts)] + [(1000 + i, texts[i]) for i in sorted(twice)] + [(5000, None), (5001, "")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    found = {r["doc_id"]: r for r in lm_score.score(frame).collect()}
    learned = {i for i, r in found.items() if not r["held_out"]}
    apart = [found[i]["bits_per_byte"] for i in twice if 1000 + i in learned]
    others = [found[i]["bits_per_byte"] for i in range(120) if i not in twice]
    assert len(apart) > 15 and max(apart) < 0.5 * min(others)

    model = lm_score.learn(frame.where(F.col("doc_id").isin(sorted(learned))))
    lists = {i: lm_score.runs([(t or "").encode()])[0] for i, t in rows}
    cut = {}
    for i, values in lists.items():
        parts, start = [], 0
        for k in range(1, len(values) + 1):
            ends = lm_score.mixed(values[k - 1 : k])[0] >> np.uint64(64 - lm_score.PHRASE_BITS) == 0
            if k == len(values) or (ends and values[k] != values[k - 1]):
                parts.append(values[start:k].tobytes())
                start = k
        cut[i] = parts
    seen = Counter(p for i in learned for p in cut[i])
    total = sum(seen.values())
    share = sum(n for n in seen.values() if n > 1) / (total + 1)
    for i, _ in rows:
        bits, own = 0.0, i in learned
        for p in cut[i]:
            by_bytes = model.bits(np.frombuffer(p, np.uint64)).sum()
            bits -= np.log2((1 - share) * 2.0**-by_bytes + share * (seen[p] - own) / (total - own))
        assert found[i]["score"] == pytest.approx(-bits * np.log10(2), rel=1e-6)


def test_phrases_of_few_and_odd_texts(monkeypatch):
    for texts in ([], [b""], [b"", b""], [b"a" * 5000, b"", b"ab" * 3000, bytes(range(1, 200)) * 20]):
        values, sizes = lm_score.runs(texts)
        starts, keys, count = lm_score.phrases(values, sizes)
        assert len(starts) == len(keys) == count.sum() and len(count) == len(texts) and (count > 0).all()
        assert set(np.cumsum(sizes) - sizes) <= set(starts.tolist())
        assert len(texts) < 4 or count[0] < 8
        with monkeypatch.context() as patch:
            patch.setattr(lm_score, "SCRAMBLED", 7)
            assert all((x == y).all() for x, y in zip(lm_score.phrases(values, sizes), (starts, keys, count)))
    assert lm_score.mixed_lengths(np.array([5.0, 1e6]), np.array([0, 0]), np.array([0, 0]), 0.0).tolist() == [5.0, 1e6]
    assert np.isfinite(lm_score.mixed_lengths(np.array([1e6, 1e6]), np.array([0, 3]), np.array([9, 9]), 0.9)).all()


def test_neighbours_by_brute_force(spark):
    rng = np.random.default_rng(4)
    x = rng.standard_normal((1500, 16)).astype(np.float32)
    x[100:700] = x[50]
    table = [(i, v.tolist()) for i, v in enumerate(x)]
    bad = [(5000, None), (5050, [0.0] * 16), (5100, [float("nan")] * 16), (None, x[0].tolist()), (5150, [1.0, 2.0])]
    df = spark.createDataFrame(table + bad, "vec_id long, embedding array<float>")
    found = {}
    for r in neighbours.nearest(df, shard_rows=300, enough=150).collect():
        found.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    unit = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    hits = 0
    for q in range(0, 1500, 50):
        score = unit @ unit[q]
        score[q] = -9
        best = [int(i) for i in np.lexsort((np.arange(1500), -np.round(score, 12)))[:5]]
        got = [v for _, v, _ in sorted(found[q])]
        hits += len(set(best) & set(got))
        assert all(s == pytest.approx(score[v], abs=1e-12) for _, v, s in found[q])
    assert hits / 150 >= 0.9
    assert [v for _, v, _ in sorted(found[50])] == [100, 101, 102, 103, 104]
    assert set(found) == set(range(0, 1500, 50)) | ({5150} & set(found))
    assert neighbours.nearest(df.where("false")).count() == 0


def test_neighbours_recall_does_not_fall_with_the_shard(spark):
    x = np.random.default_rng(6).standard_normal((4096, 64))
    x /= np.linalg.norm(x, axis=1)[:, None]
    for n in (2000, 4096):
        df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x[:n])], "vec_id long, embedding array<double>")
        found = {(r["query_id"], r["vec_id"]) for r in neighbours.nearest(df).collect()}
        hits = 0
        for q in range(0, n, 50):
            score = x[:n] @ x[q]
            score[q] = -9
            hits += sum((q, int(i)) in found for i in np.argsort(-score)[:5])
        assert hits / (5 * len(range(0, n, 50))) >= 0.9


def test_neighbours_hold_a_block_of_queries(spark, monkeypatch):
    def cogroup(*args):
        raise AssertionError("all queries of a shard would meet in one group")

    grouped = type(spark.range(1).groupBy("id"))
    monkeypatch.setattr(grouped, "cogroup", cogroup)
    monkeypatch.setattr(neighbours, "QUERY_BLOCK", 7)
    x = np.random.default_rng(8).standard_normal((300, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(x)], "vec_id long, embedding array<double>")
    found = neighbours.nearest(df, every=3, shard_rows=100, enough=10**6).collect()  # all are compared
    unit = x / np.linalg.norm(x, axis=1)[:, None]
    want = {}
    for q in range(0, 300, 3):
        score = unit @ unit[q]
        score[q] = -9
        want |= {(q, r + 1): int(i) for r, i in enumerate(np.argsort(-score)[:5])}
    assert {(r["query_id"], r["rank"]): r["vec_id"] for r in found} == want
    # a block has rows of one shard and one kind, whatever the batches are
    batch = pa.table({"shard": [0] * 20 + [1] * 9, "asks": [False] * 3 + [True] * 17 + [False] * 9}).to_batches()[0]
    parts = [(p.num_rows, p.column(0).unique().to_pylist(), p.column(1).unique().to_pylist()) for p in neighbours.blocks(batch, 7)]
    assert parts == [(3, [0], [False]), (7, [0], [True]), (7, [0], [True]), (3, [0], [True]), (7, [1], [False]), (2, [1], [False])]


def test_decontamination_edges(spark, monkeypatch):
    monkeypatch.setattr(decontamination, "BLOCK_BYTES", 100)  # several blocks
    long_item = " ".join(f"w{i}" for i in range(20))
    items = [("a", long_item), ("b", "Short ITEM here"), (None, "w1 w2 w3 w4"), ("c", ""), ("d", None), ("a", long_item)]
    bench = spark.createDataFrame(items, "item_id string, text string")
    texts = [
        (1, "x " + " ".join(f"W{i}," for i in range(3, 16)) + " y", 15, 13, ["a"]),
        (2, "a short item, here: " * 30, 120, 90, ["b"]),
        (3, None, 0, 0, []),
        (4, long_item, 20, 20, ["", "a"]),
        (5, " ".join(f"w{i}" for i in range(3, 15)), 12, 0, []),
    ]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    found = {r["doc_id"]: tuple(r)[1:5] for r in decontamination.contamination(docs, bench).collect()}
    for doc_id, _, n, hit, names in texts:
        assert found[doc_id] == (n, hit, len(names), hashlib.sha256(",".join(names).encode()).hexdigest())
    assert decontamination.contamination(docs, bench.where("false")).where("contaminated").count() == 0


def test_urls(spark):
    urls = ["http://A.Net/x", "https://www.example.net/en/1?q", "ftp://a.org/fr/2#x", None, "no scheme", "http://b.net"]
    df = spark.createDataFrame(list(enumerate(urls)) + [(0, urls[0])], "page_id long, url string")
    found = Counter(tuple(r)[:5] for r in url_filter.judge(df).collect())
    assert found[0, "a.net", "/x", "net/", "block"] == 2
    assert found[1, "www.example.net", "/en/1", "example.net/en/", "allow"] == 1
    assert found[2, "a.org", "/fr/2", "org/fr/", "allow"] == 1
    assert found[3, "", "", None, "allow"] == found[4, "", "", None, "allow"] == found[5, "b.net", "", None, "allow"] == 1
    assert url_filter.judge(df.where("false")).count() == 0


def test_url_template_learns_from_labels(spark):
    rows = [(i, f"http://h.org/fr/{i}") for i in range(60)] + [(100 + i, f"http://h.org/x/{i}") for i in range(60)]
    rules = (("block", "h.org", "/x/"), ("allow", "h.org", "/fr/"))
    found = url_filter.judge(spark.createDataFrame(rows, "page_id long, url string"), rules=rules)
    assert {r["template"] for r in found.collect()} == {"/fr/*", "/x/*"}


def test_licenses(docs, spark, empty):
    df = spark.createDataFrame([(1, "a text\nReleased under the MIT License!\nmore"), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(df).collect()}
    assert (found[1]["license"], found[1]["n_lines"], found[1]["dice"]) == ("MIT", 1, 1.0)
    assert (found[2]["license"], found[2]["dice"]) == (None, 0.0)
    assert license_scan.scan(docs).count() == docs.count() and license_scan.scan(empty).count() == 0


def test_licenses_over_lines_and_within_them(spark):
    rng = random.Random(12)
    prose = " ".join(words(rng, 50) for _ in range(20))
    wrap = lambda t: "\n".join(textwrap.wrap(t, 79))
    whole = license_scan.WHOLE["MIT-text-whole"]
    texts = [
        (1, wrap(license_scan.TEMPLATES["MIT-text"]) + "\n\n" + prose, "MIT-text"),
        (2, "MIT License\n\nCopyright (c) 2020 Someone\n\n" + wrap(whole), "MIT-text"),  # both are there
        (3, f"{prose} This work is licensed under a Creative Commons Attribution 4.0 International License. {prose}", "CC-BY-4.0-notice"),
        (4, prose, None),
    ]
    docs = spark.createDataFrame([t[:2] for t in texts], "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(docs).collect()}
    assert {i: found[i]["license"] for i, _, _ in texts} == {i: name for i, _, name in texts}
    assert all(found[i]["dice"] > 0.95 for i in (1, 2, 3))
    full = license_scan.Templates({"whole": whole})
    assert full.runs([texts[1][1].encode()], 0.8)[2].max() == 1.0


def test_stages_keep_their_columns(spark, docs, empty, tmp_path):
    bench = spark.createDataFrame([(1, "not in any of the texts at all")], "item_id long, text string")
    bench.write.parquet(f"{tmp_path}/benchmark.parquet")
    for frame in (docs, empty):
        current = frame.withColumn("lang_pred", F.lit("mine")).withColumn("component_id", F.lit(1))
        for _, stage in corpus_pipeline.STAGES[:-1]:
            out = stage(spark, current, str(tmp_path))
            assert out.columns == current.columns
            out.count()
        assert stage(spark, current.where("doc_id = 10"), str(tmp_path)).count() == (1 if frame is docs else 0)


def test_near_copies_go_without_another_copy_of_the_texts(spark, docs, rows, tmp_path):
    before = Counter(r[1:] for r in rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    shared = Path(shared_folder(spark).removeprefix("file://"))
    there = set(shared.iterdir())
    scan = spark.read.parquet(f"{tmp_path}/documents.parquet")
    kept = corpus_pipeline.keep_one_of_near_copies(spark, scan, str(tmp_path))
    found = kept.collect()
    assert not [p.name for p in set(shared.iterdir()) - there if "text" in spark.read.parquet(str(p)).columns]
    # one row per component: the one of the smallest id, whole; the same from a frame that is no file
    least = {r["component_id"] for r in simhash.near_duplicates(scan).collect()}
    assert Counter(r["doc_id"] for r in found) == Counter(least)
    assert all(tuple(r)[1:] in before for r in found)
    other = corpus_pipeline.keep_one_of_near_copies(spark, docs, str(tmp_path))
    assert Counter(r["doc_id"] for r in other.collect()) == Counter(least)


@needs_tables
@pytest.mark.parametrize("name", sorted(queries.ORACLE))
def test_equals_sql(spark, name):
    columns, found = compare.spark_rows(queries.QUERIES[name](spark, FOLDER))
    assert (columns, found) == compare.duck_rows(compare.duck(FOLDER), queries.ORACLE[name])


@needs_tables
def test_pipeline_runs(spark):
    assert corpus_pipeline.run(spark, FOLDER).count() > 100
