"""Learned operators against plain loops, and rows that are awkward for them."""

from __future__ import annotations

import math
import random
import re
from collections import defaultdict

import numpy as np
import pytest

from gramledger.llm import decontamination, language_id, license_scan, toxicity, url_filter

WORDS = "the of and in erth ananon tion stre wh ly vile brute ou ha ndor".split()


def sentences(text):
    """Word lists of the sentences that have words."""
    found = [re.findall(r"[0-9A-Za-z\x80-\U0010ffff]+", s.lower()) for s in re.split(r"[\n!.?]", text)]
    return [s for s in found if s]


def slot(word):
    return int(toxicity.Bags([word.encode()]).slots[0])


def sigmoid(x):
    return 1 / (1 + math.exp(-x))


def labelled(n=60, seed=2):
    rng = random.Random(seed)
    texts, labels = [], []
    for i in range(n):
        parts = [" ".join(rng.choice(WORDS[:10] + WORDS[12:]) for _ in range(rng.randrange(1, 7))) for _ in range(rng.randrange(1, 6))]
        if i % 3 == 0:
            parts[rng.randrange(len(parts))] += " vile brute"
        texts.append(rng.choice([". ", "! ", "\n", "?"]).join(parts))
        labels.append(int(i % 3 == 0) if rng.random() < 0.95 else 1 - int(i % 3 == 0))
    return texts, np.array(labels)


def test_toxicity_training_by_plain_loops():
    texts, labels = labelled()
    weights, bias = toxicity.train([t.encode() for t in texts], labels)
    bags = [[[slot(w) for w in s] for s in sentences(t)] for t in texts]
    used = sorted({w for bag in bags for s in bag for w in s})
    w, b = dict.fromkeys(used, 0.0), -4.0
    first, second = defaultdict(float), defaultdict(float)
    for step in range(1, toxicity.STEPS + 1):
        pull = defaultdict(float)
        for bag, y in zip(bags, labels.tolist()):
            p_of = [sigmoid(b + sum(w[x] for x in s)) for s in bag]
            clean = math.prod(1 - p for p in p_of)  # noisy-or: the document is clean if all its sentences are
            for s, p in zip(bag, p_of):
                # d(-log P) / d logit of the sentence
                slope = (p if y == 0 else -clean / max(1 - clean, 1e-9) * p) / len(texts)
                pull["bias"] += slope
                for x in s:
                    pull[x] += slope
        for x in [*used, "bias"]:
            g = pull[x]
            if x != "bias":
                rest = math.copysign(max(abs(g) - toxicity.PENALTY, 0.0), g)
                g = rest if w[x] == 0 else g + math.copysign(toxicity.PENALTY, w[x])
            first[x] = 0.9 * first[x] + 0.1 * g
            second[x] = 0.99 * second[x] + 0.01 * g * g
            move = 0.15 * (first[x] / (1 - 0.9**step)) / (math.sqrt(second[x] / (1 - 0.99**step)) + 1e-9)
            if x == "bias":
                b -= move
            else:
                w[x] = 0.0 if (w[x] - move) * w[x] < 0 else w[x] - move
    assert bias == pytest.approx(b, abs=1e-6)
    assert [weights[x] for x in used] == pytest.approx([w[x] for x in used], abs=1e-6)
    assert not weights[np.setdiff1d(np.arange(toxicity.SLOTS), used)].any()


def test_toxicity_scores_by_plain_loops(spark):
    texts, labels = labelled()
    weights, bias = toxicity.train([t.encode() for t in texts], labels)
    long_text = ". ".join(texts * 300)
    rows = [(i, t) for i, t in enumerate([*texts, None, "", "... !", long_text, texts[0]])]
    frame = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = {r["doc_id"]: r for r in toxicity.score(frame, (weights, bias)).collect()}
    assert len(found) == len(rows)
    for doc_id, text in rows:
        logits = [bias + sum(weights[slot(w)] for w in s) for s in sentences(text or "")]
        p = 1 - math.prod(1 - sigmoid(x) for x in logits)
        assert found[doc_id]["score"] == pytest.approx(p, abs=1e-4)
        if logits:
            assert found[doc_id]["sentence"] == int(np.argmax(np.round(logits, 5)))
        else:
            assert found[doc_id]["score"] == 0 and found[doc_id]["sentence"] == -1
    empty = frame.where("doc_id < 0")
    assert toxicity.score(empty, (weights, bias)).count() == 0


def plain_code_length(text, learned):
    """Method C without exclusion: counts of every context of up to four bytes, in dictionaries."""
    counts = [defaultdict(lambda: defaultdict(int)) for _ in range(5)]
    for sample in learned:
        data = b"\n" * 4 + sample.encode()
        for i in range(4, len(data)):
            for order in range(5):
                counts[order][data[i - order : i]][data[i]] += 1
    data, bits = b"\n" * 4 + text.encode(), 0.0
    for i in range(4, len(data)):
        for order in range(4, -1, -1):
            seen = counts[order].get(data[i - order : i])
            if seen is None:
                continue
            total = sum(seen.values()) + len(seen)
            if data[i] in seen:
                bits += math.log2(total / seen[data[i]])
                break
            bits += math.log2(total / len(seen))
        else:
            bits += 8
    return bits


def test_code_lengths_by_plain_counting(spark):
    learned = {
        "aa": ["the end of the year", "an end to this", "\xe9t\xe9"],
        "bb": ["el fin del a\xf1o", "la casa es as\xed"],
        "cc": ["der Stra\xdfe entlang"],
    }
    rows = [(i, t, lang) for i, (lang, t) in enumerate((lang, t) for lang, ts in learned.items() for t in ts)]
    model = language_id.learn(spark.createDataFrame(rows, "doc_id long, text string, lang string"))
    texts = ["the end", "casa del fin", "Stra\xdfe", "日本", "zzz", "the end of the year " * 50]
    found = language_id.code_lengths([t.encode() for t in texts], model)
    assert model["names"] == ["aa", "bb", "cc"]
    for text, row in zip(texts, found):
        assert row == pytest.approx([plain_code_length(text, learned[n]) for n in model["names"]], rel=1e-5)


def test_equal_code_lengths_go_to_the_first_tag(spark):
    rows = [(1, "same text", "yy"), (2, "same text", "xx")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    found = language_id.predict(frame, language_id.learn(frame)).collect()
    assert {r["lang_pred"] for r in found} == {"xx"} and all(r["score"] == pytest.approx(0.5) for r in found)


def test_equally_long_rules_go_by_their_order(spark):
    rules = [("block", "a.com", "/x"), ("allow", "a.com", "/x")]
    frame = spark.createDataFrame([(1, "http://a.com/x/y"), (2, None), (3, "http://a.com" + "/deep" * 20_000)], "page_id long, url string")
    found = {r["page_id"]: r for r in url_filter.judge(frame, rules=rules).collect()}
    assert found[1]["verdict"] == "block" and found[2]["host"] == "" and len(found[3]["path"]) == 100_000
    assert url_filter.judge(frame.where("page_id > 9")).count() == 0


def test_long_and_empty_texts_of_the_benchmark_search(spark):
    rng = random.Random(8)
    passage = " ".join(f"w{rng.randrange(500)}" for _ in range(40))
    filler = " ".join(f"v{rng.randrange(900)}" for _ in range(120_000))
    docs = spark.createDataFrame(
        [(1, filler + " " + passage, "x"), (2, "", "x"), (3, None, "x"), (4, passage, "x")], "doc_id long, text string, n_hit string"
    )
    items = spark.createDataFrame([("q1", passage), ("q2", None), ("q3", "")], "item_id string, text string")
    found = {r["doc_id"]: r for r in decontamination.contamination(docs, items).collect()}
    assert (found[1]["n_hit"], found[1]["n_items"], found[1]["contaminated"]) == (40, 1, False)
    assert found[4]["contaminated"] and (found[2]["n_words"], found[3]["n_words"]) == (0, 0)
    assert decontamination.contamination(docs.where("doc_id > 9"), items).count() == 0
    assert {r["n_hit"] for r in decontamination.contamination(docs, items.where("item_id = 'none'")).collect()} == {0}


def test_equal_coefficients_of_licenses_go_by_name(spark):
    templates = {"bbb": "permission to use this thing is given", "aaa": "permission to use this thing is given"}
    frame = spark.createDataFrame([(1, "permission to use this thing is given"), (2, None)], "doc_id long, text string")
    found = {r["doc_id"]: r for r in license_scan.scan(frame, templates=templates).collect()}
    assert found[1]["license"] in ("aaa", "bbb") and found[2]["license"] is None
    again = {r["doc_id"]: r["license"] for r in license_scan.scan(frame, templates=dict(sorted(templates.items()))).collect()}
    assert {again[1], found[1]["license"]} == {found[1]["license"]}
    assert license_scan.scan(frame.where("doc_id > 9"), templates=templates).count() == 0
