"""Tree concatenation against the tokenizer itself on whole texts."""

from __future__ import annotations

import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from gramledger.llm import bpe_codec, queries

SPEC = open(queries.word_tokenizer_path(), encoding="utf-8").read()
SMALL = bpe_codec.Codec(SPEC, leaf=4, window=2)
WHOLE = SMALL.tokenizer
#: Spaces, contractions, marks that melt, letters that grow when lowered, numbers, signs, other scripts, specials.
PARTS = [
    *"abestlrvmd'ABSRE 01.!?-<|>", "  ", "\n", "\x1c", "\x85", "\u3000", "\u2003", "'re", "'ll", "'ve", "'s", "''",
    "\xe9", "e\u0301", "\u0301", "\u0323", "\u0130", "\u03a3", "\xdf", "\u1e9b\u0323", "\uac00", "\u1100", "\u1161",
    "\u11a8", "\u65e5\u672c\u8a9e", "\ud55c\uad6d", "\u0928\u092e\u0938\u094d\u0924\u0947", "\U0001f602",
    "\U0001f602" * 4, "\u212b", "\xbc", "\xb2", "<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "</w>",
    "international", "inter", "national", "hahahahahaha", "!!!!!!!!", "\u0345", "\u01c6", "\ufb01", "\u200d", "\ufeff",
    "\x00", "\u05d0\u05bc", "\u0958", "\u1e69", "s\u0307\u0323",
]


def expected(text: str) -> list[int]:
    return WHOLE.encode(text, add_special_tokens=False).ids


def check(codec: bpe_codec.Codec, text: str) -> None:
    ids = codec.encode(text)
    assert ids.tolist() == expected(text), repr(text)
    assert codec.decode(ids) == WHOLE.decode(ids.tolist(), skip_special_tokens=False)


@settings(max_examples=1500, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=24).map("".join))
def test_equals_the_tokenizer(text):
    check(SMALL, text)


@settings(max_examples=400, deadline=None)
@given(st.text(max_size=30))
def test_equals_the_tokenizer_on_any_text(text):
    check(SMALL, text)


@settings(max_examples=300, deadline=None)
@given(st.integers(0, 10**9), st.sampled_from(["ab", "ha", "aei", "etaoinshr", "\u65e5\u672c\u8a9e", "!?", "\U0001f602\u2764", "!'-", "ab'"]))
def test_unsplit_runs(seed, letters):
    rng = random.Random(seed)
    text = "".join(rng.choice(letters) for _ in range(rng.randrange(200, 900)))
    for leaf in (16, 100):
        check(bpe_codec_of(leaf), text)
        check(bpe_codec_of(leaf), "so " + text + " it's")


_made: dict[int, bpe_codec.Codec] = {}


def bpe_codec_of(leaf: int) -> bpe_codec.Codec:
    if leaf not in _made:
        _made[leaf] = bpe_codec.Codec(SPEC, leaf=leaf)
    return _made[leaf]


def test_windows_stay_small_in_a_long_run(monkeypatch):
    rng = random.Random(1)
    text = "".join(rng.choice("etaoinshrdlu") for _ in range(200_000))
    codec = bpe_codec_of(bpe_codec.LEAF)
    tried = []
    run = codec._run
    monkeypatch.setattr(codec, "_run", lambda left, right, size: tried.append(size) or run(left, right, size))
    check(codec, text)
    assert tried and max(tried) <= 64


@pytest.mark.parametrize("part", [40, bpe_codec.PART])
def test_rows(spark, part):
    rng = random.Random(4)
    rows = [(i, "".join(rng.choice(PARTS) for _ in range(rng.randrange(60))), "x") for i in range(80)]
    rows += [(100, None, "x"), (101, "", "x"), (None, "no id, it's", None), (3, "again 3", "x"), rows[5], rows[5]]
    rows += [(102, "ab" * 60_000, "x"), (103, "he's on, they're in. " * 8_000, "x"), (104, "\u0301" * 300, "x")]
    frame = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(4)
    found = bpe_codec.encode(
        frame, queries.word_tokenizer_path(), carry=("doc_id", "ids"), names=("token_ids", "back"), leaf=30, part=part
    )
    assert found.columns == ["doc_id", "ids", "token_ids", "back"]
    wanted = [(i, s, expected(t or "")) for i, t, s in rows]
    wanted = sorted(((*r, WHOLE.decode(r[2], skip_special_tokens=False)) for r in wanted), key=str)
    assert sorted(map(tuple, found.collect()), key=str) == wanted
    assert bpe_codec.encode(frame.limit(0), queries.word_tokenizer_path()).count() == 0


def test_query_digests(spark, tmp_path):
    import hashlib

    rows = [(1, "It's <|endoftext|> the end"), (2, None), (3, "x" * 70_000)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    found = {r["doc_id"]: r for r in queries.op11_bpe(spark, str(tmp_path)).collect()}
    for doc_id, text in rows:
        ids = expected(text or "")
        assert found[doc_id]["n_tokens"] == len(ids)
        assert found[doc_id]["ids_sha256"] == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        back = WHOLE.decode(ids, skip_special_tokens=False)
        assert found[doc_id]["decoded_sha256"] == hashlib.sha256(back.encode()).hexdigest()
    assert np.isclose(found[2]["n_tokens"], 0)
