import hashlib
import random

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citylake.llm import bpe
from llm_cases import plain


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(bpe.tokenizer_path())


PARTS = ["a", "the", "ing", " ", "  ", "\n", "'s", "'re", "'", "é", "1", "23", "!!", "<|endoftext|>", "<|endof", "日本", "👩‍👩", "\t", " ", "\x1c", "\r\n", "'ve "]


@settings(max_examples=150, deadline=None)
@given(st.lists(st.sampled_from(PARTS), max_size=40), st.sampled_from([1, 2, 3, 7, 16]))
def test_any_leaf_size_equals_the_library(parts, leaf):
    codec = bpe.codec(bpe.tokenizer_path())
    text = "".join(parts)
    ids = codec.encode(text, leaf=leaf)
    want = codec.tokenizer.encode(text, add_special_tokens=False).ids
    assert ids.tolist() == want
    assert codec.decode(ids) == codec.tokenizer.decode(want, skip_special_tokens=False)


def test_unsplit_runs_are_joined_by_growing_windows(codec, monkeypatch):
    monkeypatch.setattr(bpe, "REACH", 8)
    whole = []
    original = codec.many
    monkeypatch.setattr(codec, "many", lambda texts: whole.extend(map(len, texts)) or original(texts))
    rng = random.Random(2)
    for _ in range(60):
        run = "".join(rng.choice(["th", "er", "in", "on", "a", "ñ", "ess", "z", "q"]) for _ in range(1500))
        leaves = [run[k : k + 128] for k in range(0, len(run), 128)]
        assert np.array_equal(codec.tree(leaves), codec.plain(run))
    assert sorted(whole)[len(whole) // 2] <= 128  # most joins end long before the whole run


def test_decoder_replaces_invalid_bytes_like_the_library(codec):
    rng = random.Random(4)
    for _ in range(200):
        ids = np.array([rng.randrange(50257) for _ in range(20)], np.uint32)
        assert codec.decode(ids) == codec.tokenizer.decode(ids.tolist(), skip_special_tokens=False)


def test_edge_rows_and_round_trip(edge, codec):
    out = sorted(map(repr, bpe.encoded_with_digests(edge, bpe.tokenizer_path()).select("doc_id", "n_tokens", "ids_sha256", "decoded_sha256").collect()))
    want = []
    for d, t in plain(edge):
        ids = codec.tokenizer.encode(t or "", add_special_tokens=False).ids
        text = codec.tokenizer.decode(ids, skip_special_tokens=False)
        assert text == (t or "")
        from pyspark.sql import Row

        want.append(repr(Row(doc_id=d, n_tokens=len(ids), ids_sha256=hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest(), decoded_sha256=hashlib.sha256(text.encode()).hexdigest())))
    assert out == sorted(want)
    trip = {(r["doc_id"], r["decoded"]) for r in bpe.round_trip(edge, bpe.tokenizer_path()).collect()}
    assert trip == {(d, t or "") for d, t in plain(edge)}


def test_empty_table(empty):
    assert bpe.encode(empty, bpe.tokenizer_path()).collect() == []
