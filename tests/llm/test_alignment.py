"""Pointer jumping against plain interval arithmetic on the libraries' own encodings of whole texts."""

import hashlib
import random
from collections import Counter, defaultdict

import numpy as np
import pytest
from llm_cases import SCHEMA

from citylake.llm import alignment as A
from citylake.llm.bpe import byte_alphabet


@pytest.fixture(scope="module")
def libraries():
    import sentencepiece
    from tokenizers import Tokenizer

    a_path, b_path = A.tokenizer_paths()
    a = Tokenizer.from_file(a_path)
    a.encode_special_tokens = True
    b = sentencepiece.SentencePieceProcessor(model_file=b_path)
    alphabet = byte_alphabet()
    tokens = {k: t for t, k in a.get_vocab().items()}

    def both(text):
        if not text:
            return None
        ia, ib = a.encode(" " + text, add_special_tokens=False).ids, b.encode(text)
        ba = [bytes(alphabet[c] for c in tokens[k]) for k in ia]
        pieces = [b.id_to_piece(k) for k in ib]
        bb = [bytes([int(p[3:5], 16)]) if b.is_byte(k) else p.replace("▁", " ").encode() for k, p in zip(ib, pieces)]
        want = (" " + text).encode()
        return (list(zip(ia, ba)), list(zip(ib, bb))) if b"".join(ba) == want == b"".join(bb) else None

    return both


def cut(found):
    """[(A ids, B ids)] of each group, by walking both sides."""
    out, group, ends, at = [], ([], []), [0, 0], [0, 0]
    while at[0] < len(found[0]) or at[1] < len(found[1]):
        side = 0 if ends[0] <= ends[1] and at[0] < len(found[0]) else 1
        k, raw = found[side][at[side]]
        group[side].append(k)
        ends[side] += len(raw)
        at[side] += 1
        if ends[0] == ends[1]:
            out.append(group)
            group = ([], [])
    return out


def brute(rows, both):
    """Counter of result rows."""
    done = [(d, both(t)) for d, t in rows]
    done = [(d, f, cut(f) if f else []) for d, f in done]
    counts = Counter((g[0][-1], g[1][-1]) for _, _, gs in done for g in gs)
    best = defaultdict(int)
    for (_, b), n in counts.items():
        best[b] = max(best[b], n)
    out = Counter()
    for d, f, gs in done:
        links = [(g[0][-1], g[1][-1]) for g in gs]
        form = ";".join(",".join(map(str, a)) + "|" + ",".join(map(str, b)) for a, b in gs)
        digest = hashlib.sha256(form.encode()).hexdigest() if f else ""
        n_a, n_b = (len(f[0]), len(f[1])) if f else (0, 0)
        n_best = sum(counts[x] == best[x[1]] for x in links)
        out[(d, n_a, n_b, len(gs), len(gs), n_best, sum(counts[x] for x in links), digest)] += 1
    return out


def aligned(docs, **options):
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]
    return Counter(tuple(r[c] for c in names) for r in A.align(docs, **options).collect())


HOSTILE = [
    " leading", "trailing ", "  two  spaces  ", "a\tb\t c\r\nd\x0b\x0ce\r", "\n", "\n\nx\n \ny", " ", "   ", "\t", "x\r \ry",
    "<|endoftext|> and <s> </s> <unk> <0x0A>", "▁ is a piece", "x▁y", "\xa0no\xa0break \xa0 x", "‍ 　wide　 ", "é ́x",
    "漢字かな交じり文、句読点。", "русский текст", "عربى نص", "👩‍👩‍👧 🏳️‍🌈!", "\x00nul\x00 \x01", "don't I'll we've 'S", "3.14159 1,000,000 0x1F",
    "x" * 3000, "ab " * 900, "퟿�", "naïve façade — “quotes” …", "a" + "̀" * 50, "tab\t\t\t\tend", "line\n" * 20, "//////\\\\\\\\", "    def f(x):\n        return x\n",
]


def test_equal_to_the_libraries(spark, libraries):
    rng = random.Random(2)
    alphabet = list("abcdeth .,'\n\t\r 12é漢▁\x1c\xa0👩<|>")
    texts = HOSTILE + ["".join(rng.choices(alphabet, k=rng.randint(1, 40))) for _ in range(1500)]
    rows = [(k, t, "en", "s", 1, *["z"] * 9) for k, t in enumerate(texts)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(3)
    want = brute([(r[0], r[1]) for r in rows], libraries)
    assert aligned(docs) == want
    assert aligned(docs, frequent=40) == want  # most pairs through the join
    assert aligned(docs, frequent=0) == want


def test_edge_rows(spark, edge, empty, libraries):
    rows = [(r["doc_id"], r["text"]) for r in edge.collect()]
    got = aligned(edge)
    assert got == brute(rows, libraries)
    assert aligned(empty) == Counter()
    assert sum(got.values()) == len(rows)


def test_groups_of_the_general_interface(spark, edge, libraries):
    got = defaultdict(list)
    for r in A.groups(edge.where("doc_id IN (10, 11, 25)")).orderBy("place").collect():
        got[r["doc_id"]].append((r["a_ids"], r["b_ids"]))
    rows = {r["doc_id"]: r["text"] for r in edge.where("doc_id IN (10, 11, 25)").collect()}
    for d, t in rows.items():
        found = libraries(t)
        assert got[d] == (cut(found) if found else [])


def test_terminals_of_long_chains():
    """A chain of tokens that overlap one after another is one component, found by doubling."""
    n = 10_000
    a, b = np.arange(1, n + 1) * 2, np.r_[np.arange(0, n - 1) * 2 + 1, 2 * n]
    assert set(A.terminals(a, b).tolist()) == {2 * n - 1}
    same = np.arange(1, 51)
    assert A.terminals(same, same).tolist() == [*range(50, 100)] * 2


def test_counts_are_added_in_pieces(spark, edge, monkeypatch):
    want = aligned(edge)
    monkeypatch.setattr(A, "HELD", 16)
    assert aligned(edge) == want


def test_new_words_are_encoded_together(libraries):
    rng = random.Random(5)
    odd = ["Ａ", "ﬁn", "é", "​", "<|endoftext|>", "<unk>", "▁", "x▁y", "\x00", "don't", "🙂🙂", "  two", "\t", "a\n", "\r\n", "﻿", "日本語"]
    texts = [" ".join("".join(rng.choices("abcdeéß1.,'", k=rng.randint(1, 9))) for _ in range(300)) for _ in range(4)]
    texts += [rng.choice(["", " ", "\n", " \n "]).join(rng.choices(odd, k=30)) for _ in range(40)] + [" ", "\n", "a ", " a  b \n\n c"]
    p = A.Pair(*A.tokenizer_paths())
    single, whole = [], p._word
    p.words.compute = lambda u: single.append(u) or whole(u)
    for text, row in zip(texts, p.aligned(texts)):
        want = libraries(text)
        assert row[:2] == ((len(want[0]), len(want[1])) if want else (0, 0)), text
        if want:
            a, b = p.tokens(text)
            assert np.frombuffer(a, p.kind).tolist() == [k for k, _ in want[0]], text
            assert np.frombuffer(b, p.kind).tolist() == [k for k, _ in want[1]], text
    plain = A.Pair(*A.tokenizer_paths())
    single.clear()
    plain.words.compute = lambda u: single.append(u) or whole(u)
    list(plain.aligned(texts[:4]))
    assert not single  # about 1,000 words, no call for each
