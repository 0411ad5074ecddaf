import random

import numpy as np
import pytest
from llm_cases import sentence

from citylake.llm import toxicity as T


def enumerate_marginals(odds, transition):
    """Marginals of a chain by adding up all tag sequences."""
    t = np.array(transition).reshape(2, 2)
    n, out, total = len(odds), np.zeros(len(odds)), 0.0
    for tags in np.ndindex(*[2] * n):
        w = np.prod([odds[k] if y else 1.0 for k, y in enumerate(tags)]) * np.prod([t[a, b] for a, b in zip(tags, tags[1:])])
        total += w
        out += w * np.array(tags)
    return out / total


def test_forward_backward_equals_enumeration():
    rng = np.random.default_rng(1)
    lengths = np.array([3, 0, 7, 1, 5])
    starts = np.cumsum(lengths) - lengths
    odds, transition = rng.gamma(1.0, 1.0, lengths.sum()), (0.9, 0.2, 0.3, 0.7)
    have, pairs = T.forward_backward(odds, starts, lengths, transition)
    want = np.concatenate([enumerate_marginals(odds[a : a + n], transition) for a, n in zip(starts, lengths) if n])
    assert np.allclose(have, want)
    assert np.isclose(pairs.sum(), (lengths[lengths > 0] - 1).sum())


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(8)
    rows, labels = [], []
    for k in range(700):
        words = sentence(rng, rng.randint(5, 60)).split()
        toxic = int(k % 7 == 0)
        for _ in range(rng.randint(1, 4) * toxic):
            words.insert(rng.randrange(len(words)), rng.choice(["vileword", "NASTY!", "grubbon" + rng.choice(["a", "es", "ito"])]))
        rows.append((k, " ".join(words), "x"))
        if k % 3:
            labels.append((k, 1, toxic))
    rows += [(1000, None, "x"), (1001, "", "x"), (None, "fine words only", "x"), (1002, "vileword " * 3, "x"), (1002, "vileword " * 3, "x"), (1003, "ok " * 40_000, "x")]
    labels += [(1, 1, None), (2, 1, 0), (2, 1, 0), (None, 1, 1), (99_999, 0, 1)]
    return (
        spark.createDataFrame(rows, "doc_id long, text string, score string"),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    )


def test_held_out_accuracy_spans_and_edge_rows(corpus):
    docs, labels = corpus
    model = T.fit(docs, labels)
    rows = T.score(docs, model).withColumn("held_out", T.held_out("doc_id")).collect()
    assert len(rows) == docs.count()
    assert all(0 <= r.score <= 1 for r in rows)
    fresh = [r for r in rows if r.doc_id is not None and r.doc_id < 700 and r.held_out]
    right = sum((r.score >= T.THRESHOLD) == (r.doc_id % 7 == 0) for r in fresh)
    assert len(fresh) > 100 and right / len(fresh) > 0.97
    by = {r.doc_id: r for r in rows}
    assert by[1002].score >= T.THRESHOLD > max(by[1000].score, by[1001].score, by[1003].score, by[None].score)
    text = {r.doc_id: r.text for r in docs.collect()}
    marked = {text[r.doc_id][s.start : s.end].lower() for r in rows for s in r.spans if r.doc_id is not None}
    assert "vileword" in marked and all(w.startswith(("vileword", "nasty", "grubbon")) for m in marked for w in m.replace("!", " ").split())


def test_copies_of_one_document_teach_nothing(spark):
    rng = random.Random(4)
    rows = [(k, sentence(rng, 40)) for k in range(300)]
    copied = sentence(rng, 40) + " onlyhere twicehere"
    rows += [(k, copied) for k in range(300, 340)]
    labels = [(k, int(k >= 300)) for k in range(340)]
    model = T.fit(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))
    assert b"wonlyhere" not in model.weights


def test_reject_keeps_columns(corpus):
    docs, labels = corpus
    model = T.fit(docs, labels)
    kept = T.reject(docs, model)
    assert kept.schema == docs.schema
    ids = [r.doc_id for r in kept.collect()]
    assert 1002 not in ids and {1000, 1001, 1003, None}.issubset(ids)


def test_no_labels_of_both_kinds_and_empty_table(spark, empty):
    labels = spark.createDataFrame([(1, 0)], "doc_id long, toxic int")
    model = T.fit(empty, labels)
    assert T.score(empty, model).collect() == []
    one = spark.createDataFrame([(1, "any text")], "doc_id long, text string")
    assert T.score(one, model).first().score < 1e-6
    assert T.score(one, T.fit(one, labels.limit(0))).first().score < 1e-6


def test_labels_without_documents_take_no_place_in_the_sample(corpus, spark):
    docs, labels = corpus
    absent = spark.range(200_000, 203_000).selectExpr("id AS doc_id", "1 AS quality", "cast(id % 2 as int) AS toxic")
    assert T.fit(docs, labels.union(absent), sample_docs=300) == T.fit(docs, labels, sample_docs=300)


def test_the_chain_is_bounded_in_documents_and_words(corpus):
    docs, labels = corpus
    model = T.fit(docs, labels, crf_docs=60, crf_words=1_500)
    rows = T.score(docs, model).where("doc_id < 700").collect()
    assert sum((r.score >= T.THRESHOLD) == (r.doc_id % 7 == 0) for r in rows) / len(rows) > 0.95
    assert T.score(docs, T.fit(docs, labels, crf_words=1)).count() == docs.count()


def test_fit_reaches_a_gradient_of_zero_by_enumeration():
    """The chain's expected tags and transitions, added up over all tag sequences, meet the given tags after many rounds."""
    rows = [{"n_words": n, "places": p, "marks": [[0]] * len(p)} for n, p in ((5, [1, 2]), (4, []), (3, [0]), (4, [2]))]
    y = np.array([1, 0, 1, 0])
    before, T.ROUNDS = T.ROUNDS, 3000
    try:
        model = T._train(T._Chain(rows), y, np.ones(4), [b"wx"])
    finally:
        T.ROUNDS = before
    odds = [np.exp([model.bias + model.weights[b"wx"] * (k in r["places"]) for k in range(r["n_words"])]) for r in rows]
    marginals = [enumerate_marginals(o, model.transition) for o in odds]
    seen = sum(m[r["places"]].sum() for m, r in zip(marginals, rows))
    # Three marked words of toxic documents are toxic, the marked word of the clean one is not; 0.01 x is the penalty.
    assert abs(3 - seen - 0.01 * model.weights[b"wx"]) < 0.02
