import math
import zlib
from collections import Counter

import numpy as np
import xxhash
from llm_cases import plain

from citylake.llm import common
from citylake.llm import language_model as L


def held(d):
    return zlib.crc32(b"" if d is None else str(d).encode()) % 10 == 0


def tokens(t):
    return (t or "").encode().lower().split() + [b"\n"]


def brute(rows):
    c = Counter(w for d, t in rows if not held(d) for w in tokens(t))
    n, v = sum(c.values()), len(c)
    return [
        (d, held(d), len(ws), sum(w in c for w in ws), n, sum(math.log10((c[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws))
        for d, t in rows
        for ws in [tokens(t)]
    ]


def same(have, want):
    key = lambda r: (str(r[0]), r[2], round(r[5], 6))
    have, want = sorted(have, key=key), sorted(want, key=key)
    assert [h[:5] for h in have] == [w[:5] for w in want]
    assert np.allclose([h[5] for h in have], [w[5] for w in want])


def test_edge_rows_match_brute_force(edge):
    rows = L.score(edge).collect()
    same([tuple(r)[:6] for r in rows], brute(plain(edge)))
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)


def test_small_slices_give_the_same(edge, monkeypatch):
    monkeypatch.setattr(L, "SLICE_KEYS", 40)
    same([tuple(r)[:6] for r in L.score(edge).collect()], brute(plain(edge)))


def test_empty_table_and_no_training_rows(spark, empty):
    assert L.score(empty).collect() == []
    out = next(d for d in range(100) if held(d))
    row = L.score(spark.createDataFrame([(out, "a b")], "doc_id long, text string")).first()
    assert (row.held_out, row.n_tokens, row.n_known, row.train_tokens) == (True, 3, 0, 0)


def test_exchange_never_lowers_the_likelihood_and_finds_classes():
    rng = np.random.default_rng(0)
    units = 41
    kind = np.array([0] + [1 + k % 2 for k in range(40)])
    n = np.zeros((units, units))
    for _ in range(20_000):
        a = rng.integers(1, units)
        b = rng.choice(np.flatnonzero(kind == 3 - kind[a]))
        n[a, b] += 1
    label = L.exchange(n, classes=3)
    assert label[0] == 0
    assert all(len({label[k] for k in range(1, units) if kind[k] == c}) == 1 for c in (1, 2))


def test_model_beats_the_base_on_held_out_texts(spark):
    rng = np.random.default_rng(3)
    nouns, verbs = [f"n{k}" for k in range(60)], [f"v{k}" for k in range(60)]
    rows = [(d, " ".join(f"{rng.choice(nouns)} {rng.choice(verbs)}" for _ in range(40))) for d in range(300)]
    out = L.score(spark.createDataFrame(rows, "doc_id long, text string")).where("held_out").collect()
    assert sum(r.score for r in out) > 0.9 * sum(r.base_score for r in out)


def model(rows):
    """The class model in plain loops: core classes, one exchange of every word, smoothed class bigrams."""
    train = [tokens(t) for d, t in rows if not held(d)]
    c = Counter(w for ws in train for w in ws)
    n, kinds = sum(c.values()), len(c)
    classes = max(L.CLASSES, math.ceil(kinds**0.25))
    digest = lambda w: int(common.mix(np.array([xxhash.xxh3_64_intdigest(w)], np.uint64))[0])
    signed = lambda w: digest(w) - (1 << 64) * (digest(w) >> 63)
    ranked = sorted((w for w in c if w != b"\n"), key=lambda w: (-c[w], signed(w)))[: L.HEADS * classes]
    unit = {w: 1 + k for k, w in enumerate(ranked)} | {b"\n": 0}
    of = lambda w: unit.get(w, 1 + L.HEADS * classes + xxhash.xxh3_64_intdigest(w[-2:]) % L.TAILS)
    pairs = Counter(p for ws in train for p in zip([b"\n", *ws], ws))
    core = np.zeros((1 + L.HEADS * classes + L.TAILS,) * 2)
    for (a, b), k in pairs.items():
        core[of(a), of(b)] += k
    start = L.exchange(core, classes)
    first = lambda w: int(start[of(w)])

    def table(group):
        out = np.zeros((classes, classes))
        for (a, b), k in pairs.items():
            out[group(a), group(b)] += k
        return out

    before = table(first)
    f = lambda x: x * math.log(x) if x > 0 else 0.0
    moves = {}
    for w in c:
        if w == b"\n":
            continue
        left, right = Counter(), Counter()
        for (a, b), k in pairs.items():
            if b == w:
                left[first(a)] += k
            if a == w:
                right[first(b)] += k
        gains = {}
        for g in range(1, classes):
            less = lambda k: k if g == first(w) else 0  # noqa: E731, B023
            gain = sum(f(before[x, g] - less(k) + k) - f(before[x, g] - less(k)) for x, k in left.items())
            gain += sum(f(before[g, x] - less(k) + k) - f(before[g, x] - less(k)) for x, k in right.items())
            for margin in (before[g].sum(), before[:, g].sum()):
                gain -= f(margin - less(c[w]) + c[w]) - f(margin - less(c[w]))
            gains[g] = gain
        best = max(gains, key=gains.get)
        moves[w] = best if gains[best] > gains[first(w)] + 1e-9 else first(w)
    group = lambda w: moves.get(w, first(w))
    follow = table(group)
    size, many = Counter(), Counter()
    for w, k in c.items():
        size[group(w)] += k
        many[group(w)] += 1
    share = (follow.sum(axis=0) + L.ALPHA) / (follow.sum() + L.ALPHA * classes)
    step = lambda a, b: (follow[a, b] + share[b]) / (follow[a].sum() + 1)
    emit = lambda w: (c[w] + L.ALPHA) / (size[group(w)] + L.ALPHA * (many[group(w)] + 1))
    chance = lambda a, w: step(group(a), group(w)) * emit(w)
    return [sum(math.log10(chance(a, w)) for a, w in zip([b"\n", *ws], ws)) for _, t in rows for ws in [tokens(t)]], step, emit, group, c, classes


def sample(n, seed=5):
    rng = np.random.default_rng(seed)
    words = [f"w{k}" for k in range(400)]
    chance = 1 / np.arange(1, 401)
    chance /= chance.sum()
    return [(d, " ".join(rng.choice(words, 40, p=chance)) + " \u00e9t\u00e9") for d in range(n)]


def test_score_matches_brute_force(spark):
    rows = sample(60) + [(3, None), (None, "w1 unseen"), (61, ""), (3, "w1 w1 w2")]
    have = sorted(r.score for r in L.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)).collect())
    assert np.allclose(have, sorted(model(rows)[0]))


def test_score_of_many_blocks_matches_brute_force(spark, monkeypatch):
    """Small blocks, slices and steps: words meet their counts from many tasks, and classes move."""
    monkeypatch.setattr(L, "SLICE_KEYS", 50)
    monkeypatch.setattr(L, "HEADS", 1)  # most words begin in the class of their ending
    rows = sample(120, 8)
    want, *_ = model(rows)
    have = sorted(r.score for r in L.score(spark.createDataFrame(rows, "doc_id long, text string").repartition(8)).collect())
    assert np.allclose(have, sorted(want))


def test_steps_of_gains_give_the_same(monkeypatch):
    rng = np.random.default_rng(1)
    classes, words = 6, 50
    cells = np.unique(rng.integers(0, words * 2 * classes, 300))
    word, context, n = cells // (2 * classes), cells % (2 * classes), rng.integers(1, 9, len(cells))
    total = np.bincount(word, n * (context < classes), words).astype(np.int64)
    label = rng.integers(0, classes, words)
    follow = rng.integers(500, 900, (classes, classes)).astype(float)
    want = L.moved(word, context, n, total, label, follow)
    monkeypatch.setattr(L, "STEP", 7)
    assert (L.moved(word, context, n, total, label, follow) == want).all()
    assert (want[label == 0] == 0).all() and (want != label).any()


def test_probabilities_add_up_to_one():
    """Over all words that can follow and one unknown per class, the chances after any class are one."""
    rows = sample(40)
    _, step, emit, group, c, classes = model(rows)
    size, many = Counter(), Counter()
    for w, k in c.items():
        size[group(w)] += k
        many[group(w)] += 1
    unknown = [L.ALPHA / (size[g] + L.ALPHA * (many[g] + 1)) for g in range(classes)]
    for a in range(classes):
        known = sum(step(a, group(w)) * emit(w) for w in c)
        assert math.isclose(known + sum(step(a, g) * unknown[g] for g in range(classes)), 1)


def test_one_worker_packs_and_numbers(edge):
    numbered = common.texts_of(edge).mapInArrow(L._number, L.TOKEN_SCHEMA)
    assert numbered._jdf.queryExecution().executedPlan().toString().count("MapInArrow") == 1
    assert sum(len(r.lengths) // 8 for r in numbered.collect()) == edge.count()
