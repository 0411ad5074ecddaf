"""Hard negatives against scoring every anchor with every row."""

import math
import random

import pytest
from pyspark.sql import functions as F

from citylake.llm import negatives as N

SCHEMA = "vec_id long, embedding array<float>, label int, score long, row string, `group` string"


def usable(rows):
    out = []
    for v, x, y in rows:
        if y is None or x is None or any(c is None or not math.isfinite(c) for c in x):
            continue
        label = (y + 1) % 10 if v is not None and v % 7 == 0 else y
        out.append((v, label, [math.floor(256 * c) for c in x]))
    return out


def brute(rows):
    """Sorted (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    rows = usable(rows)
    first = lambda x: (-x[0], x[1] is None, x[1] or 0)
    out = []
    for i, (v, label, x) in enumerate(rows):
        if v is None or v % 50:
            continue
        scored = [(sum(a * b for a, b in zip(x, y)), w, m == label) for j, (w, m, y) in enumerate(rows) if j != i]
        for p, w, _ in sorted((s for s in scored if s[2]), key=first)[: N.POSITIVES]:
            fits = sorted((s for s in scored if not s[2] and 50 * p <= 100 * s[0] <= 95 * p), key=first)
            out += [(v, w, k, u, p, s) for k, (s, u, _) in enumerate(fits[: N.NEGATIVES], 1)]
    return sorted(out, key=lambda r: tuple((c is None, c or 0) for c in r))


def mined(spark, rows, tmp_path):
    spark.createDataFrame([(*r, 1, "x", "y") for r in rows], SCHEMA).repartition(3).write.parquet(f"{tmp_path}/embeddings.parquet")
    got = N.op11_l2ap_negatives(spark, str(tmp_path)).collect()
    return sorted(map(tuple, got), key=lambda r: tuple((c is None, c or 0) for c in r))


def vectors(n, dims, seed, spread=1.0):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, spread) for _ in range(dims)] for _ in range(6)]
    rows = []
    for k in range(n):
        x = [rng.gauss(0, 1) + c for c in rng.choice(centres)]
        norm = math.sqrt(sum(c * c for c in x))
        rows.append((k, [float(f"{c / norm:.4f}") for c in x], rng.randrange(10)))
    return rows


@pytest.mark.parametrize("expected,lower,group,block", [(24, 16, 32768, 8192), (1, 2, 50, 3)])
def test_equal_to_brute_force(spark, tmp_path, monkeypatch, expected, lower, group, block):
    """Also with thresholds that miss at first, many groups, and several blocks of anchors."""
    for name, value in (("EXPECTED", expected), ("LOWER", lower), ("GROUP", group), ("BLOCK", block)):
        monkeypatch.setattr(N, name, value)
    rows = vectors(700, 19, 3)
    assert mined(spark, rows, tmp_path) == brute(rows)


def test_edge_rows(spark, tmp_path):
    """Nulls, values that are not finite, short and empty vectors, ties, repeated rows and a label of one row."""
    rows = vectors(120, 9, 5)
    rows += [(50, rows[3][1], 1), (50, rows[3][1], 1), (150, rows[4][1], None), (200, None, 2), (250, [0.5, None], 2)]
    rows += [(300, [float("nan")] * 9, 1), (350, [float("inf")] + [0.1] * 8, 1), (400, [], 3), (450, [0.9, 0.1], 3)]
    rows += [(None, rows[0][1], rows[0][2]), (None, rows[1][1], rows[1][2]), (500, rows[0][1], 77), (550, [0.0] * 9, 4)]
    rows += [(1000 + k, rows[0][1], k % 2) for k in range(40)]
    assert mined(spark, rows, tmp_path) == brute(rows)


def test_empty_table(spark, tmp_path):
    assert mined(spark, [], tmp_path) == []
    assert N.op11_l2ap_negatives(spark, str(tmp_path)).columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]


def test_large_components_are_bounded(spark):
    bound = N._bound(2)
    rows = [(0, [2**50, 1], 0), (1, [2**50, 2], 0), (2, [bound, 0], 1), (3, [bound * 3 // 4, 0], 1)]
    table = spark.createDataFrame(rows, "k long, v array<long>, y int")
    got = N.mine(table, F.col("k"), F.col("y"), F.col("v"), F.col("k") == 0).collect()
    assert [(r["positive_score"], r["negative_id"], r["negative_score"]) for r in got] == [(bound**2 + 2, 3, bound * (bound * 3 // 4))]


def test_index_keeps_every_pair_that_can_reach():
    """Postings left out, partial sums and pruning never lose a pair at its threshold."""
    import numpy as np

    rng = np.random.default_rng(4)
    x = rng.integers(-90, 90, (400, 37)) // (1 + np.arange(37) // 4)
    q = rng.integers(-90, 90, (20, 37)) // (1 + np.arange(37) // 4)
    scores = q @ x.T
    at = np.sort(scores, axis=1)[:, -5].astype(float)
    index = N.Index(x, float((at / np.sqrt((q.astype(float) ** 2).sum(axis=1))).min()))
    assert min(index.stages) < len(index.cuts) - 1  # some dimensions have no postings
    a, r, s = index.reaching(q, at)
    assert set(zip(a.tolist(), r.tolist(), s.tolist())) == {(i, j, scores[i, j]) for i, j in zip(*np.nonzero(scores >= at[:, None]))}
