"""Pareto mix: targets, whole copies, and the cut in rank order, against a plain sort."""

from collections import Counter, defaultdict

import pytest
from llm_cases import SCHEMA, sentence
from pyspark.sql import functions as F

from citylake.llm import mixing as M


def targets(sizes):
    """Targets by source: shares by weight, stopped at CAP times the size, shared again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: M.WEIGHTS[k % len(M.WEIGHTS)] for k, s in enumerate(names)}
    total, stopped = sum(sizes.values()), set()
    while True:
        free = [s for s in names if s not in stopped]
        left = total - sum(M.CAP * sizes[s] for s in stopped)
        share = {s: left * weight[s] / sum(weight[x] for x in free) for s in free}
        over = {s for s in free if share[s] > M.CAP * sizes[s]}
        if not over:
            return {s: share.get(s, float(M.CAP * sizes[s])) for s in names}
        stopped |= over


def mixed(docs, **options):
    return M.mix(docs, **options).collect()


def words(text):
    return len((text or "").encode().split())


def brute_taken(spark, docs, preference=None):
    """(doc_id, size, taken) by sorting each source's documents whole."""
    sized = [r.asDict() for r in M._sized(docs, preference).collect()]
    by = defaultdict(list)
    for r in sized:
        by[None if r["unnamed"] else r["name"]].append(r)
    goal = targets({s: sum(r["size"] for r in rows) for s, rows in by.items()})
    out = []
    for s, rows in by.items():
        wish, level, stopped = {r["row"]: r["preference"] for r in rows}, 0.0, set()
        while True:
            free = sum(wish[r["row"]] * r["size"] for r in rows if r["row"] not in stopped)
            level = max(level, (goal[s] - sum(M.CAP * r["size"] for r in rows if r["row"] in stopped)) / free) if free else level
            now = {r["row"] for r in rows if wish[r["row"]] * level > M.CAP}
            if now == stopped:
                break
            stopped = now
        if preference is None:
            total = sum(r["size"] for r in rows)
            level = goal[s] / total if total else 0.0
        for r in rows:
            r["e"] = min(wish[r["row"]] * level, M.CAP)
            r["whole"] = int(r["e"])
            p = r["e"] - r["whole"]
            odds = r["u"] / (1 - r["u"]) / (p / (1 - p)) if p > 0 else None
            r["rank"] = None if odds is None else min(int(odds / (1 + odds) * 2**52), 2**52 - 1)
        need = goal[s] - sum(r["whole"] * r["size"] for r in rows)
        ranked = sorted((r for r in rows if r["rank"] is not None and r["size"]), key=lambda r: (r["rank"], r["spread"]))
        upto, best, most = 0, (abs(need), 0), 0
        for k, r in enumerate(ranked, 1):
            upto += r["size"]
            best = min(best, (abs(upto - need), k))
        taken = {r["row"] for r in ranked[: best[1]]}
        out += [(r["doc_id"], r["size"], (r["whole"] + (r["row"] in taken)) * r["size"]) for r in rows]
    return Counter(out)


@pytest.fixture(scope="module")
def many(spark, tmp_path_factory):
    import random

    rng = random.Random(8)
    rows = []
    for k in range(3000):
        source = rng.choice(["b"] * 9 + ["a", "a", "Z", None, "é", "tiny"] + ["c", "d"]) if k % 40 else "mini"
        rows.append((k, sentence(rng, rng.randint(0, 60) if source != "tiny" else 1), "en", source, k % 7, *["z"] * 9))
    path = str(tmp_path_factory.mktemp("mix") / "documents.parquet")
    spark.createDataFrame(rows, SCHEMA).repartition(4).write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("ranked_at_most", [M.RANKED, 2])
def test_equal_to_sorting(spark, many, ranked_at_most):
    got = mixed(many, ranked_at_most=ranked_at_most)
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in got) == brute_taken(spark, many)
    sizes = Counter()
    for r in many.collect():
        sizes[r["source"]] += words(r["text"])
    goal = targets(sizes)
    assert any(goal[s] == M.CAP * sizes[s] for s in goal)  # one source is stopped by its size
    source = {r["doc_id"]: r["source"] for r in many.collect()}
    taken = Counter()
    for r in got:
        taken[source[r["doc_id"]]] += r["taken"]
        assert r["source_size"] == sizes[source[r["doc_id"]]] and r["target"] == pytest.approx(goal[source[r["doc_id"]]])
        assert r["taken"] == r["copies"] * r["size"] and 0 <= r["copies"] <= M.CAP
    assert all(abs(taken[s] - goal[s]) <= 30 for s in goal)  # half of the longest document


def test_preferences(spark, many):
    wish = F.col("n_chars") + 1
    got = mixed(many, preference=wish, ranked_at_most=3)
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in got) == brute_taken(spark, many, wish)
    chars = {r["doc_id"]: r["n_chars"] for r in many.collect()}
    of = lambda n: [r["copies"] for r in got if chars[r["doc_id"]] == n and r["size"]]
    assert sum(of(6)) / len(of(6)) > 2 * sum(of(0)) / len(of(0))


def test_reruns_agree(many):
    assert Counter(map(tuple, mixed(many))) == Counter(map(tuple, mixed(many.repartition(7, "doc_id"))))


def test_edge_rows(spark, edge, empty):
    got = mixed(edge)
    assert Counter((r["doc_id"], r["size"], r["taken"]) for r in got) == brute_taken(spark, edge)
    assert Counter(r["size"] for r in got) == Counter(words(r["text"]) for r in edge.collect())
    assert mixed(empty) == []


def test_copies_of_one_row(spark):
    """Equal rows are told apart by their place, so a group of them is cut like any other."""
    rows = [(None, "one two three", "en", "s", 1, *["z"] * 9)] * 500 + [(k, "four five", "en", "t", 1, *["z"] * 9) for k in range(100)]
    got = mixed(spark.createDataFrame(rows, SCHEMA), ranked_at_most=4)
    goal = targets({"s": 1500, "t": 200})
    assert len(got) == 600
    assert abs(sum(r["taken"] for r in got if r["doc_id"] is None) - goal["s"]) <= 1.5
    assert abs(sum(r["taken"] for r in got if r["doc_id"] is not None) - goal["t"]) <= 1


def test_inclusion_follows_probability(spark):
    """Over many documents, the share taken of each preference is near its inclusion probability."""
    rows = [(k, "w " * 10, "en", "s", k % 4, *["z"] * 9) for k in range(8000)] + [(10_000, "w " * 80_000, "en", "t", 0, *["z"] * 9)]
    docs = spark.createDataFrame(rows, SCHEMA)
    got = {r["doc_id"]: r["copies"] for r in M.mix(docs, weights=(1, 3), preference=F.col("n_chars") + 1).collect()}
    share = [sum(got[k] for k in range(8000) if k % 4 == n) / 2000 for n in range(4)]
    for n in range(4):  # 8000 documents share 40 % of 160,000 words... by preference 1, 2, 3 and 4
        assert share[n] == pytest.approx(0.2 * (n + 1), abs=0.03)
