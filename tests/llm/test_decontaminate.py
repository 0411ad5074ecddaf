import itertools
import random
import re

import duckdb
from llm_cases import plain, sentence

from citylake.llm import decontaminate as D


def words(t):
    return [w for w in re.split(r"[^\w]+|_", (t or "").lower()) if w]


def brute(docs, items):
    """(doc_id, item_id, matched, window) over all alignments."""
    out = set()
    for (d, t), (i, q) in itertools.product(docs, items):
        a, b = words(t), words(q)
        size = min(D.WINDOW, len(b))
        if len(b) < 5:
            continue
        best = 0
        for shift in range(-len(b) + 1, len(a)):
            e = [0 <= j + shift < len(a) and a[j + shift] == w for j, w in enumerate(b)]
            best = max(best, *(sum(e[k : k + size]) for k in range(len(e) - size + 1)))
        if best >= D.AGREE * size:
            out.add((d, i, best, size))
    return out


def test_masks_find_every_window_with_three_substitutions():
    masks = [[k for k, c in enumerate(m) if c == "1"] for m in D.MASKS]
    for bad in itertools.combinations(range(D.WINDOW), 3):
        assert any(not {s + k for k in m} & set(bad) for m in masks for s in range(D.WINDOW - m[-1]))


def make(spark):
    rng = random.Random(6)
    items = [(k, sentence(rng, rng.randint(15, 40))) for k in range(12)] + [(50, "too short item"), (51, None), (52, "")]
    docs = []
    for k in range(60):
        ws = sentence(rng, rng.randint(5, 80)).split()
        if k % 2:
            q = items[k % 12][1].split()
            for _ in range(rng.randint(0, 5)):
                q[rng.randrange(len(q))] = "other"
            a = rng.randrange(len(ws) + 1)
            ws[a:a] = [w.upper() + "," for w in q[rng.randint(0, 3) :]]
        docs.append((k, " ".join(ws)))
    docs += [(100, None), (101, ""), (None, items[0][1]), (102, items[1][1]), (102, items[1][1])]
    return docs, items


def test_substitutions_match_brute_force_and_sql(spark, tmp_path):
    docs, items = make(spark)
    d = spark.createDataFrame(docs, "doc_id long, text string")
    i = spark.createDataFrame(items, "item_id long, text string")
    have = {tuple(r) for r in D.overlaps(d, i).collect()}
    assert have == brute(docs, items) and len(have) > 20
    d.where("doc_id is not null").dropDuplicates().write.parquet(str(tmp_path / "documents"))
    i.write.parquet(str(tmp_path / "benchmark"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{tmp_path}/{t}/*.parquet'")
    assert {tuple(r) for r in con.sql(D.OP9_SQL).fetchall()} == {h for h in have if h[0] is not None}


def test_crowded_filter_gives_the_same(spark, monkeypatch):
    docs, items = make(spark)
    monkeypatch.setattr(D, "FILTER_WORDS", (1, 1))
    d = spark.createDataFrame(docs, "doc_id long, text string")
    assert {tuple(r) for r in D.overlaps(d, spark.createDataFrame(items, "item_id long, text string")).collect()} == brute(docs, items)


def test_decontaminated_keeps_columns_and_clean_rows(spark, edge, empty):
    items = spark.createDataFrame([(1, dict(plain(edge))[11])], "item_id long, text string")
    out = D.decontaminated(edge, items)
    assert out.schema == edge.schema
    assert out.count() == edge.count() - 1
    assert D.decontaminated(edge, items.limit(0)).count() == edge.count()
    assert D.overlaps(empty, items).collect() == []


def test_only_dataframe_operations(spark, edge):
    plan = D.overlaps(edge, spark.createDataFrame([(1, "a b c d e f")], "item_id long, text string"))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Cartesian" not in plan


#: The rule in SQL without seeds: every alignment of every pair.
WITHOUT_SEEDS = f"""
WITH d AS (SELECT doc_id, {D._SQL_WORDS} AS h FROM documents), i AS (SELECT item_id, {D._SQL_WORDS} AS h FROM benchmark),
shifts AS (SELECT doc_id, d.h AS t, item_id, i.h AS q, unnest(range(1 - len(i.h), len(d.h))) AS s FROM d, i),
compared AS (
  SELECT doc_id, item_id, least({D.WINDOW}, len(q)) AS w,
         [CASE WHEN j + s >= 1 AND t[j + s] = q[j] THEN 1 ELSE 0 END FOR j IN range(1, len(q) + 1)] AS e FROM shifts WHERE len(q) > 0
),
best AS (SELECT doc_id, item_id, w, list_max([list_sum(e[k : k + w - 1]) FOR k IN range(1, len(e) - w + 2)]) AS m FROM compared)
SELECT doc_id, item_id, CAST(max(m) AS BIGINT), CAST(max(w) AS BIGINT) FROM best WHERE m * 5 >= w * 4 GROUP BY doc_id, item_id
"""


def test_items_of_1_to_14_words_match_a_search_without_seeds(spark, tmp_path):
    """All placements of the allowed substitutions, and of one more; a null item_id; a sentence without spaces."""
    items = [(n, " ".join(f"i{n}w{k}" for k in range(n))) for n in range(1, 15)]
    items += [(None, "an item without a number"), (20, "\u6211\u4eec\u5728\u8fd9\u91cc\u3002"), (21, " ... "), (22, "ha ha ha ha")]
    docs = [f"before {t} after" for _, t in items] + ["ha " * 500, "ha ha ha", "before \u6211\u4eec\u5728\u8fd9\u91cc\u3002 after", ""]
    for n, t in items[:14]:
        allowed = n - -(-4 * n // 5)
        for bad in itertools.chain(itertools.combinations(range(n), allowed), itertools.islice(itertools.combinations(range(n), allowed + 1), 9)):
            docs.append(" ".join(["one", *("x" if k in bad else w for k, w in enumerate(t.split())), "two"]))
    spark.createDataFrame(list(enumerate(docs)), "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents"))
    spark.createDataFrame(items, "item_id long, text string").write.parquet(str(tmp_path / "benchmark"))
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.sql(f"create view {t} as select * from '{tmp_path}/{t}/*.parquet'")
    want = {tuple(r) for r in con.sql(WITHOUT_SEEDS).fetchall()}
    d, i = (spark.read.parquet(str(tmp_path / t)) for t in ("documents", "benchmark"))
    have = {tuple(r) for r in D.overlaps(d, i).collect()}
    assert have == want and {r[1] for r in have} == {None, 20, 22, *range(1, 15)}
    assert D.decontaminated(d, i).count() == len(docs) - len({r[0] for r in want})


def test_rows_are_judged_by_text_not_by_doc_id(spark):
    """Null and repeated doc_ids: only the rows that overlap go."""
    bad = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu nu xi omicron pi rho"
    rows = [(None, bad), (None, "clean words of a text without an id"), (9, "another clean text"), (9, "before " + bad), (7, "clean"), (5, None), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumn("__bad", D.F.lit(1))
    items = spark.createDataFrame([(1, bad)], "item_id long, text string")
    got = D.decontaminated(docs, items)
    assert got.columns == docs.columns
    kept = sorted(((r["doc_id"], r["text"]) for r in got.collect()), key=repr)
    assert kept == sorted([r for r in rows if not r[1] or bad not in r[1]], key=repr)


def test_filter_grows_with_the_seeds():
    least, most = D.FILTER_WORDS
    assert [D.filter_words(n) for n in (0, 1, 8_192, 8_193, 100_000, 10**9)] == [least, least, least, 2 * least, 1 << 18, most]
