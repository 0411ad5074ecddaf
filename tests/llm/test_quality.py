import re
from collections import Counter

from pyspark.sql import functions as F

from llm_cases import SCHEMA, edge_rows

from citylake.llm import quality as Q


def brute(text):
    text = text or ""
    ws = [w.decode() for w in text.encode().split()]
    n = len(ws)
    seen = Counter(tuple(ws[k : k + 8]) for k in range(n - 7))
    again = {p for k in range(n - 7) if seen[tuple(ws[k : k + 8])] > 1 for p in range(k, k + 8)}
    lines = [x for x in text.split("\n") if re.search("[^ \t-\r]", x)]
    return (n, sum(map(len, ws)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(again))


def test_counts_match_brute_force(edge):
    rows = Q.judged(edge).collect()
    have = sorted((str(r.doc_id), r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) for r in rows)
    assert have == sorted((str(d), *brute(t)) for d, t, *_ in edge_rows())
    for r in rows:
        assert r.base_failed == (r.n_words < 20 or 100 * r.n_repeat_words > 30 * r.n_words)
        assert not (r.base_failed and r.kept)


def test_overlapping_and_separate_repeats(spark):
    texts = ["a " * 9, "x y z w q r s t " * 2 + "end", "1 2 3 4 5 6 7 8 9 1 2 3 4 5 6 7 8", " ".join(map(str, range(30))), "a b " * 40]
    rows = [(k, t, "en", "s") for k, t in enumerate(texts)]
    out = Q.measured(spark.createDataFrame(rows, "doc_id long, text string, lang string, source string"), "doc_id").collect()
    assert {r.doc_id: r.n_repeat_words for r in out} == {k: brute(t)[4] for k, t in enumerate(texts)}


def table(spark, groups):
    rows, k = [], 0
    for lang, source, n, text in groups:
        for i in range(n):
            rows.append((k, text(i), lang, source))
            k += 1
    return spark.createDataFrame(rows, "doc_id long, text string, lang string, source string")


def clean(i):
    return " ".join(f"word{chr(97 + (i * 7 + j * j) % 26)}{j}" for j in range(30 + i % 5))


def junk(i):
    return " ".join(f"##{j}$$" for j in range(40))


def test_thresholds_follow_the_group(spark):
    """Symbols are odd in one source and usual in another: the same text is judged by its own group."""
    df = table(spark, [("en", "plain", 300, clean), ("en", "plain", 3, junk), ("en", "symbols", 300, junk), ("en", "rare", 5, clean), (None, None, 4, clean)])
    rows = {r.doc_id: r for r in Q.judged(df).collect()}
    assert all(rows[k].kept for k in range(300))
    assert not any(rows[k].kept for k in range(300, 303))
    assert all(rows[k].kept for k in range(303, 603))
    assert len(rows) == df.count()


def test_large_group_has_the_same_thresholds_in_every_run(spark):
    """40,000 values over other partitions: the same sketch, and quartiles within its accuracy."""
    import random

    rng = random.Random(4)
    values = [rng.lognormvariate(4, 0.3) for _ in range(40_000)]
    rows = spark.createDataFrame([("en", "s", v, v / 100 if k % 3 else 0.0, None if k % 2 else 0.0) for k, v in enumerate(values)],
                                 "lang string, source string, word_length double, symbols double, repeated_lines double")
    one, other = (Q.thresholds(rows.repartition(n, F.rand(n))).collect() for n in (3, 17))
    assert one == other and len(one) == 1
    q1, q3 = sorted(values)[9_999], sorted(values)[29_999]
    middle = (one[0].word_length_low + one[0].word_length_high) / 2
    assert abs(middle / ((q1 + q3) / 2) - 1) < Q.ACCURACY
    assert one[0].repeated_lines_low == -Q.FENCE * Q.FLOOR["repeated_lines"]


def test_empty_and_textless_tables(spark, empty):
    assert Q.judged(empty).collect() == []
    row = Q.judged(spark.createDataFrame([edge_rows()[0]], SCHEMA)).first()
    assert (row.n_words, row.base_failed, row.kept) == (0, True, False)
