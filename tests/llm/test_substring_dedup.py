import datetime
import decimal
import hashlib
import random

from citylake.llm import substring_dedup as S
from llm_cases import plain, sentence


def got(df, **options):
    rows = S.remove_repeats(df, **options).collect()
    return sorted((r.doc_id, r.n_words, r.n_removed, hashlib.sha256(r.kept_text.encode()).hexdigest()) for r in rows)


def test_random_texts_match_brute_force(spark):
    rng = random.Random(11)
    pool = [sentence(rng, rng.randint(15, 60)) for _ in range(12)]
    rows = []
    for k in range(150):
        parts = [rng.choice(pool) if rng.random() < 0.5 else sentence(rng, rng.randint(1, 40)) for _ in range(rng.randint(0, 6))]
        rows.append((k, rng.choice([" ", "\n", " \t"]).join(parts)))
    rows += [(200, "a " * 100), (201, "a b " * 60), (202, "a " * 19), (203, "a " * 20), (204, "a " * 21)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    assert got(df) == sorted(S.reference_removed(rows))


def test_edge_rows(edge):
    """Null ids come first; of two equal rows one keeps its words."""
    rows = [(d if d is not None else -(1 << 63), t) for d, t in plain(edge)]
    want = sorted(S.reference_removed(rows))
    have = sorted((-(1 << 63) if r[0] is None else r[0], *r[1:]) for r in S.remove_repeats(edge).select("doc_id", "n_words", "n_removed", "kept_text").collect())
    assert [w[:3] for w in want] == [h[:3] for h in have]


def test_small_slices_and_shards_give_the_same(edge, monkeypatch):
    before = sorted(map(tuple, S.remove_repeats(edge).select("n_words", "n_removed", "kept_text").collect()))
    monkeypatch.setattr(S, "SLICE_KEYS", 50)
    monkeypatch.setattr(S, "SHARD_PASSAGES", 20)
    assert sorted(map(tuple, S.remove_repeats(edge).select("n_words", "n_removed", "kept_text").collect())) == before


def test_hot_anchors_dealt_by_their_windows_give_the_same(spark):
    """A common line among differing words, at more places than an anchor may have."""
    rng = random.Random(3)
    line = sentence(rng, 12)
    rows = [(k, f"{sentence(rng, 15)} {line} {sentence(rng, 15)}") for k in range(300)]
    rows += [(5000 + k, rows[k][1] + " " + sentence(rng, 5)) for k in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    assert got(df, hot_places=50) == got(df, hot_places=1) == got(df) == sorted(S.reference_removed(rows))


def test_without_repeats_keeps_columns(edge):
    out = S.without_repeats(edge)
    assert out.schema == edge.schema
    rows = {r["doc_id"]: r for r in out.collect()}
    assert 15 not in rows and rows[1]["text"] is None and rows[2]["text"] == ""
    assert rows[14]["text"] == {d: t for d, t in plain(edge)}[14]
    assert rows[19]["n_chars"] == len(rows[19]["text"]) and rows[19]["score"] == "z"


def test_empty_table(empty):
    assert S.remove_repeats(empty).collect() == []
    assert S.without_repeats(empty).collect() == []


def test_without_repeats_keeps_long_texts_and_typed_columns(spark):
    """A text over 20,000,000 characters (more than a JSON string may have in Spark), microseconds and nested values."""
    rng = random.Random(8)
    at = datetime.datetime(2024, 5, 6, 7, 8, 9, 123456)
    extra = (at, at, decimal.Decimal("12.345678"), b"\x00\xff", float("nan"), {2: ["a", None]}, at.date())
    passage = sentence(rng, 40)
    rows = [
        (1, "y" * 21_000_000, *extra), (None, "  two \u0000 spaces\tstay ", *extra), (3, passage, *extra), (4, "own words " + passage, *extra),
        (5, None, *[None] * 7), (6, "", *extra), (7, passage + " " + "z" * 21_000_000, *extra),
    ]
    kinds = "ts timestamp, ntz timestamp_ntz, d decimal(10,6), b binary, f double, m map<int,array<string>>, day date"
    df = spark.createDataFrame(rows, f"doc_id long, text string, {kinds}").repartition(2)
    out = S.without_repeats(df)
    assert out.schema == df.schema
    want = {r[0]: r for r in rows} | {4: (4, "own words", *extra), 7: (7, "z" * 21_000_000, *extra)}
    have = {r["doc_id"]: tuple(r) for r in out.collect()}
    assert have.keys() == want.keys()
    assert all(repr(have[k]) == repr(want[k]) if k not in (1, 7) else have[k][1] == want[k][1] and repr(have[k][2:]) == repr(want[k][2:]) for k in want)
