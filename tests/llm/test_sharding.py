import zlib
from collections import defaultdict

from llm_cases import plain, sentence

from citylake.llm import sharding as S


def check(rows, out, shards):
    assert sorted((str(d), len((t or "").encode()) + 16, zlib.crc32((t or "").encode())) for d, t in rows) == sorted(
        (str(r.doc_id), r.size, r.text_crc32) for r in out
    )
    slots, size = defaultdict(list), defaultdict(int)
    for r in out:
        slots[r.shard].append(r.slot)
        size[r.shard] += r.size
    assert all(sorted(v) == list(range(len(v))) for v in slots.values())
    assert set(slots) <= set(range(shards))
    mean = sum(size.values()) / shards
    assert all(abs(v - mean) <= max(r.size for r in out) for v in size.values())


def test_edge_rows(edge):
    check(plain(edge), S.assign(edge, 4, ranges=8, sample=40).collect(), 4)


def test_hot_text_is_subdivided_and_copies_are_neighbours(spark):
    import random

    rng = random.Random(2)
    hot = sentence(rng, 50)
    rows = [(k, hot if k % 3 == 0 else sentence(rng, 20 + k % 60)) for k in range(1500)]
    rows += [(5000 + k, f"pair {k // 2} " * 20) for k in range(40)]
    out = S.assign(spark.createDataFrame(rows, "doc_id long, text string"), 10, ranges=60, sample=600).collect()
    check(rows, out, 10)
    text = dict(rows)
    by = defaultdict(set)
    for r in out:
        by[text[r.doc_id]].add(r.shard)
    assert all(max(v) - min(v) + 1 == len(v) for v in by.values())  # equal texts take neighbouring shards only
    assert sum(len(v) > 1 for t, v in by.items() if t != hot) <= 9


def test_result_does_not_depend_on_the_sample(spark):
    rows = [(k, "t" * (k % 97)) for k in range(400)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    one, two = (sorted(map(tuple, S.assign(df, 7, r, s).collect())) for r, s in ((3, 30), (50, 300)))
    assert one == two


def test_write_shards(spark, edge, tmp_path):
    table = S.write_shards(edge, str(tmp_path / "out"), 3)
    assert table.count() == edge.count() and table.where("slot is null").isEmpty()
    assert set(edge.columns) - {"shard"} <= set(table.columns)


def test_empty_table(empty):
    assert S.assign(empty).collect() == []
