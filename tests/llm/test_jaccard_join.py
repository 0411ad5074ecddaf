import itertools
import random

from citylake.llm import jaccard_join as J
from llm_cases import plain, sentence


def shingles(text):
    words = tuple((text or "").encode().split())
    return {words[i : i + 5] for i in range(len(words) - 4)} if len(words) >= 5 else {words} - {()}


def brute(rows):
    """(n_links, copies) of each row and the classes, by comparing all pairs."""
    sets = [shingles(t) for _, t in rows]
    linked = [[i != j and bool(a) and bool(b) and len(a & b) >= 0.8 * len(a | b) for j, b in enumerate(sets)] for i, a in enumerate(sets)]
    label = list(range(len(rows)))
    changed = True
    while changed:
        changed = False
        for i, j in itertools.product(range(len(rows)), repeat=2):
            if linked[i][j] and label[j] < label[i]:
                label[i], changed = label[j], True
    ids = [min([r[0] for r, k in zip(rows, label) if k == x and r[0] is not None], default=None) for x in label]
    copies = [sum(1 for t in sets if t == s) if s else 1 for s in sets]
    key = lambda r: tuple((x is None, x or 0) for x in r)
    return sorted(((r[0], c, sum(row), n) for r, c, row, n in zip(rows, ids, linked, copies)), key=key)


def got(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: tuple((x is None, x or 0) for x in r))


def test_prefix_length_reaches_the_target_recall():
    k = J.prefix_length(0.8, 24, 8, 0.9999)
    assert 1 - (1 - 0.8**k) ** 24 >= 0.9999 > 1 - (1 - 0.8 ** (k + 1)) ** 24
    assert J.prefix_length(1.0) == J.PATH


def test_recall_follows_the_pairs_met():
    sure, near = {256: 10_000}, {256: 10_000, 206: 5_000}
    assert J.recall(sure, 256, 8, 32, 0.8) > 0.9999 > J.recall(near, 256, 8, 32, 0.8)
    assert J.recall(near, 256, 6, 32, 0.8) > 0.9999
    assert J.recall({100: 50}, 256, 8, 32, 0.8) == 0.0 and J.recall({}, 256, 8, 32, 0.8) == 0.0


def nodes_of(spark, rows):
    df = spark.createDataFrame([(k, t) for k, t in enumerate(rows)], "id long, text string")
    return df.mapInArrow(J._signatures(J.TREES, J.PATH), "id long, digest binary, paths binary").withColumnRenamed("id", "node")


def test_prefixes_are_shortened_only_as_far_as_the_data_need(spark):
    rng = random.Random(5)
    plain_rows = [sentence(rng, 300) for _ in range(40)]
    close = [" ".join([*t.split()[:-1], "end"]) for t in plain_rows]
    links, length = J.candidates(nodes_of(spark, plain_rows + close), target=0.99)
    assert length == J.PATH and {(r.a, r.b) for r in links.collect()} >= {(k + 40, k) for k in range(40)}
    # no pair is met: nothing is known of the recall, prefixes go down to the sure length
    links, length = J.candidates(nodes_of(spark, plain_rows))
    assert links.count() == 0 and length == J.prefix_length()


def test_candidates_hold_planted_pairs_near_the_threshold(spark):
    """Pairs at 0.8 to 0.85, hidden among other texts: at least 99 % are in one group."""
    rng = random.Random(8)
    rows, pairs = [], []
    for k in range(300):
        words = sentence(rng, 204).split()
        copy = list(words)
        for at in (20, 60, 100, 140):
            copy[at] = f"x{k}"
        pairs.append((len(rows), len(rows) + 1))
        rows += [" ".join(words), " ".join(copy)]
    sets = [shingles(t) for t in rows]
    pairs = [(a, b) for a, b in pairs if 0.8 <= len(sets[a] & sets[b]) / len(sets[a] | sets[b]) < 0.85]
    assert len(pairs) > 200
    from citylake.llm.components import components

    label = {r["node"]: r["label"] for r in components(J.candidates(nodes_of(spark, rows))[0]).collect()}
    assert sum(a in label and label[a] == label.get(b) for a, b in pairs) >= 0.99 * len(pairs)


def test_edge_rows_match_all_pairs(edge):
    assert got(J.join(edge)) == brute(plain(edge))


def test_empty_table(empty):
    assert J.join(empty).collect() == []
    assert J.one_of_each(empty).collect() == []


def test_dense_group_over_many_tiles_loses_no_link(spark):
    rng = random.Random(3)
    base = sentence(rng, 120).split()
    rows = []
    for k in range(90):
        words = list(base)
        for _ in range(rng.randint(0, 4)):
            words[rng.randrange(len(words))] = f"w{k}"
        rows.append((k, " ".join(words)))
    rows += [(100 + k, sentence(rng, 80)) for k in range(20)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert got(J.join(df, tile=8)) == brute(rows)


def test_one_of_each_keeps_columns_and_one_row_of_a_class(edge):
    kept = J.one_of_each(edge)
    assert kept.schema == edge.schema
    ids = sorted(r["doc_id"] for r in kept.collect() if r["doc_id"] is not None)
    assert 13 in ids and not {15, 16, 17} & set(ids)
    assert {1, 2, 3, 10, 11, 14, 23}.issubset(ids)


def test_null_and_repeated_ids_are_told_apart_by_text(spark):
    """Rows without an id, or with one id, have verdicts of their own, and none meets the others' nodes."""
    import random

    rng = random.Random(11)
    base = [sentence(rng, 40) for _ in range(6)]
    near = base[0].split()
    near[39] = "changed"
    rows = [(None, base[0]), (None, " ".join(near)), (None, base[1]), (None, base[1]), (4, base[2]), (4, base[3]), (4, base[3]),
            (5, base[2]), (6, base[1]), (7, base[4]), (None, None), (None, ""), (8, None), (7, " ".join(near))]
    docs = spark.createDataFrame([(d, t, k) for k, (d, t) in enumerate(rows)], "doc_id long, text string, n long").drop("n")
    kept = sorted(((r["doc_id"], r["text"]) for r in J.one_of_each(docs).collect()), key=repr)
    # of base[0] and its near copies the one with an id stays; of the copies of base[1] and base[2] the smallest id
    blank = [(r["doc_id"], r["text"]) for r in J.one_of_each(docs.where("coalesce(text, '') = ''")).collect()]
    assert sorted(blank, key=repr) == sorted({(None, None), (8, None)} & set(blank) | {(None, "")} & set(blank), key=repr) and (8, None) in blank
    words = [r for r in kept if r[1]]
    assert sorted(words, key=repr) == sorted([(7, " ".join(near)), (6, base[1]), (4, base[2]), (4, base[3]), (7, base[4])], key=repr)
    got = J.join(docs).collect()
    assert len(got) == len(rows)
    assert {r["class_id"] for r in got if r["n_copies"] == 3} == {6}


def test_rows_without_an_id_are_shingled_once(spark, monkeypatch):
    """Many rows without an id: as many texts meet nodes as there are texts in candidate groups."""
    import random

    rng = random.Random(12)
    seen = spark.sparkContext.accumulator(0)
    plain = J._member_sets

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield from plain(iter([b]))

    monkeypatch.setattr(J, "_member_sets", counted)
    base = sentence(rng, 60).split()
    rows = [(None, " ".join(base[:k] + ["w"] + base[k + 1 :])) for k in range(60)]
    got = J.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    assert len(got) == 60 and seen.value == 60
