import random

import pytest
from llm_cases import sentence

import corpus_pipeline as P
from citylake.llm import bpe, common, jaccard_join, substring_dedup


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(9)
    root = tmp_path_factory.mktemp("pipeline")
    rows, labels = [], []
    passage, item = sentence(rng, 60), sentence(rng, 25)
    for k in range(260):
        text = sentence(rng, rng.randint(30, 90))
        if k % 6 == 0:
            ws = text.split()
            for _ in range(3):
                ws.insert(rng.randrange(len(ws)), "vileword")
            text = " ".join(ws)
        if k % 5 == 1 and k % 6:
            text += " " + passage
        if k in (7, 61):
            text += " " + item + " " + sentence(rng, 30)
        rows.append((k, text, "en", "src0", len(text)))
        labels.append((k, 1, int(k % 6 == 0)))
    rows += [(300 + k, rows[20 + k][1], "en", "src1", 1) for k in range(12)]
    for k in range(12):
        ws = rows[40 + k][1].split()
        ws[-1] = "altered"  # one shingle of many
        rows.append((400 + k, " ".join(ws), "en", "src1", 1))
    rows += [(500, None, None, None, None), (501, "", "en", "src0", 0), (None, sentence(rng, 40), "en", "src0", 1), (26, rows[26][1], "en", "src0", 1)]
    spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{root}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{root}/labels.parquet")
    spark.createDataFrame([(1, item)], "item_id long, text string").write.parquet(f"{root}/benchmark.parquet")
    return str(root)


def test_stages_in_order(spark, folder):
    assert [n for n, _ in P.STAGES] == ["toxicity", "near_duplicates", "repeated_passages", "decontamination", "encoding"]
    docs = common.documents(spark, folder)
    done = {}
    for name, stage in P.STAGES:
        out = common.written(stage(spark, docs, folder), name)
        if name != "encoding":
            assert out.schema == docs.schema
        done[name], docs = out, out
    ids = {n: sorted((r[0] for r in df.select("doc_id").collect()), key=str) for n, df in done.items()}
    toxic = {k for k in range(260) if k % 6 == 0}
    assert not toxic & set(ids["toxicity"]) and set(range(260)) - toxic <= set(ids["toxicity"])
    assert {500, 501, None} <= set(ids["toxicity"])
    kept = ids["near_duplicates"]
    assert len(kept) == len(set(kept)) and not {k for k in kept if k and k >= 300} - {500, 501}
    # Brute force over what the second stage kept.
    links = jaccard_join.reference_links([(r.doc_id, r.text) for r in done["near_duplicates"].collect()])
    assert not any(links.values())
    before = [(r.doc_id if r.doc_id is not None else -(1 << 63), r.text) for r in done["near_duplicates"].collect()]
    want = {d: n - m for d, n, m, _ in substring_dedup.reference_removed(before) if m < n or not n}
    have = {(r.doc_id if r.doc_id is not None else -(1 << 63)): len(common.words(r.text)) for r in done["repeated_passages"].collect()}
    assert have == want
    assert set(ids["repeated_passages"]) - set(ids["decontamination"]) == {7}  # 61 lost the item as a repeat of 7
    codec = bpe.codec(bpe.tokenizer_path())
    text = {r.doc_id: r.text for r in done["decontamination"].collect()}
    for r in done["encoding"].collect():
        assert r.ids == codec.tokenizer.encode(text[r.doc_id] or "", add_special_tokens=False).ids


def test_run_equals_its_stages(spark, folder):
    docs = common.documents(spark, folder)
    for _, stage in P.STAGES:
        docs = common.written(stage(spark, docs, folder), "again")
    assert sorted(map(str, P.run(spark, folder).collect())) == sorted(map(str, docs.collect()))


def test_empty_documents(spark, folder, tmp_path):
    spark.read.parquet(f"{folder}/documents.parquet").limit(0).write.parquet(f"{tmp_path}/documents.parquet")
    for t in ("labels", "benchmark"):
        spark.read.parquet(f"{folder}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    assert P.run(spark, str(tmp_path)).collect() == []
