import zlib

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from citylake.llm import common
from citylake.llm import token_frames as F
from llm_cases import plain


@pytest.fixture(scope="module")
def encoder():
    return F.WordEncoder(F.tokenizer_path())


def test_words_equal_the_library(encoder):
    texts = ["Ａ b", "It's ONE 12 x</w>", "a b ́c", "<|startoftext|> hi <|endoftext|>", "İstanbul ΣΑΣ", "\x1cq\x00", "", "ﬁ é 가"]
    have = [np.frombuffer(x, "<u4").tolist() for x in encoder.many(texts)]
    assert have == [encoder.tokenizer.encode(t, add_special_tokens=False).ids for t in texts]


ALPHABET = [chr(c) for c in range(33, 0x134)] + list("abcXYZ'sreve  \n\t") + ["Σ", "İ", "ŉ", "é", "ﬁ", "한", "<|endoftext|>", "ͅ", "\u2028"]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.sampled_from(ALPHABET), max_size=30))
def test_any_text_equals_the_library(encoder, parts):
    text = "".join(parts)
    assert np.frombuffer(encoder.many([text])[0], "<u4").tolist() == encoder.tokenizer.encode(text, add_special_tokens=False).ids


def test_write_and_read_edge_rows(spark, edge, encoder):
    folder = common.scratch_path(spark, "frames-test")
    manifest = F.write(edge, folder, F.tokenizer_path())
    rows = F.read(spark, folder, manifest).collect()
    key = lambda d: (d is not None, d or 0)
    coded = sorted(
        ((d, encoder.tokenizer.encode(t or "", add_special_tokens=False).ids + [F.END_ID]) for d, t in plain(edge)), key=lambda x: key(x[0])
    )
    assert [r.doc_id for r in sorted(rows, key=lambda r: r.start)] == [d for d, _ in coded]
    want = sorted((str(d), len(x), zlib.crc32(np.array(x, "<u4").tobytes())) for d, x in coded)
    assert sorted((str(r.doc_id), r.n_tokens, r.ids_crc32) for r in rows) == want
    at = 0
    for r in sorted(rows, key=lambda r: r.start):
        assert r.start == at
        at += r.n_tokens


def test_reader_decompresses_only_requested_frames_and_detects_damage():
    sink = pa.BufferOutputStream()
    writer = F.FrameWriter(sink, frame_ids=50)
    ids = {d: np.arange(d, d + d % 30, dtype="<u4") for d in range(100)}
    for d, x in ids.items():
        writer.add(d, x.tobytes())
    writer.close()
    data = sink.getvalue().to_pybytes()
    reader = F.FrameReader(pa.BufferReader(data))
    assert len(reader.frames) > 10
    read = []
    original = reader.frame
    reader.frame = lambda k: read.append(k) or original(k)
    found = dict(reader.documents({5, 99}))
    assert {d: x.tolist() for d, x in found.items()} == {d: ids[d].tolist() for d in (5, 99)} and len(read) == 2
    import zstandard

    whole = zstandard.ZstdDecompressor().decompressobj(read_across_frames=True).decompress(data)
    assert len(whole) == sum(f[1] for f in reader.frames)
    frame = reader.offsets[3] + 20
    broken = F.FrameReader(pa.BufferReader(data[:frame] + bytes([data[frame] ^ 1]) + data[frame + 1 :]))
    with pytest.raises(Exception):
        broken.frame(3)
    with pytest.raises(ValueError):
        F.FrameReader(pa.BufferReader(data[:-1]))


def test_empty_table(spark, empty):
    folder = common.scratch_path(spark, "frames-empty")
    assert F.read(spark, folder, F.write(empty, folder, F.tokenizer_path())).collect() == []


def test_rows_of_one_id_are_dealt_over_files(spark):
    """Null and repeated doc_ids, equal rows too, are in many files, none loses a row; nothing unfinished stays."""
    rows = [(None, f"text {k}") for k in range(400)] + [(7, "the same")] * 400 + [(k, "x") for k in range(20)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(8)
    folder = common.scratch_path(spark, "frames-hot")
    coalesce = "spark.sql.adaptive.coalescePartitions.enabled"
    spark.conf.set(coalesce, "false")  # so few rows would be joined in one range
    try:
        manifest = F.write(docs, folder, F.tokenizer_path())
    finally:
        spark.conf.unset(coalesce)
    assert max(r.docs for r in manifest.collect()) < 400 and sum(r.docs for r in manifest.collect()) == len(rows)
    have = F.read(spark, folder, manifest)
    assert have.count() == len(rows) and have.where("doc_id is null").count() == 400 and have.where("doc_id = 7").count() == 401
    ordered = [r.doc_id for r in sorted(have.collect(), key=lambda r: r.start)]
    assert ordered == [None] * 400 + sorted(d for d, _ in rows if d is not None)
    fs, root = F.open_folder(F.qualified(spark, folder))
    names = [i.base_name for i in fs.get_file_info(F.pafs.FileSelector(root))]
    assert names and not any(n.startswith(".part-") and not n.endswith(".crc") for n in names)


def test_unfinished_files_are_removed_and_paths_get_a_scheme(spark, tmp_path):
    (tmp_path / ".part-000001-dead").write_bytes(b"half")
    (tmp_path / "part-000000.zst").write_bytes(b"whole")
    F._remove_unfinished(str(tmp_path))
    assert [p.name for p in tmp_path.iterdir()] == ["part-000000.zst"]
    assert F.qualified(spark, str(tmp_path)) == f"file:{tmp_path}"
