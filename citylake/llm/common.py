"""Shared helpers: scratch tables, word splitting and document blocks.

A *block* packs the texts of some hundred documents in one row. Operators that need a
corpus-wide lookup (is this phrase repeated, how often does this word occur) send each
block's distinct keys once to the key's slice and get one answer per key back, instead
of shuffling a row per word. A key that occurs in a third of all documents is then sent
once per block, so no slice grows with the number of its copies.
"""

from __future__ import annotations

import math
import tempfile
import uuid
import zipfile
from collections import defaultdict
from collections.abc import Callable, Iterator
from itertools import count
from pathlib import Path

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.session import configure, ensure_checkpoint_dir

BLOCK_BYTES = 2 << 20
BLOCK_SCHEMA = "block long, n_docs int, n_words long, doc_ids binary, known binary, lengths binary, texts binary, rests binary"


def _ship_package(spark: SparkSession) -> None:
    """Send this package to the executors' Python, once per application (like --py-files)."""
    sc = spark.sparkContext
    if getattr(sc, "_citylake_shipped", False):
        return
    root = Path(__file__).resolve().parents[1]
    target = Path(tempfile.mkdtemp(prefix="citylake-")) / "citylake.zip"
    with zipfile.ZipFile(target, "w") as z:
        for p in sorted(root.rglob("*.py")):
            z.write(p, p.relative_to(root.parent))
    sc.addPyFile(str(target))
    sc._citylake_shipped = True


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the library's defaults, a shared checkpoint folder and this package on executors."""
    configure(spark)
    ensure_checkpoint_dir(spark)
    _ship_package(spark)
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prepared(spark).read.parquet(f"{sf_dir}/documents.parquet")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path below the shared checkpoint folder."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to a shared table and read back: cuts lineage, survives lost executors."""
    path = scratch_path(df.sparkSession, name)
    df.write.option("compression", "zstd").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def words(text: str | bytes | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` in UTF-8 (``bytes.split`` cuts at exactly these characters)."""
    if text is None:
        return []
    return (text.encode("utf-8", "surrogatepass") if isinstance(text, str) else text).split()


def text_bytes(column: pa.Array) -> list[bytes]:
    """The UTF-8 bytes of a string column, empty for nulls, without decoding."""
    kind = pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()
    return [x or b"" for x in column.cast(kind).to_pylist()]


def chunked(batches: Iterator[pa.RecordBatch], limit: int = BLOCK_BYTES) -> Iterator[tuple[pa.Array, list[bytes]]]:
    """(first column, texts of the second) in pieces of about ``limit`` bytes; a longer text is a piece of its own."""
    for batch in batches:
        first, texts, size = 0, [], 0
        for at in range(0, batch.num_rows, 256):  # only a piece's texts are Python objects at a time
            for k, x in enumerate(text_bytes(batch.column(1).slice(at, 256)), at):
                texts.append(x)
                size += len(x) + 64
                if size >= limit or k + 1 == batch.num_rows:
                    yield batch.column(0).slice(first, len(texts)), texts
                    first, texts, size = k + 1, [], 0


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> np.uint64(32))
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0x9E3779B97F4A7C15)
    return x ^ (x >> np.uint64(32))


def slice_of(keys: np.ndarray, n: int) -> np.ndarray:
    """The slice 0..n-1 of each key, growing with the key."""
    return ((keys >> np.uint64(32)) * np.uint64(n) >> np.uint64(32)).astype(np.int64)


class Tokens:
    """The words of some documents as numbers: local ids, a 64-bit hash per word, offsets by document."""

    def __init__(self, texts: list[bytes], lower: bool = False):
        index: defaultdict[bytes, int] = defaultdict(count().__next__)
        self.lists = [(x.lower() if lower else x).split() for x in texts]
        self.lengths = np.fromiter(map(len, self.lists), np.int64, len(self.lists))
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        total = int(self.ends[-1]) if len(self.ends) else 0
        self.ids = np.fromiter((i for ws in self.lists for i in map(index.__getitem__, ws)), np.int64, total)
        self.vocabulary = list(index)
        self.vocabulary_hash = np.fromiter(map(xxhash.xxh3_64_intdigest, self.vocabulary), np.uint64, len(index))
        self.hash = self.vocabulary_hash[self.ids] if total else np.empty(0, np.uint64)


def gram_hash(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of each run of ``n`` consecutive word hashes (not aware of document ends)."""
    out = np.zeros(max(0, len(hashes) - n + 1), np.uint64)
    for j in range(n):
        out = out * np.uint64(0x9E3779B97F4A7C15) + hashes[j : j + len(out)]
    return mix(out)


class Lookup(dict):
    """A bounded cache that fills itself: ``lookup[word]`` is ``compute(word)``, kept while the word is
    among the last ``size`` to twice ``size`` different ones (counted at each ``turn``)."""

    def __init__(self, size: int, compute: Callable[[str], bytes]):
        super().__init__()
        self.size, self.compute, self.old = size, compute, {}

    def __missing__(self, word: str) -> bytes:
        found = self.old.get(word)
        if found is None:
            found = self.compute(word)
        self[word] = found
        return found

    def turn(self) -> None:
        """Between batches: words not asked for since the last but one turn of the cache are dropped."""
        if len(self) > self.size:
            self.old = dict(self)
            self.clear()


def _ipc(array: pa.Array) -> pa.Buffer:
    """An array of any type as an Arrow stream."""
    sink = pa.BufferOutputStream()
    batch = pa.record_batch([array], ["rest"])
    with pa.ipc.new_stream(sink, batch.schema) as out:
        out.write_batch(batch)
    return sink.getvalue()


def pack_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    from pyspark import TaskContext

    packer = zstandard.ZstdCompressor(level=1)
    part, number = TaskContext.get().partitionId(), count()
    kept: list[tuple[int, bool, bytes, int]] = []
    rests: list[pa.Array] = []
    size = 0

    def pack() -> pa.RecordBatch:
        kept.sort(key=lambda x: x[:2])
        texts = [x[2] for x in kept]
        rest = _ipc(pa.concat_arrays(rests).take(pa.array([x[3] for x in kept], pa.int64()))) if rests else b""
        row = {
            "block": [(part << 32) | next(number)],
            "n_docs": [len(kept)],
            "n_words": [sum(len(x.split()) for x in texts)],
            "doc_ids": [np.array([x[0] for x in kept], np.int64).tobytes()],
            "known": [np.array([x[1] for x in kept], np.bool_).tobytes()],
            "lengths": [np.array([len(x) for x in texts], np.int64).tobytes()],
            "texts": [packer.compress(b"".join(texts))],
            "rests": [packer.compress(rest)],
        }
        kinds = [pa.int64(), pa.int32(), pa.int64()] + [pa.binary()] * 5
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(row.values(), kinds)], list(row))

    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            rows = batch.slice(at, 256)
            for k, (doc, text) in enumerate(zip(rows.column(0).to_pylist(), text_bytes(rows.column(1)))):
                kept.append((doc if doc is not None else -(1 << 63), doc is not None, text, len(kept)))
                size += len(text) + 64
                if rows.num_columns > 2:
                    rests.append(rows.column(2).slice(k, 1))
                    size += rests[-1].nbytes
                if size >= BLOCK_BYTES:
                    yield pack()
                    kept.clear()
                    rests.clear()
                    size = 0
    if kept:
        yield pack()


def texts_of(docs: DataFrame, rest: Column | None = None) -> DataFrame:
    """The columns that :func:`pack_blocks` reads."""
    return docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        *([] if rest is None else [rest.alias("rest")]),
    )


def packed(docs: DataFrame, rest: Column | None = None) -> DataFrame:
    """Documents packed into blocks, sorted by doc_id (null first) inside each.

    A null text is an empty text; a null doc_id stays null in results. ``rest`` is a column of any type
    that Arrow has (such as a struct of the other columns) that stays with its document, as it is.
    """
    return texts_of(docs, rest).mapInArrow(pack_blocks, BLOCK_SCHEMA)


def blocks(docs: DataFrame, rest: Column | None = None) -> DataFrame:
    """``packed`` documents as a written table, so that every reader sees the same block numbers."""
    return written(packed(docs, rest), "blocks")


class Block:
    """A block row, unpacked."""

    def __init__(self, row: dict):
        self.block = row["block"]
        self.doc_ids = np.frombuffer(row["doc_ids"], np.int64)
        self.known = np.frombuffer(row["known"], np.bool_)
        self._rests = row["rests"]
        lengths = np.frombuffer(row["lengths"], np.int64)
        joined = zstandard.ZstdDecompressor().decompress(row["texts"], max_output_size=max(1, int(lengths.sum())))
        ends = np.cumsum(lengths).tolist()
        self.texts = [joined[a:b] for a, b in zip([0, *ends], ends)]

    def rests(self) -> pa.Array:
        return pa.ipc.open_stream(zstandard.ZstdDecompressor().decompress(self._rests)).read_next_batch().column(0)

    def ids(self) -> pa.Array:
        """The doc_id column, nulls restored."""
        return pa.array(self.doc_ids, pa.int64(), mask=~self.known)


def block_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[dict]:
    """The rows of record batches, one at a time."""
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def slices_for(total: float, each: int) -> int:
    """A number of slices that grows with the data: about ``each`` keys in a slice."""
    return max(8, math.ceil(total / each))


def scattered(keys: np.ndarray, n: int) -> list[tuple[int, slice]]:
    """(slice number, range) of sorted keys, for each slice that has keys."""
    where = slice_of(keys, n)
    cuts = np.flatnonzero(np.diff(where)) + 1
    bounds = [0, *cuts.tolist(), len(keys)]
    return [(int(where[a]), slice(a, b)) for a, b in zip(bounds, bounds[1:]) if b > a]
