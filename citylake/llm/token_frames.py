"""Token ids in zstandard frames with a trailing seek table.

File format (all numbers little-endian):

* data frames, each an independent zstandard frame of whole documents:
  ``u32 n | i64 doc_id[n] | u64 length[n] | u32 id[sum of lengths]``;
* one skippable frame (magic 0x184D2A50): per data frame ``u64 first document's number in the
  file, u64 documents, i64 smallest doc_id, i64 largest doc_id``;
* one skippable frame (magic 0x184D2A5E) with the seek table of the public zstandard seekable
  format: per data frame ``u32 compressed size, u32 decompressed size, u32 checksum`` (low half of
  the XXH64 of the decompressed bytes), then ``u32 frames, u8 descriptor 0x80, u32 0x8F92EAB1``.

Any zstandard tool can decompress a file whole. A reader of some documents reads the tail, picks the
frames whose range holds them, and decompresses and verifies only these.

Writing: documents are range-partitioned by doc_id and sorted; a task writes one file under an attempt's
name and renames it at its end, so a repeated task replaces its file and no reader sees half of
one. Ids before a file's first are the sum over the files before it: one row per file.

Defined results: a null or empty text has only the end id; a null doc_id comes first and is stored as
the smallest 64-bit number (documents with that id are read back as null); repeated doc_ids keep
their rows, in any order among them; extra columns are ignored; an empty table has no file.
"""

from __future__ import annotations

import os
import re
import struct
import uuid
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import regex
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.llm import common
from citylake.llm.bpe import byte_alphabet

END_ID = 2
#: A data frame ends with the document that brings it to this many ids.
FRAME_IDS = 1 << 17
CACHE = 150_000
LEVEL = 1
NULL_ID = -(1 << 63)
_INDEX_MAGIC, _SEEK_MAGIC, _SEEK_END = 0x184D2A50, 0x184D2A5E, 0x8F92EAB1

_ODD_SPACE = re.compile("[\\x00-\\x08\\x0e-\\x1f\\x7f\\x85\\xa0\\u1680\\u180e\\u2000-\\u200f\\u2028-\\u202f\\u205f-\\u2064\\u3000\\ufeff]")
#: Characters that may need composition or have a lower case of more than one form.
_BEYOND = re.compile("[^\\x00-\u012f]")
#: What a text of Latin letters, digits, ASCII marks and white space has not.
_NOT_PLAIN = re.compile("[^\t-\r\x20-\x7e\xa1-\u012f]")
#: A full stop or comma behind a letter and before white space: a pre-token of its own.
_MARK = re.compile("(?<=[a-z\xdf-\xf6\xf8-\xff])([.,])(?=[\t-\r ])")
#: Fixed value: the pattern of the tokenizer's pre-tokenizer.
_PARTS = regex.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+")


def tokenizer_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


class WordEncoder:
    """A tokenizer whose pre-tokenizer drops white space: a text's ids are its words' ids, joined.

    The normaliser (composition, lower case) and the pre-tokenizer never look across white space, so
    words are encoded once and kept in a bounded cache. A word of Latin letters below U+0130 needs no
    composition and has one lower case; it is cut by the pre-tokenizer's own pattern and its parts go
    to the library's BPE model. All other words go through the library's whole pipeline, and so do
    texts with special tokens or with white space or control characters other than ASCII white space.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        self.whole = re.compile("|".join([_ODD_SPACE.pattern, *map(re.escape, special)]))
        self.words = common.Lookup(CACHE, self._word)
        self.letters = {b: c for c, b in byte_alphabet().items()}

    def _part(self, part: str) -> bytes:
        """The ids of one pre-token."""
        raw = part if part.isascii() else "".join(map(self.letters.__getitem__, part.encode()))
        return array("I", [t.id for t in self.tokenizer.model.tokenize(raw)]).tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of one word; its lower case and its parts are looked up as words of their own."""
        if not word.isascii() and _BEYOND.search(word):
            ids = self.tokenizer.encode(word, add_special_tokens=False).ids
            return struct.pack(f"<{len(ids)}I", *ids)
        low = word.lower()
        if low != word:
            return self.words[low]
        if word.isalpha():
            return self._part(word)
        core = word.rstrip(".,;:!?")
        if core.isalpha():  # letters and closing marks: two pre-tokens
            return self.words[core] + self.words[word[len(core) :]]
        parts = _PARTS.findall(word)
        return self._part(word) if parts == [word] else b"".join(map(self.words.__getitem__, parts))

    def many(self, texts: list[str]) -> list[bytes]:
        """The ids of each text as little-endian 32-bit numbers."""
        self.words.turn()
        get, out = self.words.__getitem__, []
        for x in texts:
            if "<|" not in x and not _NOT_PLAIN.search(x):
                # Lower case and white space at a pre-token's end change no id, and leave fewer different words.
                out.append(b"".join(map(get, _MARK.sub(r" \1", x.lower()).split())))
            elif self.whole.search(x):
                out.append(np.array(self.tokenizer.encode(x, add_special_tokens=False).ids, "<u4").tobytes())
            else:
                out.append(b"".join(map(get, x.split())))
        return out


_encoders: dict[str, WordEncoder] = {}


def _encoder(path: str) -> WordEncoder:
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


def open_folder(uri: str) -> tuple[pafs.FileSystem, str]:
    """The file system and path of a folder given as a path or as a URI (file, hdfs, s3, gs, abfss)."""
    if "://" not in uri and not uri.startswith("file:"):
        return pafs.LocalFileSystem(), uri
    if uri.startswith("file:"):
        return pafs.LocalFileSystem(), re.sub("^file:/*", "/", uri)
    return pafs.FileSystem.from_uri(uri)


def qualified(spark: SparkSession, folder: str) -> str:
    """The folder as a URI: a path without a scheme is on the session's default file system, as for Spark's own writers."""
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).makeQualified(path).toString()


def _remove_unfinished(folder: str) -> None:
    """Remove what failed or lost attempts of tasks left: files that were never given their name."""
    fs, root = open_folder(folder)
    for info in fs.get_file_info(pafs.FileSelector(root, allow_not_found=True)):
        if info.base_name.startswith(".part-"):
            fs.delete_file(info.path)


class FrameWriter:
    """Writes documents to a binary stream in this format."""

    def __init__(self, out, frame_ids: int = FRAME_IDS, level: int = LEVEL):
        self.out, self.frame_ids = out, frame_ids
        self.packer = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.pending: list[tuple[int, bytes]] = []
        self.size = self.docs = self.ids = 0
        self.frames: list[tuple[int, int, int]] = []
        self.index: list[tuple[int, int, int, int]] = []

    def add(self, doc_id: int, ids: bytes) -> None:
        self.pending.append((doc_id, ids))
        self.size += len(ids) // 4
        if self.size >= self.frame_ids:
            self.flush()

    def flush(self) -> None:
        if not self.pending:
            return
        names = np.array([d for d, _ in self.pending], "<i8")
        lengths = np.array([len(x) // 4 for _, x in self.pending], "<u8")
        raw = struct.pack("<I", len(names)) + names.tobytes() + lengths.tobytes() + b"".join(x for _, x in self.pending)
        packed = self.packer.compress(raw)
        self.out.write(packed)
        self.frames.append((len(packed), len(raw), xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF))
        self.index.append((self.docs, len(names), int(names.min()), int(names.max())))
        self.docs += len(names)
        self.ids += self.size
        self.pending.clear()
        self.size = 0

    def close(self) -> None:
        self.flush()
        index = b"".join(struct.pack("<QQqq", *x) for x in self.index)
        table = b"".join(struct.pack("<III", *x) for x in self.frames) + struct.pack("<IBI", len(self.frames), 0x80, _SEEK_END)
        self.out.write(struct.pack("<II", _INDEX_MAGIC, len(index)) + index)
        self.out.write(struct.pack("<II", _SEEK_MAGIC, len(table)) + table)


class FrameReader:
    """Reads documents back; only frames asked for are read and decompressed."""

    def __init__(self, source: pa.NativeFile):
        self.source = source
        size = source.size()
        n, descriptor, magic = struct.unpack("<IBI", self._at(size - 9, 9))
        if magic != _SEEK_END or descriptor != 0x80:
            raise ValueError("no seek table at the end of the file")
        table = 12 * n + 9
        start = size - table - 8
        if struct.unpack("<II", self._at(start, 8)) != (_SEEK_MAGIC, table):
            raise ValueError("damaged seek table")
        self.frames = list(struct.iter_unpack("<III", self._at(start + 8, 12 * n)))
        at = start - 32 * n - 8
        if struct.unpack("<II", self._at(at, 8)) != (_INDEX_MAGIC, 32 * n):
            raise ValueError("damaged document index")
        self.index = list(struct.iter_unpack("<QQqq", self._at(at + 8, 32 * n)))
        self.offsets = np.cumsum([0, *(f[0] for f in self.frames)]).tolist()

    def _at(self, offset: int, n: int) -> bytes:
        self.source.seek(offset)
        return self.source.read(n)

    def frame(self, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """doc_ids, lengths and ids of frame k, verified."""
        packed, size, check = self.frames[k]
        raw = zstandard.ZstdDecompressor().decompress(self._at(self.offsets[k], packed), max_output_size=size)
        if len(raw) != size or xxhash.xxh64_intdigest(raw) & 0xFFFFFFFF != check:
            raise ValueError(f"frame {k} is damaged")
        (n,) = struct.unpack_from("<I", raw)
        return np.frombuffer(raw, "<i8", n, 4), np.frombuffer(raw, "<u8", n, 4 + 8 * n), np.frombuffer(raw, "<u4", -1, 4 + 16 * n)

    def documents(self, doc_ids: set[int]) -> Iterator[tuple[int, np.ndarray]]:
        """The ids of some documents."""
        for k, (_, _, low, high) in enumerate(self.index):
            if any(low <= d <= high for d in doc_ids):
                names, lengths, ids = self.frame(k)
                ends = np.cumsum(lengths).astype(np.int64)
                for d, a, b in zip(names.tolist(), ends - lengths.astype(np.int64), ends):
                    if d in doc_ids:
                        yield d, ids[a:b]


MANIFEST_SCHEMA = "part int, file string, docs long, ids long, frames int"


def _write_part(folder: str, path: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        encoder, fs, root = _encoder(path), *open_folder(folder)
        end = np.array([END_ID], "<u4").tobytes()
        writer = temporary = stream = None
        for names, texts in common.chunked(batches, 2 << 20):
            if writer is None:
                fs.create_dir(root, recursive=True)
                temporary = f"{root}/.part-{part:06d}-{uuid.uuid4().hex}"
                stream = fs.open_output_stream(temporary)
                writer = FrameWriter(stream)
            for d, ids in zip(names.to_pylist(), encoder.many([x.decode("utf-8", "replace") for x in texts])):
                writer.add(NULL_ID if d is None else d, ids + end)
        if writer is not None:
            writer.close()
            stream.close()
            name = f"part-{part:06d}.zst"
            fs.move(temporary, f"{root}/{name}")
            values = [[part], [name], [writer.docs], [writer.ids], [len(writer.frames)]]
            kinds = [pa.int32(), pa.string(), pa.int64(), pa.int64(), pa.int32()]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["part", "file", "docs", "ids", "frames"])

    return run


def write(docs: DataFrame, folder: str, path: str) -> DataFrame:
    """Encode documents, write them in ascending doc_id order, return the manifest: a row per file."""
    folder = qualified(docs.sparkSession, folder)
    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    # Rows of one doc_id, or of none, are dealt over ranges by their texts, and equal rows by where they were read.
    order = ["doc_id", "hash", "row"]
    keyed = source.select("doc_id", "text", F.xxhash64("text").alias("hash"), F.monotonically_increasing_id().alias("row"))
    ordered = keyed.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    manifest = ordered.mapInArrow(_write_part(folder, path), MANIFEST_SCHEMA)
    manifest.write.parquet(f"{folder.rstrip('/')}/manifest")
    _remove_unfinished(folder)
    return docs.sparkSession.read.schema(MANIFEST_SCHEMA).parquet(f"{folder.rstrip('/')}/manifest")


def read(spark: SparkSession, folder: str, manifest: DataFrame) -> DataFrame:
    """doc_id, start (ids of all documents before it), n_tokens and ids_crc32 per document, from the files."""
    folder = qualified(spark, folder)
    files = sorted(manifest.collect(), key=lambda r: r["part"])  # a row per file
    starts = np.cumsum([0, *(r["ids"] for r in files)]).tolist()
    rows = [(r["file"], int(s), k) for r, s in zip(files, starts) for k in [r["frames"]]]
    todo = spark.createDataFrame(rows, "file string, start long, frames int").repartition(max(1, len(rows)), "file")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        fs, root = open_folder(folder)
        for batch in batches:
            for row in batch.to_pylist():
                with fs.open_input_file(f"{root}/{row['file']}") as source:
                    reader, at = FrameReader(source), row["start"]
                    for k in range(len(reader.frames)):
                        names, lengths, ids = reader.frame(k)
                        ends = np.cumsum(lengths.astype(np.int64))
                        begins = ends - lengths.astype(np.int64)
                        raw = ids.tobytes()
                        check = [zlib.crc32(raw[4 * a : 4 * b]) for a, b in zip(begins.tolist(), ends.tolist())]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array(names, pa.int64(), mask=names == NULL_ID), pa.array(begins + at), pa.array(lengths.astype(np.int64)), pa.array(check, pa.int64())],
                            ["doc_id", "start", "n_tokens", "ids_crc32"],
                        )
                        at += int(ends[-1])

    return todo.mapInArrow(run, "doc_id long, start long, n_tokens long, ids_crc32 long")


def op7_token_frames(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """Write all documents' ids to files in the shared folder and read them back."""
    docs = common.documents(spark, sf_dir)
    folder = common.scratch_path(spark, "token-frames")
    return read(spark, folder, write(docs, folder, path or tokenizer_path()))
