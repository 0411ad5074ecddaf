"""BPE encoding and decoding by tree concatenation, equal to the tokenizers library.

A long text is cut in leaves of ``LEAF`` characters wherever they end, as halves of halves;
Spark encodes the leaves in parallel tasks, and neighbours are joined pairwise up the tree. A join
re-encodes a window around the cut and doubles it on both sides until both sides agree exactly:

* on the left, the window's encoding and the left half's must have a common *boundary* and the
  left half's tokens up to it; on the right, a common boundary and the right half's tokens after it.
* A boundary is a place where an ASCII white space follows a character that is not white space:
  the pre-tokenizer always cuts there, whatever stands before and behind, so tokens on its two
  sides are independent. Windows grow until they hold one on either side, or all of a half.
* Inside an unsplit run of letters there is none. There the window's first and last token must
  equal those of the halves: BPE tokens are the encoding of a run if every neighbouring pair is the
  encoding of its own characters, and then all pairs are pairs of one of the three encodings.

Leaves and short texts are encoded word by word, with its leading white space, with a bounded cache of
the library's own results; a text with other white space than ASCII goes to the library whole. Special tokens (here ``<|endoftext|>``) are cut out first, as the library does.

Decoding joins the byte strings of the ids and replaces invalid UTF-8, as the library's decoder does.

Defined results: a null text is encoded as an empty text; extra columns are ignored; repeated rows
have equal results; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
import os
import re
from array import array
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm import common

LEAF = 8192
#: Longer texts are encoded by their leaves in parallel tasks; shorter ones by one task each.
LONG = 4 * LEAF
#: Characters on either side of a join's first window.
REACH = 64
CACHE = 150_000

_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
_WORD = re.compile(r"[ \t-\r]*[^ \t-\r]+|[ \t-\r]+")
_BOUNDARY = re.compile(r"(?<=[^ \t-\r])(?=[ \t-\r])")
#: Beyond the Latin letters, whose classes no version of Unicode changes.
_BEYOND = re.compile("[^\\x00-\u024f]")
_LETTERS = regex.compile(r"\p{L}+")


def tokenizer_path(name: str = "byte_bpe_50k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> dict[str, int]:
    """The printable character of each byte in byte-level vocabularies, reversed."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + k): b for k, b in enumerate(rest)}


class Codec:
    """A byte-level BPE tokenizer file of the tokenizers library."""

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        special = self.tokenizer.get_added_tokens_decoder()
        self.special = {t.content: k for k, t in special.items()}
        self.special_pattern = re.compile("|".join(map(re.escape, sorted(self.special, key=len, reverse=True)))) if special else None
        alphabet = byte_alphabet()
        size = self.tokenizer.get_vocab_size()
        self.bytes = [b""] * size
        for token, k in self.tokenizer.get_vocab().items():
            self.bytes[k] = token.encode() if any(c not in alphabet for c in token) else bytes(alphabet[c] for c in token)
        self.decimal = [str(k) for k in range(size)]
        self.letters = {b: c for c, b in alphabet.items()}
        self.words = common.Lookup(CACHE, self._word)

    def plain(self, text: str) -> np.ndarray:
        """The library's own encoding of a text."""
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)

    def many(self, texts: list[str]) -> list[np.ndarray]:
        """Encodings of texts, word by word through the cache."""
        self.words.turn()
        get, out = self.words.__getitem__, []
        for x in texts:
            ok = x.isascii() and not any(c in x for c in "\x1c\x1d\x1e\x1f") or not _ODD_SPACE.search(x)
            out.append(np.frombuffer(b"".join(map(get, _WORD.findall(x))), np.uint32) if ok else self.plain(x))
        return out

    def _run(self, part: str) -> bytes:
        """The ids of one pre-token, from the library's BPE model."""
        mapped = "".join(map(self.letters.__getitem__, part.encode()))
        return array("I", [t.id for t in self.tokenizer.model.tokenize(mapped)]).tobytes()

    def _word(self, word: str) -> bytes:
        """The ids of a word with its leading white space.

        A space, or a line end as a pre-token of its own, before Latin letters and closing marks is cut here; all
        other words go through the library's whole pipeline.
        """
        first = word[0]
        rest = word[1:] if first in " \n" else word
        core = rest if rest.isalpha() else rest.rstrip(".,;:!?")
        if core.isalpha() and (core.isascii() or not _BEYOND.search(core)):
            head = self._run("\n") + self._run(core) if first == "\n" else self._run(" " + core if first == " " else core)
            return head + self._run(rest[len(core) :]) if len(core) < len(rest) else head
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def decode_bytes(self, ids: np.ndarray) -> bytes:
        return b"".join(map(self.bytes.__getitem__, ids.tolist()))

    def decode(self, ids: np.ndarray) -> str:
        return self.decode_bytes(ids).decode("utf-8", "replace")

    def digest(self, ids: np.ndarray) -> str:
        return hashlib.sha256(",".join(map(self.decimal.__getitem__, ids.tolist())).encode()).hexdigest()

    # Joining

    def join(self, left: tuple[str, np.ndarray], right: tuple[str, np.ndarray]) -> tuple[str, np.ndarray]:
        """The encoding of two neighbouring texts' concatenation."""
        a, b = left[0], right[0]
        whole = a + b
        if not a or not b:
            return whole, np.concatenate([left[1], right[1]])
        odd = _ODD_SPACE.search(a[-1:]) or _ODD_SPACE.search(b[:1])
        reach = REACH
        while True:
            lo, hi = max(0, len(a) - reach), min(len(b), reach)
            if (lo == 0 and hi == len(b)) or odd:
                return whole, self.many([whole])[0]
            window = a[lo:] + b[:hi]
            for agree in (self._agree_at_boundaries, self._agree_inside_letters):
                done = agree(left, right, lo, hi, window)
                if done is not None:
                    return whole, done
            reach *= 2

    def _agree_at_boundaries(self, left, right, lo: int, hi: int, window: str) -> np.ndarray | None:
        a, b = left[0], right[0]
        if _ODD_SPACE.search(window):
            return None
        cut = len(a) - lo
        start = 0 if lo == 0 else next((m.start() for m in _BOUNDARY.finditer(window, 0, cut) if m.start() < cut), None)
        ends = [m.start() for m in _BOUNDARY.finditer(window) if m.start() > cut]
        end = len(window) if hi == len(b) else ends[-1] if ends else None
        if start is None or end is None:
            return None
        # The halves' tokens outside [start, end) are fixed by the boundaries; check that they are whole tokens there.
        head = self._prefix(left[1], len(a[lo + start :].encode("utf-8", "surrogatepass")), from_end=True)
        tail = self._prefix(right[1], len(b[: end - cut].encode("utf-8", "surrogatepass")), from_end=False)
        if head is None or tail is None:
            return None
        return np.concatenate([left[1][:head], self.many([window[start:end]])[0], right[1][tail:]])

    def _agree_inside_letters(self, left, right, lo: int, hi: int, window: str) -> np.ndarray | None:
        """Windows inside one run of letters that reaches beyond both of its ends."""
        a, b = left[0], right[0]
        # A margin of letters on both sides keeps contractions and leading spaces out of reach.
        if lo < 4 or hi > len(b) - 4 or not _LETTERS.fullmatch(a[lo - 4 : lo] + window + b[hi : hi + 4]):
            return None
        k, head = 0, len(left[1])
        while head and k < len(a[lo:].encode()):
            head -= 1
            k += len(self.bytes[left[1][head]])
        m, tail = 0, 0
        while tail < len(right[1]) and m < len(b[:hi].encode()):
            m += len(self.bytes[right[1][tail]])
            tail += 1
        if not head or tail == len(right[1]):
            return None
        raw = self.decode_bytes(left[1][head:]) + self.decode_bytes(right[1][:tail])
        middle = np.array([t.id for t in self.tokenizer.model.tokenize("".join(map(self.letters.__getitem__, raw)))], np.uint32)
        if len(middle) < 3 or middle[0] != left[1][head] or middle[-1] != right[1][tail - 1]:
            return None
        return np.concatenate([left[1][:head], middle, right[1][tail:]])

    def _prefix(self, ids: np.ndarray, size: int, from_end: bool) -> int | None:
        """How many ids hold the first (or all but the last) ``size`` bytes, if a token ends there."""
        step, at = (-1, len(ids)) if from_end else (1, 0)
        while size > 0:
            at += step
            size -= len(self.bytes[ids[at if from_end else at - 1]])
        return at if size == 0 else None

    def tree(self, leaves: list[str]) -> np.ndarray:
        """Encode leaves and join them pairwise, level by level."""
        return self.joined(leaves, self.many(leaves))

    def joined(self, leaves: list[str], coded: list[np.ndarray]) -> np.ndarray:
        level = list(zip(leaves, coded))
        while len(level) > 1:
            pairs = [self.join(x, y) for x, y in zip(level[::2], level[1::2])]
            level = pairs + level[len(pairs) * 2 :]
        return level[0][1] if level else np.empty(0, np.uint32)

    def pieces(self, text: str, leaf: int = LEAF) -> list[tuple[int, str]]:
        """(segment, leaf text): special tokens are segments of their own, other segments are cut in leaves."""
        out, segment, last = [], 0, 0
        for m in [*(self.special_pattern.finditer(text) if self.special_pattern else ()), None]:
            part = text[last : m.start() if m else len(text)]
            out += [(segment, part[k : k + leaf]) for k in range(0, len(part), leaf)]
            if m:
                out.append((segment + 1, m.group()))
                segment, last = segment + 2, m.end()
        return out

    def assemble(self, pieces: list[tuple[int, str]], coded: list[np.ndarray]) -> np.ndarray:
        """The ids of a text from the encodings of its pieces."""
        out, k = [], 0
        while k < len(pieces):
            n = k
            while n < len(pieces) and pieces[n][0] == pieces[k][0]:
                n += 1
            if pieces[k][0] % 2:
                out.append(np.array([self.special[pieces[k][1]]], np.uint32))
            else:
                out.append(self.joined([p[1] for p in pieces[k:n]], coded[k:n]))
            k = n
        return np.concatenate(out) if out else np.empty(0, np.uint32)

    def encode(self, text: str, leaf: int = LEAF) -> np.ndarray:
        pieces = self.pieces(text, leaf)
        return self.assemble(pieces, self.many([p for _, p in pieces]))


_codecs: dict[str, Codec] = {}


def codec(path: str) -> Codec:
    """One codec per worker process."""
    if path not in _codecs:
        _codecs[path] = Codec(path)
    return _codecs[path]


def _text_chunks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.Array, list[str]]]:
    for ids, texts in common.chunked(batches, 2 << 20):
        yield ids, [x.decode("utf-8", "replace") for x in texts]


def encode(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and ids (array<int>) of every document: the general interface."""
    return _encoded(docs, path, "ids array<int>", lambda c, ids: (ids.tolist(),), [pa.list_(pa.int32())])


def _summary(c: Codec, ids: np.ndarray) -> tuple:
    decoded = c.decode(ids)
    return len(ids), c.digest(ids), hashlib.sha256(decoded.encode()).hexdigest(), decoded


def _encoded(docs: DataFrame, path: str, schema: str, result: Callable, kinds: list, decoded_of: DataFrame | None = None) -> DataFrame:
    names = [x.split()[0] for x in schema.split(", ")]

    def batch(ids: pa.Array, name: str, found: list[tuple]) -> pa.RecordBatch:
        columns = list(zip(*found)) if found else [[] for _ in kinds]
        return pa.RecordBatch.from_arrays([ids, *(pa.array(v, k) for v, k in zip(columns, kinds))], [name, *names])

    def short(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for ids, texts in _text_chunks(batches):
            pieces = [c.pieces(x) for x in texts]
            coded = iter(c.many([p for x in pieces for _, p in x]))
            yield batch(ids, "doc_id", [result(c, c.assemble(x, [next(coded) for _ in x])) for x in pieces])

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for ids, texts in _text_chunks(batches):
            rows = [(d, k, s, p) for d, x in zip(ids.to_pylist(), texts) for k, (s, p) in enumerate(c.pieces(x))]
            yield pa.RecordBatch.from_pydict(dict(zip(("text_id", "piece", "segment", "leaf"), map(list, zip(*rows)))))

    def leaves(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(path)
        for b in batches:
            found = [x.tobytes() for x in c.many(b.column("leaf").to_pylist())]
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(found, pa.binary())], [*b.schema.names, "coded"])

    def whole(table: pa.Table) -> pa.Table:
        c = codec(path)
        rows = sorted(table.to_pylist(), key=lambda r: r["piece"])
        ids = c.assemble([(r["segment"], r["leaf"]) for r in rows], [np.frombuffer(r["coded"], np.uint32) for r in rows])
        return pa.Table.from_batches([batch(pa.array([rows[0]["text_id"]], pa.string()), "text_id", [result(c, ids)])])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    few = source.where(F.length("text") < LONG).mapInArrow(short, f"doc_id long, {schema}")
    # Long texts: every different text once, its leaves in parallel tasks, then one tree per text.
    many = source.where(F.length("text") >= LONG).withColumn("text_id", F.sha2("text", 256))
    many = many.select("doc_id", "text_id", "text")
    pieces = (
        many.groupBy("text_id").agg(F.first("text").alias("text")).select("text_id", "text")
        .mapInArrow(cut, "text_id string, piece long, segment long, leaf string")
        .repartition("text_id", "piece")
        .mapInArrow(leaves, "text_id string, piece long, segment long, leaf string, coded binary")
    )
    trees = pieces.groupBy("text_id").applyInArrow(whole, f"text_id string, {schema}")
    long_ones = many.select("doc_id", "text_id").join(trees, "text_id").select("doc_id", *names)
    return few.unionByName(long_ones)


def op5_bpe_tree_concatenation(spark, sf_dir: str, path: str | None = None) -> DataFrame:
    """Digests of the ids and of the decoded text of every document."""
    schema = "n_tokens long, ids_sha256 string, decoded_sha256 string"
    return _encoded(
        common.documents(spark, sf_dir), path or tokenizer_path(), schema,
        lambda c, ids: _summary(c, ids)[:3], [pa.int64(), pa.string(), pa.string()],
    )


def round_trip(docs: DataFrame, path: str) -> DataFrame:
    """doc_id and decoded text of every document, after encoding it."""
    return _encoded(docs, path, "decoded string", lambda c, ids: (c.decode(ids),), [pa.string()])


def encoded_with_digests(docs: DataFrame, path: str) -> DataFrame:
    """doc_id, n_tokens, ids, ids_sha256 and decoded_sha256 of every document."""
    return _encoded(
        docs, path, "n_tokens long, ids array<int>, ids_sha256 string, decoded_sha256 string",
        lambda c, ids: (len(ids), ids.astype(np.int32), *_summary(c, ids)[1:3]),
        [pa.int64(), pa.list_(pa.int32()), pa.string(), pa.string()],
    )
