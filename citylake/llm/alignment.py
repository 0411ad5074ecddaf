"""Cross-tokenizer alignment by pointer jumping.

A byte-level BPE vocabulary (A) encodes space + text, a piece vocabulary (B) encodes text and adds the space itself;
both give byte ranges of the same bytes. Tokens that overlap, directly or through others, form a group.

1. *Tokens.* Both libraries encode a text word by word: before a space or a line end that follows a character
   which is no white space, A's pre-tokenizer always cuts, and no piece of B reaches over (checked when the
   vocabularies are loaded; otherwise texts are encoded whole). Words' ids are kept in a bounded cache; words it
   does not have are encoded ``TOGETHER`` at a time, one behind another, and cut where they meet.
2. *Pointers.* Every token of either side points to its farthest-right overlapping token, which is the token of the
   other side that holds its last byte (itself, if none ends further right).
3. *Jumping.* The pointers of all tokens of some hundred documents are doubled together, ``p = p[p]``, until nothing
   changes: after log2 of the longest chain each token points to its component's terminal token, which labels its group. A
   terminal ends where a token of the other side ends: the only pair of its group that is linked.
4. *Counts.* Links are written per document as numbers (A id, B id). Their corpus-wide counts are added up per task, then
   per pair. The most frequent pairs, ``FREQUENT`` at most, go to all tasks (a table of bounded size); the other pairs of each
   document meet their counts in a join, in which therefore no pair is hot.

Texts that are null, empty or whose tokens do not give the bytes of space + text on both sides have no tokens.
Special tokens' strings in texts are plain text.

Defined results: documents without tokens have zeros and an empty groups_sha256; a null doc_id is reported as null;
repeated rows are documents of their own (each counts); extra columns are ignored; an empty table gives an empty
result.
"""

from __future__ import annotations

import hashlib
import os
import re
from collections.abc import Iterable, Iterator
from itertools import chain, repeat
from operator import itemgetter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm import common
from citylake.llm.bpe import byte_alphabet

#: Pairs whose counts are sent to all tasks (17 bytes each).
FREQUENT = 1 << 18
#: Distinct pairs that a task adds up before it passes them on.
HELD = 1 << 21
CACHE = 200_000
#: New words that are encoded in one call.
TOGETHER = 256

#: White space and format characters beyond ASCII white space: such texts are encoded whole.
_ODD_SPACE = re.compile("[\x1c-\x1f\x85\xa0\u1680\u180e\u2000-\u200f\u2028-\u202f\u205f-\u2064\u3000\ufeff]")
#: Words with the white space before them; a new one begins with a space or a line end behind a visible character.
_UNIT = re.compile(r"[ \t-\r]*[^ \t-\r]+(?:[\t\x0b-\r][ \t-\r]*[^ \t-\r]+)*(?:[\t\x0b-\r][ \t-\r]*\Z)?|[ \t-\r]+")
_WHITE = frozenset(" \t\n\x0b\x0c\r")
_LOW = np.uint64(32)


def tokenizer_paths() -> tuple[str, str]:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")


def terminals(a_ends: np.ndarray, b_ends: np.ndarray) -> np.ndarray:
    """The terminal of each token, A's tokens first, then B's, as positions in that order.

    The ends of each side rise strictly and have the same last value (several texts are laid one behind another).
    """
    n = len(a_ends)
    pointer = np.empty(n + len(b_ends), np.int64)
    # The token of the other side that holds the last byte: the first one that does not end before it.
    pointer[:n] = n + np.searchsorted(b_ends, a_ends, "left")
    other = np.searchsorted(a_ends, b_ends, "left")
    itself = a_ends[other] == b_ends if n else np.empty(0, bool)
    pointer[n:] = np.where(itself, np.arange(n, len(pointer)), other)
    while True:
        jumped = pointer[pointer]
        if np.array_equal(jumped, pointer):
            return pointer
        pointer = jumped


class Pair:
    """Two tokenizer files, encoding words to (A ids, A lengths, B ids, B lengths)."""

    def __init__(self, byte_path: str, piece_path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import sentencepiece
        from tokenizers import Tokenizer

        self.a = Tokenizer.from_file(byte_path)
        self.a.no_truncation()
        self.a.no_padding()
        self.a.encode_special_tokens = True
        alphabet = byte_alphabet()
        self.a_bytes = [b""] * self.a.get_vocab_size()
        for token, k in self.a.get_vocab().items():
            self.a_bytes[k] = bytes(alphabet[c] for c in token) if all(c in alphabet for c in token) else token.encode()
        self.b = sentencepiece.SentencePieceProcessor(model_file=piece_path)
        pieces = [self.b.id_to_piece(k) for k in range(self.b.vocab_size())]
        raw = [bytes([int(p[3:5], 16)]) if self.b.is_byte(k) else p.replace("▁", " ").encode() for k, p in enumerate(pieces)]
        self.b_bytes = raw
        self.blank = self.b.piece_to_id("▁")
        # No piece may hold a space behind another character, or a line end.
        self.by_word = not any(" " in x.lstrip(b" ").decode("utf-8", "replace") or b"\n" in x and len(x) > 1 for x in raw)
        self.a_length = np.array([len(x) for x in self.a_bytes], np.int64)
        self.b_length = np.array([len(x) for x in raw], np.int64)
        self.words = common.Lookup(CACHE, self._word)
        self.wide = max(len(self.a_bytes), len(raw)) > 1 << 16
        self.kind = np.uint32 if self.wide else np.uint16
        # Decimal ids with the mark that follows them: inside a side or at its end.
        self.written = [f"{k}{m}" for k in range(len(self.a_bytes)) for m in ",|"] + [f"{k}{m}" for k in range(len(raw)) for m in ",;"]

    def _b_ids(self, unit: str) -> list[int]:
        """B's ids of space + text, or of a unit that begins with a line end."""
        if unit[0] == " ":
            return self.b.encode(unit[1:], num_threads=1) if len(unit) > 1 else [self.blank]
        ids = self.b.encode(unit, num_threads=1)
        return ids[1:] if ids[0] == self.blank else []  # the space that B adds

    def _word(self, unit: str) -> tuple[bytes, bytes, bool]:
        a = self.a.encode(unit, add_special_tokens=False).ids
        b = self._b_ids(unit)
        raw = unit.encode()
        equal = b"".join(map(self.a_bytes.__getitem__, a)) == raw == b"".join(map(self.b_bytes.__getitem__, b))
        return np.array(a, self.kind).tobytes(), np.array(b, self.kind).tobytes(), equal

    def _cut(self, ids: list[int], length: np.ndarray, vocabulary: list[bytes], units: list[bytes]) -> list[bytes] | None:
        """The ids of each unit, or None if they do not give the units' bytes with a cut where units meet."""
        if b"".join(map(vocabulary.__getitem__, ids)) != b"".join(units):
            return None
        at = np.array(ids, np.int64)
        ends = np.cumsum(length[at])
        want = np.cumsum([len(x) for x in units])
        places = np.searchsorted(ends, want)
        if not np.array_equal(ends[places], want):
            return None
        raw, size = at.astype(self.kind).tobytes(), np.dtype(self.kind).itemsize
        bounds = [0, *((places + 1) * size).tolist()]
        return [raw[x:y] for x, y in zip(bounds, bounds[1:])]

    def learn(self, units: Iterable[str]) -> None:
        """Put the ids of new units into the cache, those that begin with a space and end visibly in few calls."""
        new = []
        for u in set(units).difference(self.words):
            if u in self.words.old or u[0] != " " or u[-1] in _WHITE:
                self.words[u]
            else:
                new.append(u)
        for k in range(0, len(new), TOGETHER):
            part = new[k : k + TOGETHER]
            joined, raw = "".join(part), [u.encode() for u in part]
            a = self._cut(self.a.encode(joined, add_special_tokens=False).ids, self.a_length, self.a_bytes, raw)
            b = a and self._cut(self._b_ids(joined), self.b_length, self.b_bytes, raw)
            if b:
                self.words.update(zip(part, zip(a, b, repeat(True))))
            else:  # some unit is not given back: each by itself
                for u in part:
                    self.words[u]

    def units(self, text: str) -> list[str] | None:
        """The words of space + text, or None if it has to be encoded whole."""
        return _UNIT.findall(" " + text) if text and self.by_word and not _ODD_SPACE.search(text) else None

    def tokens(self, text: str, units: list[str] | None = None) -> tuple[bytes, bytes] | None:
        """The ids of both sides, or None if they do not give the bytes of space + text."""
        if not text:
            return None
        units = units or self.units(text)
        if units:
            found = list(map(self.words.__getitem__, units))
            if all(map(itemgetter(2), found)):
                return b"".join(map(itemgetter(0), found)), b"".join(map(itemgetter(1), found))
        a, b, equal = self._word(" " + text)
        return (a, b) if equal else None

    def aligned(self, texts: list[str]) -> Iterator[tuple[int, int, int, str, bytes]]:
        """n_a, n_b, n_groups, digest of the groups and links (A id << 32 | B id) of each text."""
        self.words.turn()
        units = [self.units(x) for x in texts]
        self.learn(chain.from_iterable(u for u in units if u))
        found = [self.tokens(x, u) for x, u in zip(texts, units)]
        a = np.frombuffer(b"".join([x[0] for x in found if x]), self.kind).astype(np.int64)
        b = np.frombuffer(b"".join([x[1] for x in found if x]), self.kind).astype(np.int64)
        if not len(a):
            yield from ((0, 0, 0, "", b"") for _ in found)
            return
        label = terminals(np.cumsum(self.a_length[a]), np.cumsum(self.b_length[b]))
        # Terminals are B's tokens; the groups follow each other on both sides.
        ends = np.zeros(len(b) + 1, np.int64)
        ends[1:] = np.cumsum(label[len(a) :] == np.arange(len(a), len(a) + len(b)))
        b_group = ends[:-1]
        a_group = b_group[label[: len(a)] - len(a)]
        a_last = np.r_[a_group[1:] != a_group[:-1], True]
        b_last = np.r_[b_group[1:] != b_group[:-1], True]
        links = (a[a_last].astype(np.uint64) << _LOW) | b[b_last].astype(np.uint64)
        # The written form: each group's A ids, then its B ids.
        marks = np.empty(len(a) + len(b), np.int64)
        marks[np.arange(len(a)) + np.searchsorted(b_group, a_group, "left")] = 2 * a + a_last
        marks[np.arange(len(b)) + np.searchsorted(a_group, b_group, "right")] = 2 * len(self.a_bytes) + 2 * b + b_last
        size = np.dtype(self.kind).itemsize
        at_a = at_b = group = 0
        for x in found:
            if not x:
                yield 0, 0, 0, "", b""
                continue
            n_a, n_b = len(x[0]) // size, len(x[1]) // size
            n = int(a_group[at_a + n_a - 1]) + 1 - group
            form = "".join(map(self.written.__getitem__, marks[at_a + at_b : at_a + at_b + n_a + n_b].tolist()))
            yield n_a, n_b, n, hashlib.sha256(form[:-1].encode()).hexdigest(), links[group : group + n].tobytes()
            at_a, at_b, group = at_a + n_a, at_b + n_b, group + n


_pairs: dict[tuple[str, str], Pair] = {}


def pair(byte_path: str, piece_path: str) -> Pair:
    """One pair per worker process."""
    key = byte_path, piece_path
    if key not in _pairs:
        _pairs[key] = Pair(*key)
    return _pairs[key]


def _align(paths: tuple[str, str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair(*paths)
        for ids, texts in common.chunked(batches, 1 << 20):
            rows = list(p.aligned([x.decode("utf-8", "replace") for x in texts]))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary()]
            yield pa.RecordBatch.from_arrays([ids, *(pa.array(v, k) for v, k in zip(zip(*rows), kinds))], ["doc_id", "n_a", "n_b", "n_groups", "groups_sha256", "links"])

    return run


def _added(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Distinct links of a task's documents and how many hold each, in pieces of bounded size."""
    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    waiting: list[np.ndarray] = []
    size = 0

    def added() -> tuple[np.ndarray, np.ndarray]:
        every = np.concatenate([keys, *waiting])
        n = np.concatenate([counts, *(np.ones(len(x), np.int64) for x in waiting)])
        found, where = np.unique(every, return_inverse=True)
        return found, np.bincount(where, weights=n, minlength=len(found)).astype(np.int64)

    for batch in batches:
        for raw in batch.column("links"):
            waiting.append(np.frombuffer(raw.as_buffer() or b"", np.uint64))
            size += len(waiting[-1])
            if size >= HELD:
                keys, counts = added()
                waiting, size = [], 0
                if len(keys) >= HELD:
                    yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["pair", "n"])
                    keys, counts = np.empty(0, np.uint64), np.empty(0, np.int64)
    if len(keys) or size:
        keys, counts = added()
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts)], ["pair", "n"])


def _summed(frequent: pa.Table):
    """Per document: the sums over its frequent links; its other links, distinct, with their number."""
    order = np.argsort(frequent["pair"].to_numpy())
    keys, counts, best = (frequent[c].to_numpy()[order] for c in ("pair", "n", "best"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 64):
                part = batch.slice(at, 64)
                rows = part.column("row").to_numpy()
                raw = [x.as_buffer() or b"" for x in part.column("links")]
                lengths = np.array([len(x) // 8 for x in raw])
                links = np.frombuffer(b"".join(raw), np.int64)
                owner = np.repeat(np.arange(len(rows)), lengths)
                place = np.minimum(np.searchsorted(keys, links), max(len(keys) - 1, 0))
                known = keys[place] == links if len(keys) else np.zeros(len(links), bool)
                n = np.bincount(owner[known], weights=best[place[known]], minlength=len(rows)).astype(np.int64)
                total = np.zeros(len(rows), np.int64)
                np.add.at(total, owner[known], counts[place[known]])
                # Links beyond the frequent ones, once per document.
                by = np.lexsort((links[~known], owner[~known]))
                who, what = owner[~known][by], links[~known][by]
                first = np.flatnonzero(np.r_[True, (who[1:] != who[:-1]) | (what[1:] != what[:-1])]) if len(who) else np.empty(0, np.int64)
                times = np.diff(np.r_[first, len(who)])
                yield pa.RecordBatch.from_arrays(
                    [
                        pa.array(np.r_[rows, rows[who[first]]]),
                        pa.array([*[None] * len(rows), *what[first].tolist()], pa.int64()),
                        pa.array(np.r_[n, times]),
                        pa.array(np.r_[total, times]),
                    ],
                    ["row", "pair", "n_best", "count_sum"],
                )

    return run


def align(docs: DataFrame, paths: tuple[str, str] | None = None, frequent: int = FREQUENT) -> DataFrame:
    """doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum and groups_sha256 of every document."""
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    schema = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"
    found = texts.mapInArrow(_align(paths or tokenizer_paths()), schema)
    found = common.written(found.withColumn("row", F.monotonically_increasing_id()), "aligned")
    counts = counted(found)
    parts = common.written(found.select("row", "links").mapInArrow(_summed(most_frequent(counts, frequent)), "row long, pair long, n_best long, count_sum long"), "linked")
    met = parts.where("pair IS NOT NULL").join(counts, "pair").select(
        "row", F.when(F.col("best") == 1, F.col("n_best")).otherwise(0).alias("n_best"), (F.col("count_sum") * F.col("n")).alias("count_sum")
    )
    sums = met.unionByName(parts.where("pair IS NULL").drop("pair")).groupBy("row").agg(F.sum("n_best").alias("n_best"), F.sum("count_sum").alias("count_sum"))
    return found.drop("links").join(sums, "row").select(
        "doc_id", "n_a", "n_b", "n_groups", F.col("n_groups").alias("n_links"), "n_best", "count_sum", "groups_sha256"
    )


def counted(found: DataFrame) -> DataFrame:
    """pair, n (links corpus-wide that hold it) and best (1 if no pair of its B id has more) of every linked pair."""
    added = found.select("links").mapInArrow(_added, "pair long, n long")
    counts = common.written(added.groupBy("pair").agg(F.sum("n").alias("n")), "pairs")
    b = F.col("pair").bitwiseAND(F.lit(0xFFFFFFFF))
    # One row per B id: bounded by the vocabulary.
    top = common.written(counts.groupBy(b.alias("b")).agg(F.max("n").alias("most")), "best-pairs")
    return common.written(
        counts.join(F.broadcast(top), b == F.col("b")).select("pair", "n", (F.col("n") == F.col("most")).cast("int").alias("best")), "counted-pairs"
    )


def most_frequent(counts: DataFrame, frequent: int = FREQUENT) -> pa.Table:
    """The pairs with the highest counts, at most ``frequent``: those above some power of the fourth root of 2."""
    power = F.floor(4 * F.log2("n"))
    found = sorted(((r["power"], r["pairs"]) for r in counts.groupBy(power.alias("power")).agg(F.count(F.lit(1)).alias("pairs")).collect()), reverse=True)
    least, held = 1 << 30, 0
    for at, pairs in found:  # a row per power: some hundred at most
        held += pairs
        if held > frequent:
            break
        least = at
    return counts.where(power >= least).select("pair", "n", "best").toArrow()


def groups(docs: DataFrame, paths: tuple[str, str] | None = None) -> DataFrame:
    """doc_id, place, a_ids and b_ids of every group: the general interface."""
    paths = paths or tokenizer_paths()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        p = pair(*paths)
        for ids, texts in common.chunked(batches, 1 << 18):
            rows = []
            for doc, text in zip(ids.to_pylist(), texts):
                found = p.tokens(text.decode("utf-8", "replace"))
                if found:
                    a, b = (np.frombuffer(x, p.kind).astype(np.int64) for x in found)
                    label = terminals(np.cumsum(p.a_length[a]), np.cumsum(p.b_length[b]))
                    ends = np.unique(label)
                    cut = [np.searchsorted(ends, x) for x in (label[: len(a)], label[len(a) :])]
                    bounds = [np.searchsorted(c, np.arange(len(ends) + 1)) for c in cut]
                    rows += [
                        (doc, k, a[bounds[0][k] : bounds[0][k + 1]].tolist(), b[bounds[1][k] : bounds[1][k + 1]].tolist()) for k in range(len(ends))
                    ]
            kinds = [pa.int64(), pa.int64(), pa.list_(pa.int32()), pa.list_(pa.int32())]
            columns = list(zip(*rows)) if rows else [[]] * 4
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(columns, kinds)], ["doc_id", "place", "a_ids", "b_ids"])

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return texts.mapInArrow(run, "doc_id long, place long, a_ids array<int>, b_ids array<int>")


def op12_pointer_alignment(spark, sf_dir: str) -> DataFrame:
    """Alignment of the two vocabularies' tokens in every document."""
    return align(common.documents(spark, sf_dir))
