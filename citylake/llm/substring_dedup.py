"""Substring dedup with repeated-phrase automata.

A window is ``WINDOW`` consecutive words of one document. A word goes if some window
that covers it has a word sequence that also starts earlier (smaller doc_id, or earlier
in the same document). Three passes over written blocks of documents:

1. *Candidates.* Each window is named by its anchor, the smallest hash among its
   ``GRAM``-word runs; equal windows have equal anchors. A block sends its distinct anchor
   hashes, once each, to slices, which answer which of them occur at several places.
2. *Confirmation and automata.* Neighbouring windows with the same recurring anchor
   form a passage. An anchor with more than ``HOT_PLACES`` places (a line in a third of all
   documents, say, with other words around it each time) would bring all of these to one
   shard: its windows are passages of their own, dealt by their whole word sequence instead. A block sends each distinct passage once, with its words and its
   first place, to the anchor's shard. The shard confirms which windows recur, compiles
   them into an Aho-Corasick automaton over word numbers (so a match is an exact match of
   whole words, whatever the hashes say), streams all passages through it, and answers
   one bit per window: whether the first occurrence of all is the one given.
3. *Removal.* Each block marks the words of its later occurrences.

All state is per block, slice or shard; their numbers grow with the input and their sizes
do not: a passage that a third of all documents share is sent once per block.

Defined results: a null or empty text has no words and stays; texts shorter than the
window stay whole; rows with a null doc_id come before all others; among rows with the same
doc_id and the same start, one (any, but only one) counts as the first; extra columns are
ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.llm import common

WINDOW = 20
GRAM = 8
#: Longest run of windows in one passage; longer runs are cut, which changes no answer.
RUN = 32
#: Places from which on an anchor's windows are dealt one by one; either way gives the same answers.
HOT_PLACES = 2_000
#: Anchor hashes in a slice and passages in a shard, about.
SLICE_KEYS = 400_000
SHARD_PASSAGES = 4_000


def _slide(x: np.ndarray, n: int, op) -> np.ndarray:
    """op over each n consecutive values of x."""
    width = 1
    while width * 2 <= n:
        x = op(x[: len(x) - width], x[width:])
        width *= 2
    return op(x[: len(x) - (n - width)], x[n - width :]) if n > width else x


class _Anchored:
    """Words, windows and anchors of a block."""

    def __init__(self, block: common.Block):
        self.tokens = t = common.Tokens(block.texts)
        total = len(t.ids)
        self.n = max(0, total - WINDOW + 1)
        self.valid = np.zeros(self.n, bool)
        self.anchor = np.empty(0, np.uint64)
        self.chosen = np.empty(0, np.uint64)
        self._keys: tuple[np.ndarray, np.ndarray] | None = None
        if not self.n:
            return
        last = np.repeat(t.ends, t.lengths)[: self.n]
        self.valid = np.arange(self.n) + WINDOW <= last
        grams = common.gram_hash(t.hash, GRAM)
        span = WINDOW - GRAM + 1
        self.anchor = _slide(grams, span, np.minimum)
        # A place is chosen if its gram is the smallest of a valid window around it.
        reach = np.zeros(self.n + 2 * (span - 1), np.uint64)
        reach[span - 1 : span - 1 + self.n] = np.where(self.valid, self.anchor, np.uint64(0))
        self.chosen = grams[(_slide(reach, span, np.maximum) == grams) & (grams > 0)]

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """Distinct anchors, mixed and sorted; the number of places each has here."""
        if self._keys is None:
            self._keys = np.unique(common.mix(self.chosen), return_counts=True)
        return self._keys

    def passages(self, recurring: np.ndarray, hot: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """First window, number of windows and key of each run of windows with one recurring anchor."""
        mixed = common.mix(self.anchor)
        keys, _ = self.keys()
        at = np.minimum(np.searchsorted(keys, mixed), max(0, len(keys) - 1))
        idx = np.flatnonzero(self.valid & (recurring[at] & (keys[at] == mixed) if len(keys) else False))
        if not len(idx):
            return idx, idx, np.empty(0, np.uint64)
        new = np.ones(len(idx), bool)
        new[1:] = (np.diff(idx) != 1) | (mixed[idx[1:]] != mixed[idx[:-1]])
        alone = hot[at[idx]]
        if alone.any():
            new |= alone
            mixed[idx[alone]] = common.mix(common.gram_hash(self.tokens.hash, WINDOW)[idx[alone]])
        first = idx[new]
        since = idx - np.repeat(first, np.diff([*np.flatnonzero(new), len(idx)]))
        new |= since % RUN == 0
        first = idx[new]
        return first, np.diff([*np.flatnonzero(new), len(idx)]), mixed[first]


def _distinct(a: _Anchored, answers: tuple[np.ndarray, np.ndarray]):
    """Passages of a block: place, windows, key, number among the distinct ones; place of each distinct one's first."""
    first, n, key = a.passages(*answers)
    order = np.argsort(key, kind="stable")  # sorted by key, then by place
    first, n, key = first[order], n[order], key[order]
    raw, seen, number, heads = a.tokens.hash, {}, np.empty(len(first), np.int64), []
    for k, (b, e) in enumerate(zip(first.tolist(), (first + n + WINDOW - 1).tolist())):
        text = raw[b:e].tobytes()
        at = seen.setdefault(text, len(heads))
        if at == len(heads):
            heads.append(k)
        number[k] = at
    return first, n, key, number, np.array(heads, np.int64)


KEYS_SCHEMA = "slice long, block long, keys binary, places binary"
FOUND_SCHEMA = "slice long, block long, found binary, hot binary"
PASSAGES_SCHEMA = "shard long, block long, texts binary, lengths binary, doc_ids binary, starts binary"
FIRST_SCHEMA = "shard long, block long, first binary"


def _send_keys(slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in common.block_rows(batches):
            block = common.Block(row)
            keys, places = _Anchored(block).keys()
            parts = common.scattered(keys, slices)
            if parts:
                yield pa.RecordBatch.from_pydict({
                    "slice": [s for s, _ in parts],
                    "block": [block.block] * len(parts),
                    "keys": [keys[r].tobytes() for _, r in parts],
                    "places": [np.minimum(places[r], 0xFFFF).astype(np.uint16).tobytes() for _, r in parts],
                })

    return run


def _recurring(hot_places: int):
    def run(table: pa.Table) -> pa.Table:
        """Which anchors of a slice occur at several, and which at very many places of the corpus."""
        parts = [np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()]
        places = np.frombuffer(b"".join(table["places"].to_pylist()), np.uint16).astype(np.float64)
        _, inverse = np.unique(np.concatenate(parts), return_inverse=True)
        total = np.bincount(inverse, places)[inverse]
        found, hot, at = [], [], 0
        for p in parts:
            here = total[at : at + len(p)]
            found.append(np.packbits(here > 1).tobytes())
            hot.append(np.packbits(here > hot_places).tobytes())
            at += len(p)
        answers = [pa.array(x, pa.binary()) for x in (found, hot)]
        return pa.table({"slice": table["slice"], "block": table["block"], "found": answers[0], "hot": answers[1]})

    return run


def _answers(keys: np.ndarray, slices: int, parts: list[dict] | None) -> tuple[np.ndarray, np.ndarray]:
    """Whether a block's anchors recur, and whether they are hot, in the order of its keys."""
    answer = {p["slice"]: p for p in parts or []}
    out: tuple[list, list] = ([], [])
    for s, r in common.scattered(keys, slices):
        for bits, name in zip(out, ("found", "hot")):
            bits.append(np.unpackbits(np.frombuffer(answer[s][name], np.uint8), count=r.stop - r.start))
    found, hot = (np.concatenate(x).astype(bool) if x else np.empty(0, bool) for x in out)
    return found, hot


def _send_passages(slices: int, shards: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for row in common.block_rows(batches):
            block = common.Block(row)
            a = _Anchored(block)
            if not a.n:
                continue
            first, n, key, _, heads = _distinct(a, _answers(a.keys()[0], slices, row["parts"]))
            if not len(heads):
                continue
            t = a.tokens
            doc = np.searchsorted(t.ends, first[heads], side="right")
            starts = first[heads] - t.starts[doc]
            every = [w for ws in t.lists for w in ws]
            out: dict[str, list] = {k: [] for k in ("shard", "block", "texts", "lengths", "doc_ids", "starts")}
            for shard, r in common.scattered(key[heads], shards):
                lines = b"\n".join(b" ".join(every[b : b + m + WINDOW - 1]) for b, m in zip(first[heads[r]].tolist(), n[heads[r]].tolist()))
                out["shard"].append(shard)
                out["block"].append(block.block)
                out["texts"].append(packer.compress(lines))
                out["lengths"].append(n[heads[r]].astype(np.int32).tobytes())
                out["doc_ids"].append(block.doc_ids[doc[r]].tobytes())
                out["starts"].append(starts[r].astype(np.int64).tobytes())
            yield pa.RecordBatch.from_pydict(out)

    return run


def _automaton(table: pa.Table) -> pa.Table:
    """One shard: confirm the windows that recur, compile them, find all their occurrences, mark the first."""
    unpack = zstandard.ZstdDecompressor()
    lines, sizes = [], []
    for x in table["texts"].to_pylist():
        part = unpack.decompress(x, max_output_size=1 << 31).split(b"\n")
        lines += part
        sizes.append(len(part))
    windows = np.concatenate([np.frombuffer(x, np.int32) for x in table["lengths"].to_pylist()]).astype(np.int64)
    docs = np.concatenate([np.frombuffer(x, np.int64) for x in table["doc_ids"].to_pylist()])
    starts = np.concatenate([np.frombuffer(x, np.int64) for x in table["starts"].to_pylist()])

    distinct: dict[bytes, int] = {}
    which = np.fromiter((distinct.setdefault(x, len(distinct)) for x in lines), np.int64, len(lines))
    copies = np.bincount(which)
    t = common.Tokens(list(distinct))
    places = t.lengths - WINDOW + 1
    # Confirm: windows whose words occur in several passages, or in a passage with several places.
    of = np.repeat(np.arange(len(distinct)), places)
    at = np.arange(len(of)) - np.repeat(np.cumsum(places) - places, places) + t.starts[of]
    hashes = common.gram_hash(t.hash, WINDOW)[at] if len(at) else np.empty(0, np.uint64)
    _, head, inverse, n = np.unique(hashes, return_index=True, return_inverse=True, return_counts=True)
    total = np.zeros(len(n), np.int64)
    np.add.at(total, inverse, copies[of])
    confirmed = head[(total > 1) | (n > 1)]
    ids = t.ids.tolist()
    first = np.ones(len(of), bool)
    rows_of = np.argsort(which, kind="stable")
    bounds = np.searchsorted(which[rows_of], np.arange(len(distinct) + 1))
    if len(confirmed):
        machine = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
        kinds = 0
        for b in at[confirmed].tolist():
            kinds += machine.add_word(tuple(ids[b : b + WINDOW]), kinds)
        machine.make_automaton()
        # All occurrences, one per passage and window: (phrase, passage, window).
        hits, ends = [], t.ends.tolist()
        for k, b in enumerate(t.starts.tolist()):
            hits += [(phrase, k, end - WINDOW + 1) for end, phrase in machine.iter(tuple(ids[b : ends[k]]))]
        phrase, passage, offset = np.array(hits, np.int64).reshape(-1, 3).T
        # The first place of each passage, then of each phrase; the earliest has the bit.
        order = np.lexsort((starts, docs, which))
        lead = np.empty(len(distinct), np.int64)
        lead[which[order][::-1]] = order[::-1]
        place = starts[lead[passage]] + offset
        best = np.lexsort((passage, place, docs[lead[passage]], phrase))
        winner = np.ones(len(best), bool)
        winner[1:] = phrase[best][1:] != phrase[best][:-1]
        is_first = np.zeros(len(phrase), bool)
        is_first[best[winner]] = True
        base = np.cumsum(places) - places
        first[base[passage] + offset] = is_first
    else:
        lead = np.full(len(distinct), -1)
        lead[which[::-1]] = np.arange(len(which))[::-1]
    # Back to the rows: only the passage's first row can hold the first place of a window.
    base = np.cumsum(places) - places
    row_base = np.cumsum(windows) - windows
    owner = np.repeat(np.arange(len(which)), windows)
    within = np.arange(len(owner)) - row_base[owner]
    bits = first[base[which[owner]] + within] & (lead[which[owner]] == owner)
    out, row, edges = [], 0, np.concatenate([row_base, [len(owner)]])
    for m in sizes:
        out.append(np.packbits(bits[edges[row] : edges[row + m]]).tobytes())
        row += m
    return pa.table({"shard": table["shard"], "block": table["block"], "first": pa.array(out, pa.binary())})


RESULT = [("doc_id", T.LongType()), ("n_words", T.LongType()), ("n_removed", T.LongType()), ("kept_text", T.StringType())]


def _removed(block: common.Block, a: _Anchored, row: dict, slices: int, shards: int) -> np.ndarray:
    """Which words of a block go."""
    gone = np.zeros(len(a.tokens.ids), bool)
    if not a.n:
        return gone
    first, n, key, number, heads = _distinct(a, _answers(a.keys()[0], slices, row["parts"]))
    if not len(heads):
        return gone
    answer = {p["shard"]: p["first"] for p in row["firsts"] or []}
    bits = np.concatenate([
        np.unpackbits(np.frombuffer(answer[s], np.uint8), count=int(n[heads[r]].sum()))
        for s, r in common.scattered(key[heads], shards)
    ]).astype(bool)
    base = np.cumsum(n[heads]) - n[heads]
    owner = np.repeat(np.arange(len(first)), n)
    within = np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    kept = bits[base[number[owner]] + within] & (heads[number[owner]] == owner)
    out = (first[owner] + within)[~kept]
    change = np.zeros(len(gone) + 1, np.int64)
    np.add.at(change, out, 1)
    np.add.at(change, out + WINDOW, -1)
    return np.cumsum(change)[:-1] > 0


def _remove(slices: int, shards: int, carried: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in common.block_rows(batches):
            block = common.Block(row)
            a = _Anchored(block)
            gone = _removed(block, a, row, slices, shards)
            t = a.tokens
            before = np.concatenate([[0], np.cumsum(gone)])
            removed = before[t.ends] - before[t.starts]
            texts = []
            for k, ws in enumerate(t.lists):
                if removed[k]:
                    ws = [w for w, x in zip(ws, gone[t.starts[k] : t.ends[k]].tolist()) if not x]
                elif carried:
                    texts.append(block.texts[k])
                    continue
                texts.append(b" ".join(ws).decode("utf-8", "replace").encode())
            yield pa.RecordBatch.from_arrays(
                [block.ids(), pa.array(t.lengths), pa.array(removed, pa.int64()), pa.array(texts, pa.binary()).view(pa.string()),
                 *([block.rests()] if carried else [])],
                [name for name, _ in RESULT] + ["rest"] * carried,
            )

    return run


def remove_repeats(docs: DataFrame, rest: Column | None = None, hot_places: int = HOT_PLACES) -> DataFrame:
    """One row per document: doc_id, n_words, n_removed and kept_text (kept words joined by a space).

    ``rest`` is a column of any type that stays with its document; with it, there is a column ``rest``, and
    the kept_text of a document that nothing is removed from is its text as it is (empty for a null text).
    """
    table = common.blocks(docs, rest)
    total = table.agg(F.sum("n_words")).first()[0] or 0
    slices = common.slices_for(total / 7, SLICE_KEYS)
    shards = common.slices_for(total / 28, SHARD_PASSAGES)
    keys = table.mapInArrow(_send_keys(slices), KEYS_SCHEMA)
    found = keys.groupBy("slice").applyInArrow(_recurring(hot_places), FOUND_SCHEMA)
    parts = common.written(found.groupBy("block").agg(F.collect_list(F.struct("slice", "found", "hot")).alias("parts")), "anchors")
    # Planned alike at every size: blocks meet their answers in a sorted join.
    passages = table.join(parts.hint("merge"), "block", "left").mapInArrow(_send_passages(slices, shards), PASSAGES_SCHEMA)
    first = passages.groupBy("shard").applyInArrow(_automaton, FIRST_SCHEMA)
    firsts = common.written(first.groupBy("block").agg(F.collect_list(F.struct("shard", "first")).alias("firsts")), "passages")
    joined = table.join(parts.hint("merge"), "block", "left").join(firsts.hint("merge"), "block", "left")
    carried = [] if rest is None else [("rest", docs.select(rest.alias("rest")).schema["rest"].dataType)]
    schema = T.StructType([T.StructField(*field) for field in RESULT + carried])
    return joined.mapInArrow(_remove(slices, shards, bool(carried)), schema)


def without_repeats(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with all their columns, the text of those that repeat something cut down.

    A text that nothing is removed from stays as it is; a document of which no word is left goes; a column
    ``n_chars`` becomes the length of the new text.
    """
    # The text is in the blocks already; the other columns go with it as typed Arrow values.
    other = F.struct(*(F.col(f"`{c}`") for c in docs.columns if c.lower() != "text")).alias("row")
    found = remove_repeats(docs, F.struct(other, F.col("text").isNull().alias("no_text")))
    rows = found.where("n_removed < n_words or n_words = 0").select("n_removed", "kept_text", F.col("rest").alias("x"))
    text = F.when(~F.col("x.no_text"), F.col("kept_text")).cast(docs.select("text").schema[0].dataType)
    columns = []
    for c in docs.columns:
        value = text if c.lower() == "text" else F.col(f"x.row.`{c}`")
        if c.lower() == "n_chars":
            value = F.when(F.col("n_removed") > 0, F.length("kept_text").cast(docs.schema[c].dataType)).otherwise(value)
        columns.append(value.alias(c))
    return rows.select(*columns)


def op8_substring_dedup(spark, sf_dir: str) -> DataFrame:
    """The contract's digests of ``remove_repeats`` over all documents."""
    return remove_repeats(common.documents(spark, sf_dir)).select(
        "doc_id", "n_words", "n_removed", F.sha2(F.col("kept_text").cast("binary"), 256).alias("kept_sha256")
    )


def reference_removed(texts: list[tuple[int, str | None]], window: int = WINDOW) -> list[tuple[int, int, int, str]]:
    """Brute force for tests: (doc_id, n_words, n_removed, kept_sha256)."""
    split = sorted((d, common.words(t)) for d, t in texts)
    first: dict[tuple, tuple[int, int]] = {}
    for k, (_, ws) in enumerate(split):
        for i in range(len(ws) - window + 1):
            first.setdefault(tuple(ws[i : i + window]), (k, i))
    out = []
    for k, (d, ws) in enumerate(split):
        gone = set()
        for i in range(len(ws) - window + 1):
            if first[tuple(ws[i : i + window])] != (k, i):
                gone.update(range(i, i + window))
        kept = b" ".join(w for i, w in enumerate(ws) if i not in gone)
        out.append((d, len(ws), len(gone), hashlib.sha256(kept).hexdigest()))
    return out


#: The same rule in DuckDB SQL (doc_ids are unique in documents).
OP8_SQL = f"""
WITH texts AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - {WINDOW} + 2)) AS k FROM texts),
ranked AS (
  SELECT doc_id, k, row_number() OVER (PARTITION BY array_to_string(w[k : k + {WINDOW} - 1], ' ') ORDER BY doc_id, k) AS place FROM starts
),
gone AS (SELECT DISTINCT doc_id, unnest(range(k, k + {WINDOW})) AS p FROM ranked WHERE place > 1),
word_rows AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM texts),
kept AS (
  SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS t, count(*) AS n FROM word_rows ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id
)
SELECT x.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM texts x LEFT JOIN kept USING (doc_id)
"""
