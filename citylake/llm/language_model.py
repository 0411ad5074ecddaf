"""LM scoring with Brown's class-based bigrams.

P(word | previous) = P(class | previous class) * P(word | class), classes from exchange clustering.

* Counts cover all training tokens. Texts are split once, into written blocks of word numbers. Blocks send
  each distinct word once to the word's slice and get its answer back, so scoring needs no dictionary in
  memory but the block's own.
* Start: exchange clustering of a core, the end of a text, the ``HEADS`` most frequent words per class and
  ``TAILS`` groups of all other words by their last two bytes: each unit in turn moves to the class that
  raises the likelihood of the class bigrams most, until no unit moves (``SWEEPS`` at most).
* Exchange of every word: each training word then is a unit of its own. Blocks send its counts before and
  after each class, slices add them up and move the word to the class with the highest gain. The moves of
  this sweep are taken at once, against the class bigrams before it (as in distributed exchange
  clustering). The end keeps a class of its own; words not seen in training keep their group's class.
* The number of classes grows as the fourth root of the vocabulary (``CLASSES`` at least).
* Smoothing: transitions are interpolated with class frequencies; emissions add ``ALPHA`` to each
  word's count and keep one more share per class for words not seen in training.

Words of a held-out text count nothing. Bounds: bigrams of the core's units at the driver and in tasks,
classes x classes transitions; slices and blocks grow in number with the input, not in size.

Defined results: a null or empty text is its end token alone; a null doc_id reads as an empty text
for the hold-out rule (held out); repeated rows are scored and counted as often as they occur; extra
columns are ignored; an empty table gives an empty result; without training texts N and V are 0.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.llm import common

HEADS = 8
TAILS = 256
CLASSES = 32
SWEEPS = 20
ALPHA = 0.1
SLICE_KEYS = 100_000
#: Context counts whose gains are computed at a time.
STEP = 1 << 13

_END = common.mix(np.array([xxhash.xxh3_64_intdigest(b"\n")], np.uint64))[0]  # white space: never a word


def is_held_out(doc_id: int | None) -> bool:
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % 10 == 0


def _packed(x: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(x.tobytes())


def _unpacked(data: bytes, kind) -> np.ndarray:
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(data), kind)


TOKEN_SCHEMA = "block long, doc_ids binary, known binary, held_out binary, lengths binary, keys binary, tails binary, sequence binary"


def _number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents as blocks whose texts are numbers into the block's sorted keys, an end after each text. Packed and
    numbered by one worker: texts do not go through the JVM a second time."""
    for row in common.block_rows(common.pack_blocks(batches)):
        block = common.Block(row)
        t = common.Tokens(block.texts, lower=True)
        keys, key_of = np.unique(np.append(common.mix(t.vocabulary_hash), _END), return_inverse=True)
        tails = np.zeros(len(keys), np.uint8)
        tails[key_of[:-1]] = [xxhash.xxh3_64_intdigest(w[-2:]) % TAILS for w in t.vocabulary]
        ends = t.ends + np.arange(1, len(t.ends) + 1)
        sequence = np.full(int(ends[-1]) if len(ends) else 0, key_of[-1], np.uint32)
        inner = np.ones(len(sequence), bool)
        inner[ends - 1] = False
        sequence[inner] = key_of[t.ids]
        held = np.array([is_held_out(d) for d in block.ids().to_pylist()], bool)
        values = [
            row["block"], row["doc_ids"], row["known"], held.tobytes(), (t.lengths + 1).tobytes(),
            keys.tobytes(), tails.tobytes(), _packed(sequence),
        ]
        kinds = [pa.int64()] + [pa.binary()] * 7
        names = ["block", "doc_ids", "known", "held_out", "lengths", "keys", "tails", "sequence"]
        yield pa.RecordBatch.from_arrays([pa.array([v], k) for v, k in zip(values, kinds)], names)


class _Texts:
    """A block of numbered texts."""

    def __init__(self, row: dict):
        self.row = row
        self.block = row["block"]
        self.lengths = np.frombuffer(row["lengths"], np.int64)
        self.keys = np.frombuffer(row["keys"], np.uint64)
        self.tails = np.frombuffer(row["tails"], np.uint8)
        self.sequence = _unpacked(row["sequence"], np.uint32).astype(np.int64)
        self.training = self.sequence[np.repeat(~np.frombuffer(row["held_out"], np.bool_), self.lengths)]

    def units(self, heads: np.ndarray, order: np.ndarray, n_heads: int) -> np.ndarray:
        """The core unit of each key: 0 the end, then heads, then tails. heads: sorted keys, order: their ranks."""
        out = 1 + n_heads + self.tails.astype(np.int64)
        if len(heads):
            at = np.minimum(np.searchsorted(heads, self.keys), len(heads) - 1)
            found = heads[at] == self.keys
            out[found] = 1 + order[at[found]]
        out[self.keys == _END] = 0
        return out


COUNT_SCHEMA = "slice long, keys binary, counts binary"
SUM_SCHEMA = "tokens long, kinds long, heads array<struct<key: long, n: long>>"


def _send_counts(slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Counts of training words, added up over some of a task's blocks before they are sent."""
        keys, counts, held = [], [], 0

        def sent() -> pa.RecordBatch:
            known, inverse = np.unique(np.concatenate(keys), return_inverse=True)
            n = np.bincount(inverse, np.concatenate(counts), len(known)).astype(np.int64)
            parts = common.scattered(known, slices)
            return pa.RecordBatch.from_pydict({
                "slice": [s for s, _ in parts],
                "keys": [known[r].tobytes() for _, r in parts],
                "counts": [_packed(n[r]) for _, r in parts],
            })

        for row in common.block_rows(batches):
            x = _Texts(row)
            n = np.bincount(x.training, minlength=len(x.keys))
            seen = n > 0
            keys.append(x.keys[seen])
            counts.append(n[seen])
            held += int(seen.sum())
            if held > 1 << 20:
                yield sent()
                keys, counts, held = [], [], 0
        if held:
            yield sent()

    return run


def _add_up(most: int):
    def run(table: pa.Table) -> pa.Table:
        """A slice's sums and its most frequent words."""
        keys = np.concatenate([np.frombuffer(x, np.uint64) for x in table["keys"].to_pylist()])
        known, inverse = np.unique(keys, return_inverse=True)
        n = np.concatenate([_unpacked(x, np.int64) for x in table["counts"].to_pylist()])
        total = np.zeros(len(known), np.int64)
        np.add.at(total, inverse, n)
        words = np.flatnonzero(known != _END)
        top = words[np.lexsort((known[words], -total[words]))[:most]]
        heads = [{"key": int(known[k].astype(np.int64)), "n": int(total[k])} for k in top]
        kind = pa.list_(pa.struct([("key", pa.int64()), ("n", pa.int64())]))
        return pa.table({"tokens": [int(total.sum())], "kinds": [len(known)], "heads": pa.array([heads], kind)})

    return run


def _bigrams(heads: np.ndarray, order: np.ndarray, n_heads: int):
    units = 1 + n_heads + TAILS

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Bigrams of the core's units in training texts, summed over a task's blocks; a text begins after an end."""
        n = np.zeros(units * units, np.int64)
        for row in common.block_rows(batches):
            x = _Texts(row)
            unit = x.units(heads, order, n_heads)[x.training]
            if len(unit):
                n += np.bincount(np.append([0], unit[:-1]) * units + unit, minlength=len(n))
        yield from _nonzero(n)

    return run


def _nonzero(n: np.ndarray) -> Iterator[pa.RecordBatch]:
    pairs = np.flatnonzero(n)
    for at in range(0, len(pairs), 1 << 16):
        p = pairs[at : at + (1 << 16)]
        yield pa.RecordBatch.from_arrays([pa.array(p, pa.int64()), pa.array(n[p], pa.int64())], ["pair", "n"])


def _square(pairs: DataFrame, size: int) -> np.ndarray:
    """Sums of (pair, n) rows as a table of ``size`` x ``size``."""
    out = np.zeros(size * size)
    for r in pairs.groupBy("pair").agg(F.sum("n").alias("n")).toLocalIterator():
        out[r["pair"]] = r["n"]
    return out.reshape(size, size)


def _f(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(bigrams: np.ndarray, classes: int = CLASSES, sweeps: int = SWEEPS) -> np.ndarray:
    """The class of each unit; unit 0 keeps class 0 for itself."""
    units = len(bigrams)
    weight = bigrams.sum(axis=0) + bigrams.sum(axis=1)
    ranked = [u for u in np.argsort(-weight, kind="stable").tolist() if u]
    label = np.zeros(units, np.int64)
    for k, u in enumerate(ranked):
        label[u] = 1 + k % (classes - 1)
    member = np.zeros((units, classes))
    member[np.arange(units), label] = 1
    table = member.T @ bigrams @ member
    for _ in range(sweeps):
        moved = 0
        for u in ranked:
            if not weight[u]:
                continue
            old, own = label[u], float(bigrams[u, u])
            after, before = bigrams[u] @ member, bigrams[:, u] @ member
            after[old] -= own
            before[old] -= own
            table[old] -= after
            table[:, old] -= before
            table[old, old] -= own
            rows, columns = table.sum(axis=1), table.sum(axis=0)
            gain = (_f(table + after) - _f(table)).sum(axis=1) + (_f(table + before[:, None]) - _f(table)).sum(axis=0)
            diagonal = table.diagonal()
            gain -= _f(diagonal + after) + _f(diagonal + before) - 2 * _f(diagonal)
            gain += _f(diagonal + after + before + own) - _f(diagonal)
            gain -= _f(rows + after.sum() + own) - _f(rows) + _f(columns + before.sum() + own) - _f(columns)
            gain[0] = -np.inf
            new = int(gain.argmax())
            if gain[new] <= gain[old] + 1e-9:
                new = old
            table[new] += after
            table[:, new] += before
            table[new, new] += own
            if new != old:
                member[u, old], member[u, new], label[u] = 0, 1, new
                moved += 1
        if not moved:
            break
    return label


CONTEXT_SCHEMA = "slice long, block long, keys binary, labels binary, sizes binary, contexts binary, counts binary"
ANSWER_SCHEMA = "slice long, block long, totals binary, labels binary, class_tokens array<long>, class_kinds array<long>"


def _send_contexts(heads: np.ndarray, order: np.ndarray, n_heads: int, label: np.ndarray, classes: int, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Each key of a block with its class and its training counts after (0..) and before (classes..) each class."""
        for row in common.block_rows(batches):
            x = _Texts(row)
            own = label[x.units(heads, order, n_heads)]
            now = own[x.training]
            before, after = np.append([0], now[:-1]), np.append(now[1:], [0])
            if not len(now):
                before = after = now
            at = x.training * (2 * classes)
            codes, n = np.unique(np.concatenate([at + before, at + classes + after]), return_counts=True)
            edges = np.searchsorted(codes, np.arange(len(x.keys) + 1) * (2 * classes))
            parts = common.scattered(x.keys, slices)
            cut = [slice(edges[r.start], edges[r.stop]) for _, r in parts]
            contexts, n, sizes = (codes % (2 * classes)).astype(np.uint16), n.astype(np.int64), np.diff(edges).astype(np.uint32)
            yield pa.RecordBatch.from_pydict({
                "slice": [s for s, _ in parts],
                "block": [x.block] * len(parts),
                "keys": [x.keys[r].tobytes() for _, r in parts],
                "labels": [_packed(own[r].astype(np.uint16)) for _, r in parts],
                "sizes": [_packed(sizes[r]) for _, r in parts],
                "contexts": [_packed(contexts[c]) for c in cut],
                "counts": [_packed(n[c]) for c in cut],
            })

    return run


def moved(word: np.ndarray, context: np.ndarray, n: np.ndarray, total: np.ndarray, label: np.ndarray, follow: np.ndarray) -> np.ndarray:
    """The class of each word after one exchange against the class bigrams ``follow``.

    word, context, n: counts sorted by word; a context below ``len(follow)`` is the class before the word,
    the others are classes after it. Words without counts and class 0 stay.
    """
    classes = len(follow)
    beside = np.concatenate([follow, follow.T])
    margins = np.stack([follow.sum(axis=1), follow.sum(axis=0)])
    words, starts = np.unique(word, return_index=True)
    starts = np.append(starts, len(word))
    out = label.copy()
    first = 0
    while first < len(words):
        last = max(first + 1, int(np.searchsorted(starts, starts[first] + STEP, side="right")) - 1)
        a, b = starts[first], starts[last]
        w, old = words[first:last], label[words[first:last]]
        m, size = n[a:b, None].astype(np.float64), total[w][:, None].astype(np.float64)
        without = beside[context[a:b]]
        without[np.arange(b - a), label[word[a:b]]] -= m[:, 0]
        gain = np.add.reduceat(_f(without + m) - _f(without), starts[first:last] - a)
        for margin in margins:
            rest = np.tile(margin, (len(w), 1))
            rest[np.arange(len(w)), old] -= size[:, 0]
            gain -= _f(rest + size) - _f(rest)
        gain[:, 0] = -np.inf
        new = gain.argmax(axis=1)
        here = np.arange(len(w))
        better = (old != 0) & (gain[here, new] > gain[here, old] + 1e-9)
        out[w[better]] = new[better]
        first = last
    return out


def _decide(follow: np.ndarray):
    classes = len(follow)

    def run(table: pa.Table) -> pa.Table:
        """Total counts and classes of a slice's words, for every block; and sums by class in a row without a block."""
        part = table.to_pydict()
        keys = [np.frombuffer(x, np.uint64) for x in part["keys"]]
        known, head, inverse = np.unique(np.concatenate(keys), return_index=True, return_inverse=True)
        label = np.concatenate([_unpacked(x, np.uint16) for x in part["labels"]])[head].astype(np.int64)
        sizes = np.concatenate([_unpacked(x, np.uint32) for x in part["sizes"]])
        codes = np.repeat(inverse * (2 * classes), sizes)
        codes += np.concatenate([_unpacked(x, np.uint16) for x in part["contexts"]])
        counts = np.concatenate([_unpacked(x, np.int64) for x in part["counts"]])
        order = np.argsort(codes, kind="stable")
        codes, counts = codes[order], counts[order]
        heads = np.flatnonzero(np.diff(codes, prepend=-1))
        codes = codes[heads]
        n = np.add.reduceat(counts, heads) if len(heads) else counts
        word, context = codes // (2 * classes), codes % (2 * classes)
        total = np.zeros(len(known), np.int64)
        np.add.at(total, word[context < classes], n[context < classes])
        label = moved(word, context, n, total, label, follow)
        answer, classed, at, totals, labels = total[inverse], label[inverse].astype(np.uint16), 0, [], []
        for k in keys:
            totals.append(_packed(answer[at : at + len(k)]))
            labels.append(_packed(classed[at : at + len(k)]))
            at += len(k)
        tokens = np.zeros(classes, np.int64)
        np.add.at(tokens, label, total)
        kinds = np.bincount(label[total > 0], minlength=classes)
        none, many = [None] * len(keys), pa.list_(pa.int64())
        return pa.table({
            "slice": pa.array([*part["slice"], part["slice"][0]], pa.int64()),
            "block": pa.array([*part["block"], None], pa.int64()),
            "totals": pa.array([*totals, None], pa.binary()),
            "labels": pa.array([*labels, None], pa.binary()),
            "class_tokens": pa.array([*none, tokens.tolist()], many),
            "class_kinds": pa.array([*none, kinds.tolist()], many),
        })

    return run


LABELLED_SCHEMA = "doc_ids binary, known binary, held_out binary, lengths binary, n_known binary, base binary, emitted binary, classes binary"


def _label(class_tokens: np.ndarray, class_kinds: np.ndarray, tokens: int, kinds: int, slices: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Blocks with the classes of their tokens and what does not depend on transitions."""
        for row in common.block_rows(batches):
            x = _Texts(row)
            answer = {p["slice"]: p for p in row["parts"]}
            parts = [answer[s] for s, _ in common.scattered(x.keys, slices)]
            n = np.concatenate([_unpacked(p["totals"], np.int64) for p in parts])
            group = np.concatenate([_unpacked(p["labels"], np.uint16) for p in parts])
            starts = np.cumsum(x.lengths) - x.lengths
            base = np.log10((n + 0.1) / (tokens + 0.1 * (kinds + 1)))
            emitted = np.log10((n + ALPHA) / (class_tokens[group] + ALPHA * (class_kinds[group] + 1)))
            sums = [np.add.reduceat(v[x.sequence], starts).tobytes() for v in ((n > 0).astype(np.int64), base, emitted)]
            values = [*(row[c] for c in ("doc_ids", "known", "held_out", "lengths")), *sums, _packed(group[x.sequence])]
            yield pa.RecordBatch.from_arrays([pa.array([v], pa.binary()) for v in values], [c.split()[0] for c in LABELLED_SCHEMA.split(", ")])

    return run


def _follow(classes: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Class bigrams of the training texts, summed over a task's blocks."""
        n = np.zeros(classes * classes, np.int64)
        for row in common.block_rows(batches):
            lengths = np.frombuffer(row["lengths"], np.int64)
            now = _unpacked(row["classes"], np.uint16).astype(np.int64)
            now = now[np.repeat(~np.frombuffer(row["held_out"], np.bool_), lengths)]
            if len(now):
                n += np.bincount(np.append([0], now[:-1]) * classes + now, minlength=len(n))
        yield from _nonzero(n)

    return run


SCORE_SCHEMA = "doc_id long, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double"


def _score(transition: np.ndarray, tokens: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row in common.block_rows(batches):
            lengths = np.frombuffer(row["lengths"], np.int64)
            now = _unpacked(row["classes"], np.uint16).astype(np.int64)
            before = np.append([0], now[:-1])  # the token before a text's first is an end
            passed = np.add.reduceat(transition[before, now], np.cumsum(lengths) - lengths)
            ids = pa.array(np.frombuffer(row["doc_ids"], np.int64), mask=~np.frombuffer(row["known"], np.bool_))
            yield pa.RecordBatch.from_arrays(
                [
                    ids, pa.array(np.frombuffer(row["held_out"], np.bool_)), pa.array(lengths),
                    pa.array(np.frombuffer(row["n_known"], np.int64)), pa.array([tokens] * len(lengths), pa.int64()),
                    pa.array(np.frombuffer(row["base"], np.float64)), pa.array(np.frombuffer(row["emitted"], np.float64) + passed),
                ],
                ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return run


def transitions(follow: np.ndarray) -> np.ndarray:
    """log10 P(class | previous class), interpolated with class frequencies."""
    share = (follow.sum(axis=0) + ALPHA) / (follow.sum() + ALPHA * len(follow))
    return np.log10((follow + share) / (follow.sum(axis=1, keepdims=True) + 1))


def score(docs: DataFrame) -> DataFrame:
    """Counts, unigram base score and class-model score (log10 probability) of every document."""
    table = common.written(common.texts_of(docs).mapInArrow(_number, TOKEN_SCHEMA), "numbered")
    size = table.select(F.sum(F.expr("length(keys)"))).first()[0] or 0
    slices = common.slices_for(size / 8 / 4, SLICE_KEYS)  # keys of blocks, a few blocks to a key
    kinds_most = size // 8 + 1
    most = HEADS * max(CLASSES, math.ceil(kinds_most**0.25))
    sums = common.written(table.mapInArrow(_send_counts(slices), COUNT_SCHEMA).groupBy("slice").applyInArrow(_add_up(most), SUM_SCHEMA), "counts")
    tokens, kinds = (int(v or 0) for v in sums.agg(F.sum("tokens"), F.sum("kinds")).first())
    classes = max(CLASSES, math.ceil(kinds**0.25))
    n_heads = HEADS * classes
    top = sums.select(F.explode("heads").alias("h")).select("h.*").orderBy(F.desc("n"), "key").limit(n_heads).collect()
    keys = np.array([r["key"] for r in top], np.int64).astype(np.uint64)
    order = np.argsort(keys)
    heads = keys[order]
    units = 1 + n_heads + TAILS
    bigrams = _square(table.mapInArrow(_bigrams(heads, order, n_heads), "pair long, n long"), units)
    label = exchange(bigrams, classes)
    member = np.zeros((units, classes))
    member[np.arange(units), label] = 1
    contexts = table.mapInArrow(_send_contexts(heads, order, n_heads, label, classes, slices), CONTEXT_SCHEMA)
    answers = common.written(contexts.groupBy("slice").applyInArrow(_decide(member.T @ bigrams @ member), ANSWER_SCHEMA), "classes")
    by_class = np.zeros((2, classes), np.int64)
    for k, name in enumerate(("class_tokens", "class_kinds")):
        rows = answers.where("block is null").select(F.posexplode(name).alias("class", "n")).groupBy("class").agg(F.sum("n").alias("n"))
        for r in rows.collect():
            by_class[k, r["class"]] = r["n"]
    parts = answers.where("block is not null").groupBy("block").agg(F.collect_list(F.struct("slice", "totals", "labels")).alias("parts"))
    joined = table.join(parts.hint("merge"), "block").select(*table.columns, "parts")
    labelled = common.written(joined.mapInArrow(_label(*by_class, tokens, kinds, slices), LABELLED_SCHEMA), "labelled")
    follow = _square(labelled.select("held_out", "lengths", "classes").mapInArrow(_follow(classes), "pair long, n long"), classes)
    return labelled.mapInArrow(_score(transitions(follow), tokens), SCORE_SCHEMA)


def op3_brown_language_model(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents under the model learnt from the training texts."""
    return score(common.documents(spark, sf_dir))
