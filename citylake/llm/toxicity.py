"""Toxicity: a linear-chain conditional random field over words.

Two tags (clean, toxic). A word's emission is the sum of the weights of its features (the word,
its first 4 and 5 bytes, its last 4 bytes), and transitions link neighbouring words.

* Labelled tokens. Labels are per document. Over a bounded sample of the labelled training rows,
  Spark counts in how many toxic and clean documents each feature occurs; features whose
  excess in toxic documents cannot be chance (G-test, corrected for the number of features), and
  does not come from copies of one document (distinct neighbourhoods are counted too), mark the toxic tokens of toxic documents. All other tokens are clean.
* Fitting. Weights and transitions maximise the conditional likelihood of these tags
  (forward-backward gradients, Adam) on at most ``CRF_DOCS`` documents and ``CRF_WORDS`` words of either
  label. Tasks turn these into the features that their words have; no text reaches the driver.
* Scoring. Forward-backward marginals of every word of every document; a logistic function of
  their largest value and their sum, fitted on the same documents and weighted back to the
  label's share, is the document's score. Words whose marginal is at least one half form the
  offending spans, given as character offsets.

Bounds (parameters of ``fit``): ``SAMPLE_DOCS`` labelled rows of either label that have a document, ``CRF_DOCS`` and
``CRF_WORDS`` for the chain, ``FEATURES`` features. Scoring is one pass over documents without a shuffle.

Defined results: a null or empty text has no word and scores like a text without toxic words;
missing, null or repeated labels: a document is toxic if any of its rows says so, rows with null
labels are ignored; without labels of both kinds every score is the toxic share (0 if there
are none). Repeated rows get equal scores; extra columns are kept by ``reject`` and ignored else.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylake.llm import common

THRESHOLD = 0.3
SAMPLE_DOCS = 10_000
CRF_DOCS = 1500
#: Words of either label's documents for the chain, in all; a longer document is not drawn.
CRF_WORDS = 1 << 20
FEATURES = 20_000
ROUNDS = 25
#: Longer texts are scored in the same way; this is only how many bytes are scored at once.
CHUNK_BYTES = 3 << 20

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else 32 if c < 48 or 57 < c < 65 or 90 < c < 97 or 122 < c < 128 else c for c in range(256)
)


def features(word: bytes) -> tuple[bytes, ...]:
    return (b"w" + word, b"p" + word[:4], b"q" + word[:5], b"s" + word[-4:])


@dataclass
class Model:
    """What a fit leaves: at most ``FEATURES`` weights, transitions (log odds) and the calibration."""

    weights: dict[bytes, float] = field(default_factory=dict)
    bias: float = -6.0
    transition: tuple[float, float, float, float] = (0.9, 0.1, 0.5, 0.5)
    scale: tuple[float, float, float] = (-20.0, 0.0, 0.0)

    def emission(self, vocabulary: list[bytes]) -> np.ndarray:
        get = self.weights.get
        return self.bias + np.array([sum(get(f, 0.0) for f in features(w)) for w in vocabulary], np.float64)

    def marginals(self, odds: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        return forward_backward(odds, starts, lengths, self.transition)[0]

    def score(self, marginal: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
        top, total = _summary(marginal, starts, lengths)
        a, b, c = self.scale
        return 1 / (1 + np.exp(-np.clip(a + b * top + c * np.log1p(total), -30, 30)))


def _summary(marginal: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Largest marginal and sum of marginals of each document."""
    top, total = np.zeros(len(starts)), np.zeros(len(starts))
    has = lengths > 0
    if has.any():
        top[has] = np.maximum.reduceat(marginal, starts[has])
        total[has] = np.add.reduceat(marginal, starts[has])
    return top, total


def forward_backward(odds: np.ndarray, starts: np.ndarray, lengths: np.ndarray, transition) -> tuple[np.ndarray, np.ndarray]:
    """Marginals of the toxic tag, and of the pair (toxic, toxic) etc. as counts of the four transitions.

    ``odds`` is exp(emission); documents are handled side by side, longest first, so that step t
    works on all documents with more than t words at once.
    """
    t00, t01, t10, t11 = transition
    order = np.argsort(-lengths, kind="stable")
    starts, lengths = starts[order], lengths[order]
    steps = int(lengths[0]) if len(lengths) else 0
    active = np.searchsorted(-lengths, -np.arange(steps), side="left")  # documents with more than t words
    forward, ratio = np.zeros(len(odds)), np.ones(len(odds))
    if steps:
        at = starts[: active[0]]
        forward[at] = odds[at] / (1 + odds[at])
    for t in range(1, steps):
        at = starts[: active[t]] + t
        p = forward[at - 1]
        one = (t01 + p * (t11 - t01)) * odds[at]
        forward[at] = one / (t00 + p * (t10 - t00) + one)
    for t in range(steps - 2, -1, -1):
        at = starts[: active[t + 1]] + t
        back = odds[at + 1] * ratio[at + 1]
        ratio[at] = (t10 + t11 * back) / (t00 + t01 * back)
    marginal = forward * ratio / (1 - forward + forward * ratio)
    pairs = np.zeros(4)
    inner = np.ones(len(odds), bool)
    inner[starts[lengths > 0] + lengths[lengths > 0] - 1] = False
    at = np.flatnonzero(inner)
    if len(at):
        p, back = forward[at], odds[at + 1] * ratio[at + 1]
        joint = np.array([(1 - p) * t00, (1 - p) * t01 * back, p * t10, p * t11 * back])
        pairs = (joint / joint.sum(axis=0)).sum(axis=1)
    return marginal, pairs


class _Words(common.Tokens):
    def __init__(self, texts: list[bytes]):
        super().__init__([x.translate(_FOLD) for x in texts])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Documents of either label that have a feature, summed over a task's rows."""
    seen: tuple[Counter, Counter] = (Counter(), Counter())
    def flush() -> pa.RecordBatch:
        keys = list(seen[0].keys() | seen[1].keys())
        out = pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), *(pa.array([c[k] for k in keys], pa.int64()) for c in seen)],
            ["feature", "clean", "toxic"],
        )
        for c in seen:
            c.clear()
        return out

    for batch in batches:
        for toxic, text in zip(batch.column(0).to_pylist(), common.text_bytes(batch.column(1))):
            seen[toxic].update({f for w in set(text.translate(_FOLD).split()) for f in features(w)})
            if len(seen[0]) + len(seen[1]) > 150_000:
                yield flush()
    if seen[0] or seen[1]:
        yield flush()


def _contexts(candidates: set[bytes]):
    """The distinct neighbourhoods (previous and next word) in which a candidate occurs in a task's rows."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[bytes, int]] = set()
        for batch in batches:
            for text in common.text_bytes(batch.column(0)):
                ws = [b"", *text.translate(_FOLD).split(), b""]
                for k in range(1, len(ws) - 1):
                    for f in features(ws[k]):
                        if f in candidates:
                            seen.add((f, xxhash.xxh3_64_intdigest(ws[k - 1] + b" " + ws[k + 1]) >> 1))
        if seen:
            yield pa.RecordBatch.from_arrays(
                [pa.array([f for f, _ in seen], pa.binary()), pa.array([c for _, c in seen], pa.int64())], ["feature", "context"]
            )

    return run


MARKED_SCHEMA = "draw long, doc_id long, toxic int, n_words long, places array<long>, marks array<array<int>>"


def _marks(column: dict[bytes, int]):
    """Documents as their number of words, and the places and feature numbers of the words that have any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([
            ("draw", pa.int64()), ("doc_id", pa.int64()), ("toxic", pa.int32()), ("n_words", pa.int64()),
            ("places", pa.list_(pa.int64())), ("marks", pa.list_(pa.list_(pa.int32()))),
        ])
        for batch in batches:
            for at in range(batch.num_rows):
                row = batch.slice(at, 1)
                ws = common.text_bytes(row.column(3))[0].translate(_FOLD).split()
                own = {w: [column[f] for f in features(w) if f in column] for w in set(ws)}
                places = [k for k, w in enumerate(ws) if own[w]]
                values = [*(row.column(k).to_pylist()[0] for k in range(3)), len(ws), places, [own[ws[k]] for k in places]]
                yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(values, schema)], schema=schema)

    return run


def labelled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """(doc_id, toxic 0/1), one row per labelled doc_id that has a document."""
    known = (
        labels.where("toxic is not null and doc_id is not null")
        .groupBy(F.col("doc_id").cast("long").alias("doc_id"))
        .agg(F.max(F.col("toxic").cast("int")).alias("toxic"))
    )
    return known.join(docs.select(F.col("doc_id").cast("long").alias("doc_id")), "doc_id", "left_semi")


def held_out(doc_id) -> F.Column:
    return F.pmod(F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")), F.lit(4)) == 2


def fit(docs: DataFrame, labels: DataFrame, sample_docs: int = SAMPLE_DOCS, crf_docs: int = CRF_DOCS, crf_words: int = CRF_WORDS, n_features: int = FEATURES) -> Model:
    """Learn from the labelled rows that are not held out."""
    known = common.written(labelled(docs, labels).where(~held_out("doc_id")), "known")
    share = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    rate = min(max(share.get(1, 0) / max(1, sum(share.values())), 1e-9), 1 - 1e-9)
    constant = Model(scale=(math.log(rate / (1 - rate)), 0.0, 0.0))
    if len(share) < 2:
        return constant
    # At most sample_docs rows of either label, the same on every run: a proven bound for the broadcast.
    picked = [known.where(F.col("toxic") == k).orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample_docs) for k in (0, 1)]
    chosen = F.broadcast(picked[0].union(picked[1]))
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    sample = common.written(texts.join(chosen, "doc_id").select("doc_id", "toxic", "text"), "labelled")
    counted = (
        sample.select("toxic", "text").mapInArrow(_count, "feature binary, clean long, toxic long")
        .groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    )
    counted = common.written(counted, "features")
    n = {k: min(v, sample_docs) for k, v in share.items()}
    kinds = counted.count()
    # G-test of the feature's documents against the label's share, one-sided, corrected for the number of features.
    t, c = F.col("toxic").cast("double"), F.col("clean").cast("double")
    p = n[1] / (n[0] + n[1])
    g = 2 * (t * F.log((t + 1e-9) / ((t + c) * p)) + c * F.log((c + 1e-9) / ((t + c) * (1 - p))))
    level = 2 * math.log(max(kinds, 2) / 2)
    strong = (t * n[0] > 20 * (c + 0.01) * n[1]) & (g > level)
    candidates = counted.where(strong).orderBy(F.desc(g), "feature").limit(n_features).select("feature", "clean", "toxic").collect()
    # Copies of one toxic document repeat its words between the same neighbours: a feature counts
    # as often as it has different neighbourhoods.
    own = {bytes(r["feature"]) for r in candidates}
    contexts = sample.where("toxic = 1").select("text").mapInArrow(_contexts(own), "feature binary, context long").distinct()
    spread = {bytes(r["feature"]): r["count"] for r in contexts.groupBy("feature").count().collect()}

    def excess(clean: int, toxic: int) -> float:
        return 2 * (toxic * math.log((toxic + 1e-9) / ((toxic + clean) * p)) + clean * math.log((clean + 1e-9) / ((toxic + clean) * (1 - p))))

    evidence = [f for r in candidates if excess(r["clean"], min(r["toxic"], spread.get(f := bytes(r["feature"]), 0)) or 1e-9) > level]
    drawn = sample.select(F.xxhash64(F.col("doc_id") + 1).alias("draw"), "doc_id", "toxic", "text")
    marked = drawn.mapInArrow(_marks({f: k for k, f in enumerate(evidence)}), MARKED_SCHEMA).where(F.col("n_words") <= crf_words)
    marked = common.written(marked, "marked")
    first = [marked.where(F.col("toxic") == k).orderBy("draw", "doc_id").limit(crf_docs) for k in (0, 1)]
    # A running sum over at most crf_docs rows of either label.
    so_far = F.sum("n_words").over(Window.partitionBy("toxic").orderBy("draw", "doc_id").rowsBetween(Window.unboundedPreceding, 0))
    rows = first[0].union(first[1]).withColumn("so_far", so_far).where(F.col("so_far") <= crf_words).orderBy("toxic", "draw", "doc_id").collect()
    if not rows:
        return constant
    y = np.array([r["toxic"] for r in rows], np.int64)
    weight = np.array([share[k] for k in y]) / np.bincount(y, minlength=2)[y]
    return _train(_Chain(rows), y, weight / weight.mean(), evidence)


class _Chain:
    """Documents as numbers: words with the same features are one kind, kind 0 has none."""

    def __init__(self, rows: list):
        self.lengths = np.array([r["n_words"] for r in rows], np.int64)
        self.ends = np.cumsum(self.lengths)
        self.starts = self.ends - self.lengths
        kinds: dict[tuple[int, ...], int] = {(): 0}
        self.ids = np.zeros(int(self.ends[-1]), np.int64)
        for r, start in zip(rows, self.starts.tolist()):
            for k, m in zip(r["places"], r["marks"]):
                self.ids[start + k] = kinds.setdefault(tuple(m), len(kinds))
        self.n_kinds = len(kinds)
        pairs = [(k, f) for m, k in kinds.items() for f in m]
        self.kind_of, self.feature_of = np.array(pairs, np.int64).reshape(-1, 2).T


def _train(words: _Chain, y: np.ndarray, weight: np.ndarray, evidence: list[bytes]) -> Model:
    doc_of = np.repeat(np.arange(len(y)), words.lengths)
    tag = ((words.ids > 0) & (y[doc_of] == 1)).astype(np.float64)
    inner = np.ones(len(tag), bool)
    inner[(words.ends - 1)[words.lengths > 0]] = False
    at = np.flatnonzero(inner)
    gold = np.bincount((2 * tag[at] + tag[at + 1]).astype(np.int64), minlength=4) if len(at) else np.zeros(4)
    # Parameters: feature weights, bias, four transition scores.
    x = np.concatenate([np.full(len(evidence), 4.0), [-6.0], np.log((gold + 1) / (gold + 1).sum())])
    first, second = np.zeros_like(x), np.zeros_like(x)
    model = Model()

    def chances(x: np.ndarray) -> np.ndarray:
        score = np.bincount(words.kind_of, x[words.feature_of], words.n_kinds) + x[len(evidence)]
        return np.exp(np.clip(score, -30, 30))[words.ids]

    for step in range(1, ROUNDS + 1):
        odds = chances(x)
        transition = tuple(np.exp(x[-4:] - x[-4:].max()))
        marginal, seen = forward_backward(odds, words.starts, words.lengths, transition)
        error = np.bincount(words.ids, tag - marginal, words.n_kinds)
        gradient = np.concatenate([np.bincount(words.feature_of, error[words.kind_of], len(evidence)), [error.sum()], gold - seen])
        gradient -= 0.01 * x
        first = 0.9 * first + 0.1 * gradient
        second = 0.99 * second + 0.01 * gradient**2
        x = x + 0.3 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.99**step)) + 1e-8)
        model = Model(dict(zip(evidence, x[: len(evidence)].tolist())), float(x[len(evidence)]), tuple(np.exp(x[-4:] - x[-4:].max()).tolist()))
    marginal = model.marginals(chances(x), words.starts, words.lengths)
    top, total = _summary(marginal, words.starts, words.lengths)
    design = np.stack([np.ones(len(y)), top, np.log1p(total)], axis=1)
    beta, penalty = np.zeros(3), np.diag([1e-3, 0.05, 0.05])
    for _ in range(30):
        mean = 1 / (1 + np.exp(-np.clip(design @ beta, -30, 30)))
        curve = weight * np.maximum(mean * (1 - mean), 1e-9)
        beta = beta + np.linalg.solve(
            design.T @ (design * curve[:, None]) + penalty, design.T @ (weight * (y - mean)) - penalty @ beta
        )
    model.scale = tuple(beta.tolist())
    return model


def _scored(model: Model, texts: list[bytes]) -> tuple[np.ndarray, _Words, np.ndarray]:
    words = _Words(texts)
    odds = np.exp(np.clip(model.emission(words.vocabulary), -30, 30))[words.ids] if len(words.ids) else np.empty(0)
    marginal = model.marginals(odds, words.starts, words.lengths)
    return model.score(marginal, words.starts, words.lengths), words, marginal


def _spans(text: bytes, toxic: np.ndarray) -> list[dict]:
    """Character offsets of runs of toxic words."""
    out: list[dict] = []
    last = -2
    for k, m in enumerate(re.finditer(rb"[^ ]+", text.translate(_FOLD))):
        if toxic[k]:
            a, b = (len(text[:x].decode("utf-8", "replace")) for x in m.span())
            if last == k - 1:
                out[-1]["end"] = b
            else:
                out.append({"start": a, "end": b})
            last = k
    return out


SCORE_SCHEMA = "doc_id long, score double, spans array<struct<start: int, end: int>>"


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, score and offending spans of every document."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))
        for ids, texts in common.chunked(batches, CHUNK_BYTES):
            value, words, marginal = _scored(model, texts)
            toxic = marginal >= 0.5
            spans = [
                _spans(x, toxic[a:b]) if toxic[a:b].any() else []
                for x, a, b in zip(texts, words.starts.tolist(), words.ends.tolist())
            ]
            yield pa.RecordBatch.from_arrays([ids, pa.array(value), pa.array(spans, kind)], ["doc_id", "score", "spans"])

    source = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return source.mapInArrow(run, SCORE_SCHEMA)


def reject(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows, with all their columns, whose score is below the threshold."""
    name = docs.columns[[c.lower() for c in docs.columns].index("text")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at = 0
            for _, texts in common.chunked(iter([batch.select([name, name])]), CHUNK_BYTES):
                value = _scored(model, texts)[0]
                yield batch.slice(at, len(texts)).filter(pa.array(value < threshold))
                at += len(texts)

    return docs.mapInArrow(run, docs.schema)


def op4_toxicity_crf(spark, sf_dir: str) -> DataFrame:
    """Scores of all documents, learnt from the labelled rows that are not held out."""
    docs = common.documents(spark, sf_dir)
    model = fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return score(docs, model).select(
        "doc_id",
        held_out("doc_id").alias("held_out"),
        "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
        "spans",
    )
