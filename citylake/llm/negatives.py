"""Hard-negative mining by threshold joins over a pruned inverted index, in the manner of L2AP.

Every anchor searches all rows twice: for its best rows of the same label (positives), then, for each
positive's score ``p``, for the best rows of other labels in the window ``low * p <= score <= high * p``.
Both are threshold joins: only pairs that can score the anchor's threshold are followed.

1. *Order.* Dimensions are ordered by their energy over all rows, so few leading ones hold most of a norm.
2. *Index.* Rows are dealt by a hash into groups. In a group the first dimensions of a row have postings; the
   rest are omitted once the norm of the row's suffix times that of the anchor's is below the
   anchors' lowest threshold (a bound per unit of the anchor's norm): a pair whose postings give nothing cannot score.
3. *Accumulation.* An anchor's partial scores grow posting by posting, ``STAGE`` dimensions at a time. Rows are
   sorted by their number of postings, so a stage's postings are the first rows of the group.
   After each stage, rows are left behind whose partial score plus the product of the
   remaining norms is below the threshold of every anchor; what is left at the end is scored exactly.
4. *Lowering.* The first threshold is where a normal approximation by the dimensions' means and variances expects
   ``EXPECTED`` rows. Anchors whose windows are not full lower it to ``LOWER`` times as many, until they are full
   or the threshold has passed the window (or all rows). Thresholds decide what is tried, never the result.

A group returns at most as many rows per anchor and window as the window takes, and none below the threshold, so
about ``EXPECTED`` rows per anchor are shuffled. Anchors are the stated query set: blocks of them meet
groups of rows of a fixed size, no pair is ever a row. What the driver holds is three numbers per dimension.

Scores are exact integers. Components are kept within the square root of 2^53 by the number of dimensions (11.8 million
for 64), so that every score is exact in a double, too; unit vectors times 256 are far below.

Defined results: rows with a null label, a null vector or a null component take no part (nor, in the query,
those with a component that is not finite); missing components of a shorter vector count as 0; an empty vector scores
0; a null key is never divisible, and comes last in ties; repeated rows are rows of their own (a copy
of an anchor can be its positive); remaining ties are told apart by the rows' places in the written table, which
changes no value; extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from statistics import NormalDist

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citylake.llm import common

POSITIVES = 5
NEGATIVES = 3
#: The window of negatives: 50 * positive <= 100 * negative <= 95 * positive.
LOW, HIGH, OF = 50, 95, 100
#: Dimensions accumulated between two prunings.
STAGE = 8
#: Rows expected above the first threshold, and by how much this grows when windows are not full.
EXPECTED = 24
LOWER = 16
#: Rows in a group and anchors in a block, about; groups at least (for parallel tasks).
GROUP = 32768
BLOCK = 8192
LEAST_GROUPS = 16
#: Anchors whose partial scores a task holds at a time.
STRIP = 128

_NEVER = np.inf


def _bound(dims: int) -> int:
    return math.isqrt((1 << 53) // max(1, dims))


def _packed(bound: int, dims: int, order: np.ndarray | None = None, kind: str = "int64"):
    """Integer lists as binary vectors of ``dims`` places, in the order of the dimensions."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("vector")
            lengths = column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
            flat = np.clip(column.flatten().to_numpy(zero_copy_only=False).astype(np.int64), -bound, bound)
            out = np.zeros((batch.num_rows, dims), np.int64)
            out[np.repeat(np.arange(len(lengths)), lengths), np.arange(len(flat)) - np.repeat(np.cumsum(lengths) - lengths, lengths)] = flat
            if order is not None:
                out = out[:, order]
            rest = [batch.column(n) for n in ("row", "key", "label", "anchor")]
            yield pa.RecordBatch.from_arrays([*rest, pa.array([x.tobytes() for x in out.astype(kind)], pa.binary())], ["row", "key", "label", "anchor", "vector"])

    return run


def _moments(dims: int):
    """Sums, sums of squares and largest sizes of each dimension: one row per task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, most = np.zeros((2, dims)), np.zeros(dims)
        for batch in batches:
            x = _matrix(batch.column("vector"), dims, "int64").astype(np.float64)
            sums += x.sum(axis=0), (x * x).sum(axis=0)
            most = np.maximum(most, np.abs(x).max(axis=0, initial=0))
        yield pa.RecordBatch.from_arrays([pa.array([v], pa.list_(pa.float64())) for v in (*sums, most)], ["s", "q", "m"])

    return run


def _matrix(column: pa.Array | pa.ChunkedArray, dims: int, kind: str) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), dims).astype(np.int64)


def _thresholds(mean: np.ndarray, variance: np.ndarray, dims: int, kind: str, expected: float):
    """Adds ``at``: the score that about ``expected`` of ``rows`` rows reach below ``top``, at least ``least``."""
    normal = NormalDist()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), dims, kind).astype(np.float64)
            mu, sd = x @ mean, np.sqrt(np.maximum((x * x) @ variance, 1e-9))
            out = []
            for m, s, rows, top, least in zip(mu, sd, *(batch.column(n).to_pylist() for n in ("rows", "top", "least"))):
                above = 0.0 if top is None else 1.0 - normal.cdf((top - m) / s)
                share = max(above + expected / max(rows, 1), 1e-15)
                at = m + s * normal.inv_cdf(1.0 - share) if share < 1.0 else -_NEVER
                out.append(max(at, -_NEVER if least is None else least))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out, pa.float64())], [*batch.schema.names, "at"])

    return run


class Index:
    """The postings of a group of rows for thresholds of at least ``lowest`` per unit of an anchor's norm."""

    def __init__(self, x: np.ndarray, lowest: float):
        self.exact = x
        self.size, self.dims = x.shape
        y = x.astype(np.float64)
        cuts = [*range(0, self.dims, STAGE), self.dims]
        squares = np.zeros((self.size, len(cuts)))
        for k in range(len(cuts) - 2, -1, -1):
            squares[:, k] = squares[:, k + 1] + (y[:, cuts[k] : cuts[k + 1]] ** 2).sum(axis=1)
        norms = np.sqrt(squares)
        # A row's postings end with the first stage before which its suffix is covered by the bound.
        self.largest = float(norms.max(initial=0))
        slack = 1e-9 * self.largest
        self.stages = (norms >= lowest - slack).sum(axis=1) if lowest > slack else np.full(self.size, len(cuts) - 1)
        self.stages = np.minimum(self.stages, len(cuts) - 1)
        self.order = np.argsort(-self.stages, kind="stable")
        self.norms = norms[self.order]
        self.cuts = cuts
        self.y = y[self.order]
        self.held = [int((self.stages > k).sum()) for k in range(len(cuts) - 1)]

    def reaching(self, q: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(anchor, row, exact score) of all pairs that score ``at`` of the anchor, as positions."""
        z = q.astype(np.float64)
        left = np.sqrt(np.stack([(z[:, c:] ** 2).sum(axis=1) for c in self.cuts], axis=1))
        live = np.arange(self.size)
        ended: list[tuple[np.ndarray, np.ndarray]] = []
        partial = np.zeros((len(z), self.size))
        floor = (at - 0.5 - 1e-9 * self.largest * left[:, 0])[:, None]  # partial scores are rounded
        for k in range(len(self.cuts) - 1):
            n = int(np.searchsorted(live, self.held[k]))  # rows that still have postings
            if n < len(live):
                ended.append(self._candidates(partial[:, n:], live[n:], left[:, k], k, floor))
                live, partial = live[:n], partial[:, :n]
            if not len(live):
                break
            a, b = self.cuts[k], self.cuts[k + 1]
            partial += z[:, a:b] @ self.y[live, a:b].T
            if k % 2 and b < self.dims:  # pruning costs as much as a stage
                keep = (partial + np.outer(left[:, k + 1], self.norms[live, k + 1]) >= floor).any(axis=0)
                if keep.mean() < 0.75:
                    live, partial = live[keep], partial[:, keep]
        if len(live):
            ended.append(self._candidates(partial, live, left[:, -1], len(self.cuts) - 1, floor))
        anchors = np.concatenate([x for x, _ in ended]) if ended else np.empty(0, np.int64)
        rows = self.order[np.concatenate([x for _, x in ended])] if ended else np.empty(0, np.int64)
        scores = np.empty(len(rows), np.int64)
        for c in range(0, len(rows), 1 << 16):
            scores[c : c + (1 << 16)] = (q[anchors[c : c + (1 << 16)]] * self.exact[rows[c : c + (1 << 16)]]).sum(axis=1)
        keep = scores >= at[anchors]
        return anchors[keep], rows[keep], scores[keep]

    def _candidates(self, partial: np.ndarray, live: np.ndarray, left: np.ndarray, k: int, floor: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Pairs whose partial score and remaining norms can reach the threshold."""
        anchor, column = np.nonzero(partial + np.outer(left, self.norms[live, k]) >= floor)
        return anchor, live[column]


def _best(window: np.ndarray, score: np.ndarray, key: np.ndarray, known: np.ndarray, n: np.ndarray) -> np.ndarray:
    """Positions of the first ``n[window]`` pairs of each window: higher scores first, then smaller keys, null last."""
    order = np.lexsort((key, ~known, -score, window))
    w = window[order]
    starts = np.flatnonzero(np.r_[True, w[1:] != w[:-1]]) if len(w) else np.empty(0, np.int64)
    rank = np.arange(len(w)) - np.repeat(starts, np.diff(np.r_[starts, len(w)]))
    return order[rank < n[w]]


def _searched(dims: int, kind: str, same: bool):
    """A block of anchors against a group of rows: each window's best rows of this group, above its threshold."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        empty = pa.table({"row": pa.array([], pa.int64()), "w": pa.array([], pa.int32()), "other": pa.array([], pa.int64()), "key": pa.array([], pa.int64()), "score": pa.array([], pa.int64())})
        if not left.num_rows or not right.num_rows:
            return empty
        x = _matrix(right["vector"], dims, kind)
        labels, others = right["label"].to_numpy(), right["row"].to_numpy()
        known = ~np.asarray(right["key"].is_null())
        keys = right["key"].fill_null(0).to_numpy()
        # Windows of one anchor share its row: the lowest threshold is searched once.
        q_all, at, top = _matrix(left["vector"], dims, kind), left["at"].to_numpy(), left["top"].to_numpy()
        rows, own, n, w = (left[c].to_numpy() for c in ("row", "label", "n", "w"))
        unit = np.sqrt((q_all.astype(np.float64) ** 2).sum(axis=1))
        _, first, of = np.unique(rows, return_index=True, return_inverse=True)
        lowest = np.full(len(first), _NEVER)
        np.minimum.at(lowest, of, at)
        ratio = np.where(unit[first] > 0, lowest / np.maximum(unit[first], 1e-300), -_NEVER)
        index = Index(x, float(ratio.min()))
        by_anchor = np.argsort(of, kind="stable")
        ends = np.cumsum(np.bincount(of, minlength=len(first)))
        begins = np.r_[0, ends[:-1]]
        found = []
        for s in range(0, len(first), STRIP):
            strip = np.arange(s, min(s + STRIP, len(first)))
            anchor, row, score = index.reaching(q_all[first[strip]], lowest[strip])
            anchor = strip[anchor]
            fits = labels[row] == own[first[anchor]]
            fits = fits & (others[row] != rows[first[anchor]]) if same else ~fits
            anchor, row, score = anchor[fits], row[fits], score[fits]
            for j in range(int((ends - begins)[strip].max())):  # the anchors' windows, one after another
                pair = np.flatnonzero(begins[anchor] + j < ends[anchor])
                window = by_anchor[begins[anchor[pair]] + j]
                ok = (score[pair] >= at[window]) & (score[pair] <= top[window])
                pair, window = pair[ok], window[ok]
                keep = _best(window, score[pair], keys[row[pair]], known[row[pair]], n)
                found.append((window[keep], row[pair[keep]], score[pair[keep]]))
        window, row, score = (np.concatenate(c) for c in zip(*found))
        if not len(row):
            return empty
        return pa.table({
            "row": pa.array(rows[window], pa.int64()), "w": pa.array(w[window], pa.int32()), "other": pa.array(others[row], pa.int64()),
            "key": pa.array(keys[row], pa.int64(), mask=~known[row]), "score": pa.array(score, pa.int64()),
        })

    return run


class Searcher:
    """All rows, dealt in groups, and the moments of their dimensions."""

    def __init__(self, rows: DataFrame):
        """``rows``: row, key, label, anchor and vector (array<long>), none null but the key."""
        self.spark = rows.sparkSession
        shape = rows.agg(F.max(F.size("vector")).alias("dims"), F.count(F.lit(1)).alias("n")).first()
        self.dims, self.n = max(1, shape["dims"] or 1), shape["n"]
        schema = "row long, key long, label long, anchor boolean, vector binary"
        plain = rows.mapInArrow(_packed(_bound(self.dims), self.dims), schema)
        # One row per task and dimension reaches the driver after a sum per dimension.
        sums = plain.mapInArrow(_moments(self.dims), "s array<double>, q array<double>, m array<double>")
        sums = sums.select(F.posexplode(F.arrays_zip("s", "q", "m")).alias("d", "x")).groupBy("d").agg(F.sum("x.s"), F.sum("x.q"), F.max("x.m"))
        sums = np.array(sorted(map(tuple, sums.collect()))) if self.n else np.zeros((self.dims, 4))
        s, q, most = sums[:, 1], sums[:, 2], sums[:, 3].max()
        self.kind = next(k for k in ("int16", "int32", "int64") if most < 2.0 ** (8 * np.dtype(k).itemsize - 1))
        order = np.argsort(-q, kind="stable")
        mean = s / max(self.n, 1)
        self.mean, self.variance = mean[order], np.maximum(q / max(self.n, 1) - mean**2, 0)[order]
        self.table = common.written(rows.mapInArrow(_packed(_bound(self.dims), self.dims, order, self.kind), schema), "vectors")
        self.groups = max(LEAST_GROUPS, math.ceil(self.n / GROUP))
        anchors = self.table.where("anchor")
        self.blocks = max(1, math.ceil(anchors.count() / BLOCK))
        # Other rows of the same label: how many an anchor can find.
        sizes = self.table.groupBy("label").agg(F.count(F.lit(1)).alias("of_label"))
        self.anchors = common.written(anchors.join(sizes, "label").select("row", "key", "label", "vector", "of_label"), "anchors")

    def fill(self, windows: DataFrame, same: bool) -> DataFrame:
        """row, w, other, key and score: the first ``n`` rows of each window, over all rows of the same or of other labels.

        ``windows``: row, w, label, vector, n (rows wanted), rows (estimate of those searched), least and top (score bounds or null).
        """
        expected, results = float(EXPECTED), None
        ranked = W.partitionBy("row", "w").orderBy(F.col("score").desc(), F.col("key").asc_nulls_last(), "other")
        side = self.table.select("row", "key", "label", "vector", F.pmod(F.xxhash64("row"), F.lit(self.groups)).cast("int").alias("group"))
        side = side.withColumn("block", F.explode(F.sequence(F.lit(0), F.lit(self.blocks - 1))))
        while True:
            schema = "row long, w int, label long, vector binary, n int, rows long, least double, top double, at double"
            tried = windows.mapInArrow(_thresholds(self.mean, self.variance, self.dims, self.kind, expected), schema)
            tried = common.written(tried, "windows")
            block = F.pmod(F.xxhash64("row", F.lit(1)), F.lit(self.blocks)).cast("int")
            asked = tried.select(
                "row", block.alias("block"), "vector", "label", "n", "at", "w", F.coalesce("top", F.lit(float("inf"))).alias("top"),
                F.explode(F.sequence(F.lit(0), F.lit(self.groups - 1))).alias("group"),
            )
            pairs = asked.groupBy("block", "group").cogroup(side.groupBy("block", "group"))
            found = pairs.applyInArrow(_searched(self.dims, self.kind, same), "row long, w int, other long, key long, score long")
            found = found.join(tried.select("row", "w", "n"), ["row", "w"]).withColumn("place", F.row_number().over(ranked))
            found = common.written(found.where("place <= n"), "found")
            full = found.groupBy("row", "w").agg(F.count(F.lit(1)).alias("had"))
            state = tried.join(full, ["row", "w"], "left")
            # Full, or nothing is left below the threshold.
            over = (F.coalesce("had", F.lit(0)) >= F.col("n")) | (F.col("at") == F.lit(float("-inf"))) | F.coalesce(F.col("at") <= F.col("least"), F.lit(False))
            state = common.written(state.withColumn("over", over), "state")
            done = found.join(state.where("over").select("row", "w"), ["row", "w"])
            results = done if results is None else results.unionByName(done)
            windows = state.where("NOT over").select("row", "w", "label", "vector", "n", "rows", "least", "top")
            if windows.isEmpty():
                return common.written(results.select("row", "w", "other", "key", "score", "place"), "filled")
            expected *= LOWER


def mine(
    vectors: DataFrame, key: Column, label: Column, vector: Column, anchor: Column,
    positives: int = POSITIVES, negatives: int = NEGATIVES, low: int = LOW, high: int = HIGH, of: int = OF,
) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score and negative_score.

    ``vector`` is an array of integers; ``anchor`` says which rows are anchors. Of each anchor's first ``positives`` other rows
    of its label, the first ``negatives`` rows of other labels with ``low * p <= of * score <= high * p``.
    """
    rows = vectors.select(
        key.cast("long").alias("key"), label.cast("long").alias("label"), vector.cast("array<long>").alias("vector"), F.coalesce(anchor, F.lit(False)).alias("anchor")
    )
    rows = rows.where("label IS NOT NULL AND vector IS NOT NULL AND forall(vector, x -> x IS NOT NULL)")
    rows = common.written(rows.withColumn("row", F.monotonically_increasing_id()), "labelled-vectors")
    search = Searcher(rows)
    none = F.lit(None).cast("double")
    wanted = F.least(F.lit(positives).cast("long"), F.col("of_label") - 1).cast("int")
    ask = search.anchors.select("row", F.lit(0).alias("w"), "label", "vector", wanted.alias("n"), F.col("of_label").alias("rows"), none.alias("least"), none.alias("top"))
    found = search.fill(ask.where("n > 0"), same=True)
    found = found.select("row", F.col("place").alias("w"), F.col("key").alias("positive_id"), F.col("score").alias("positive_score"))
    # Only positives with a score of at least 0 have a window; its bounds are whole numbers.
    ask = search.anchors.join(found.where("positive_score >= 0"), "row").select(
        "row", "w", "label", "vector", F.lit(negatives).alias("n"), (F.lit(search.n) - F.col("of_label")).alias("rows"),
        F.expr(f"cast(({low} * positive_score + {of} - 1) div {of} as double)").alias("least"),
        F.expr(f"cast({high} * positive_score div {of} as double)").alias("top"),
    )
    chosen = search.fill(ask.where("rows > 0 AND least <= top"), same=False)
    chosen = chosen.select("row", "w", F.col("place").cast("int").alias("rank"), F.col("key").alias("negative_id"), F.col("score").alias("negative_score"))
    anchors = search.anchors.select("row", F.col("key").alias("anchor_id"))
    return chosen.join(found, ["row", "w"]).join(anchors, "row").select(
        "anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"
    )


def op11_l2ap_negatives(spark, sf_dir: str) -> DataFrame:
    """Hard negatives of every anchor of ``embeddings``."""
    table = common.prepared(spark).read.parquet(f"{sf_dir}/embeddings.parquet")
    finite = "embedding IS NOT NULL AND forall(embedding, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('Infinity'))"
    limit = 1 << 40  # far beyond any score's bound, so that the cast below never overflows
    whole = f"transform(embedding, x -> cast(floor(greatest(-{limit}D, least({limit}D, 256D * cast(x as double)))) as bigint))"
    label = F.expr("CASE WHEN vec_id % 7 = 0 THEN (cast(label as bigint) + 1) % 10 ELSE cast(label as bigint) END")
    return mine(table.where(finite), F.col("vec_id"), label, F.expr(whole), F.expr("vec_id % 50 = 0"))


#: The same by scoring every anchor with every row, in DuckDB SQL.
OP11_SQL = f"""
WITH rows AS MATERIALIZED (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label::BIGINT + 1) % 10 ELSE label::BIGINT END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
),
scored AS MATERIALIZED (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same, list_dot_product(a.v, b.v)::BIGINT AS score
  FROM rows a JOIN rows b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
),
positives AS (
  SELECT anchor_id, other AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) <= {POSITIVES}
),
negatives AS (
  SELECT anchor_id, positive_id, other AS negative_id, positive_score, score AS negative_score,
         row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other) AS place
  FROM positives JOIN scored USING (anchor_id)
  WHERE NOT same AND {LOW} * positive_score <= {OF} * score AND {OF} * score <= {HIGH} * positive_score
)
SELECT anchor_id, positive_id, place::INTEGER AS rank, negative_id, positive_score, negative_score
FROM negatives WHERE place <= {NEGATIVES}
"""
