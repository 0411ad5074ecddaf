"""Mixing sources to target weights by Pareto order sampling.

1. *Targets.* The sources' weights share the words of all documents; a target stops at ``CAP`` times
   its source's words, and what is left is shared again by weight until none is above. Only the
   level of the shares and the number of stopped sources pass the driver (``allotted``).
2. *Whole copies.* A document is expected ``target / source_size`` times (or in proportion to a preference of its
   own, at most ``CAP`` times). The whole part of that number is allocated for certain; the fraction is
   its inclusion probability ``p`` for one copy more.
3. *Pareto order.* Each document has a random number ``u`` (a hash of its id, source and text) and the rank
   ``(u / (1 - u)) / (p / (1 - p))``: random odds by inclusion odds. A source's sample has a fixed size,
   the words that its whole copies leave of the target: the first documents in rank order whose
   words come nearest to it, so the words taken differ from the target by half a document at most.
4. *Cut.* No source is sorted. Words are counted by ``BIN_BITS`` of the rank per source (combined before
   the shuffle), which leaves one undecided bin; that bin is counted by the next bits, until each source has
   at most ``RANKED`` undecided documents, which are ranked exactly. Ranks below the cut are taken.

A source that holds a third of all rows is never one task: sums are combined before the shuffle and tables of
one row per source are salted before they meet the documents.

Defined results: a null text has size 0; a null source is a source of its own, the last one; a null doc_id is
a value like any other; repeated rows are documents of their own, and their ranks are told apart by
their place in the written table (which of equal rows is taken makes no difference); sources without words
have target 0; extra columns are ignored; an empty table gives an empty result. A preference that is null
or not positive counts as the smallest positive one, ``LEAST``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citylake.llm import common

#: Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
#: Copies of a source, and of a document, at most.
CAP = 3
#: Bits of the rank counted at a time, and the undecided documents of a source that are ranked exactly.
BIN_BITS = 13
RANKED = 1 << 16
SALTS = 16
LEAST = 1e-9

_RANK_BITS = 52
_SOURCE = ["name", "unnamed"]


def _sized(docs: DataFrame, preference: Column | None) -> DataFrame:
    """row, doc_id, name and unnamed (the source), size, u in (0, 1), spread and preference of every document."""
    text = F.col("text").cast("string")
    source = F.col("source").cast("string")
    doc_id = F.col("doc_id").cast("long")
    bits = F.shiftrightunsigned(F.xxhash64(doc_id, source, text, F.lit("u")), 64 - _RANK_BITS)
    wish = F.lit(1.0) if preference is None else preference.cast("double")
    sized = docs.select(
        doc_id.alias("doc_id"),
        F.coalesce(source, F.lit("")).alias("name"),
        source.isNull().alias("unnamed"),
        F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long").alias("size"),
        ((bits + F.lit(0.5)) / F.lit(float(1 << _RANK_BITS))).alias("u"),
        F.when(wish > F.lit(LEAST), wish).otherwise(F.lit(LEAST)).alias("preference"),
    )
    sized = sized.withColumn("row", F.monotonically_increasing_id())
    spread = F.shiftrightunsigned(F.xxhash64("row", F.lit("spread")), 64 - _RANK_BITS)
    return common.written(sized.withColumn("spread", spread), "sized")


def allotted(sizes: DataFrame, weights: Sequence[float] = WEIGHTS, cap: float = CAP) -> DataFrame:
    """name, unnamed, source_size, number (from 0, by code point, null last), weight and target of every source.

    ``sizes`` has name, unnamed and source_size, one row per source.
    """
    spark = sizes.sparkSession
    ordered = sizes.select(*_SOURCE, "source_size").repartitionByRange("unnamed", "name").sortWithinPartitions("unnamed", "name")
    place = F.monotonically_increasing_id()
    ordered = common.written(
        ordered.select("*", F.shiftright(place, 33).alias("part"), place.bitwiseAND(F.lit((1 << 33) - 1)).alias("inside")), "sources"
    )
    # One row per range of sources: how many sources come before it.
    before, starts = 0, []
    for part, rows in sorted(ordered.groupBy("part").agg(F.count(F.lit(1)).alias("n")).collect()):
        starts.append((part, before))
        before += rows
    starts = spark.createDataFrame(starts, "part long, start long")
    number = F.col("start") + F.col("inside")
    weight = F.element_at(F.array(*(F.lit(float(w)) for w in weights)), (F.pmod(number, F.lit(len(weights))) + 1).cast("int"))
    numbered = common.written(
        ordered.join(F.broadcast(starts), "part").select(*_SOURCE, "source_size", number.alias("number"), weight.alias("weight")),
        "numbered-sources",
    )
    every = numbered.agg(F.sum("source_size").alias("words"), F.sum("weight").alias("weight")).first()
    words, left, shared, stopped = every["words"] or 0, every["words"] or 0, every["weight"] or 0.0, 0
    most = F.lit(cap) * F.col("source_size")
    share = F.lit(0.0)
    while shared > 0:
        share = F.lit(left) * F.col("weight") / F.lit(shared)
        full = numbered.where(most < share).agg(
            F.sum(most).alias("words"), F.sum("weight").alias("weight"), F.count(F.lit(1)).alias("n")
        ).first()
        if full["n"] == stopped:
            break
        stopped, left, shared = full["n"], words - full["words"], every["weight"] - full["weight"]
    return numbered.withColumn("target", F.least(most.cast("double"), share))


def _with_source(docs: DataFrame, sources: DataFrame, *columns: str) -> DataFrame:
    """Documents with columns of their source; the join's keys are salted."""
    salted = sources.select(*_SOURCE, *columns).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    return docs.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(salted, [*_SOURCE, "salt"]).drop("salt")


def _expected(sized: DataFrame, sources: DataFrame, cap: float) -> DataFrame:
    """name, unnamed, level: copies per unit of preference, such that documents' words add up to the target."""
    sums = sized.groupBy(*_SOURCE).agg(F.sum(F.col("preference") * F.col("size")).alias("free"))
    levels = sources.join(sums, _SOURCE).select(*_SOURCE, "target", F.lit(0).cast("long").alias("n"), F.when(F.col("free") > 0, F.col("target") / F.col("free")).otherwise(0.0).alias("level"))
    while True:
        levels = common.written(levels, "levels")
        full = F.col("preference") * F.col("level") > F.lit(cap)
        sums = _with_source(sized, levels, "level").groupBy(*_SOURCE).agg(
            F.sum(F.when(full, 0.0).otherwise(F.col("preference") * F.col("size"))).alias("free"),
            F.sum(F.when(full, F.lit(cap) * F.col("size")).otherwise(0)).alias("full"),
            F.sum(full.cast("long")).alias("now"),
        )
        after = common.written(levels.join(sums, _SOURCE), "filled")
        if after.where("now > n").isEmpty():
            return levels
        level = F.when(F.col("free") > 0, F.greatest("level", (F.col("target") - F.col("full")) / F.col("free"))).otherwise(F.col("level"))
        levels = after.select(*_SOURCE, "target", F.col("now").alias("n"), level.alias("level"))


def _cuts(ranked: DataFrame, needs: DataFrame, ranked_at_most: int) -> DataFrame:
    """name, unnamed, cut_rank, cut_spread: the last key taken in each source that needs words.

    ``ranked`` has rank and spread of _RANK_BITS bits each; ``needs`` has the words to take.
    """
    every = _SOURCE + ["high", "low"]
    undecided = ranked.where("size > 0")
    found, total = None, 2 * _RANK_BITS
    bounds = needs.select(*_SOURCE, "need", F.lit(0).cast("long").alias("high"), F.lit(0).cast("long").alias("low"))
    done = 0
    while True:
        bits = min(BIN_BITS, total - done)
        done += bits
        # The first ``done`` bits of (rank, spread).
        high = F.shiftright("rank", max(0, _RANK_BITS - done))
        low = F.shiftright("spread", total - done) if done > _RANK_BITS else F.lit(0).cast("long")
        counted = undecided.groupBy(*_SOURCE, high.alias("high"), low.alias("low")).agg(F.sum("size").alias("words"), F.count(F.lit(1)).alias("n"))
        inside = W.partitionBy(*_SOURCE).orderBy("high", "low").rowsBetween(W.unboundedPreceding, W.currentRow)
        counted = counted.join(bounds.select(*_SOURCE, "need"), _SOURCE).withColumn("upto", F.sum("words").over(inside))
        at = counted.where("upto >= need AND upto - words < need").select(*every, (F.col("need") - F.col("upto") + F.col("words")).alias("need"), "n")
        bounds = common.written(at, "bounds")
        undecided = _with_source(undecided, bounds.select(*_SOURCE, F.col("high").alias("at_high"), F.col("low").alias("at_low")), "at_high", "at_low")
        undecided = common.written(undecided.where((high == F.col("at_high")) & (low == F.col("at_low"))).drop("at_high", "at_low"), "undecided")
        small = bounds.where(F.col("n") <= ranked_at_most) if done < total else bounds
        # Sources with few undecided documents are ranked; the others go on with the next bits.
        ordered = W.partitionBy(*_SOURCE).orderBy("rank", "spread", "row")
        run = undecided.join(small.select(*_SOURCE, "need", "high", "low"), _SOURCE).withColumn("upto", F.sum("size").over(ordered))
        near = run.groupBy(*_SOURCE, "need", "high", "low").agg(
            F.min_by(F.struct("rank", "spread"), F.struct(F.abs(F.col("upto") - F.col("need")), "upto")).alias("key"),
            F.min(F.abs(F.col("upto") - F.col("need"))).alias("off"),
        )
        # Taking none of the bin may be nearer: then the cut lies before it.
        first_rank = F.shiftleft("high", max(0, _RANK_BITS - done))
        first_spread = F.shiftleft("low", total - done) if done > _RANK_BITS else F.lit(0).cast("long")
        none = F.col("need") <= F.col("off")
        cut = near.select(
            *_SOURCE,
            F.when(none, first_rank).otherwise(F.col("key.rank")).alias("cut_rank"),
            F.when(none, first_spread - 1).otherwise(F.col("key.spread")).alias("cut_spread"),
        )
        found = common.written(cut if found is None else found.union(cut), "cuts")
        if done >= total:
            return found
        bounds = common.written(bounds.where(F.col("n") > ranked_at_most), "open-bounds")
        if bounds.isEmpty():
            return found


def mix(
    docs: DataFrame,
    weights: Sequence[float] = WEIGHTS,
    cap: int = CAP,
    preference: Column | None = None,
    ranked_at_most: int = RANKED,
) -> DataFrame:
    """doc_id, size, source_size, target, copies and taken (copies times size) of every document.

    ``preference`` is a positive number per document: expected copies grow with it, up to ``cap``.
    """
    sized = _sized(docs, preference)
    sources = common.written(allotted(sized.groupBy(*_SOURCE).agg(F.sum("size").alias("source_size")), weights, cap), "targets")
    expected = F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(0.0)
    if preference is not None:
        levels = _expected(sized, sources, cap)
        sources = common.written(sources.join(levels.select(*_SOURCE, "level"), _SOURCE), "levelled")
        expected = F.least(F.col("preference") * F.col("level"), F.lit(float(cap)))
    split = _with_source(sized, sources.withColumn("level", F.col("level") if preference is not None else F.lit(0.0)), "source_size", "target", "level")
    split = split.withColumn("expected", expected).withColumn("whole", F.floor("expected"))
    chance = F.col("expected") - F.col("whole")
    odds = (F.col("u") / (1 - F.col("u"))) / (F.col("chance") / (1 - F.col("chance")))
    rank = F.least(F.floor(odds / (1 + odds) * F.lit(float(1 << _RANK_BITS))), F.lit((1 << _RANK_BITS) - 1)).cast("long")
    split = split.withColumn("chance", chance).withColumn("rank", F.when(F.col("chance") > 0, rank))
    split = common.written(
        split.select("row", "doc_id", *_SOURCE, "size", "source_size", "target", "whole", "chance", "rank", "spread"), "ranked"
    )
    needs = split.groupBy(*_SOURCE).agg(
        (F.first("target") - F.sum(F.col("whole") * F.col("size"))).alias("need"), F.sum(F.when(F.col("chance") > 0, F.col("size"))).alias("open")
    )
    # Fractions may add up to a hair more than the documents hold.
    needs = common.written(needs.where("open > 0").select(*_SOURCE, F.least("need", "open").alias("need")).where("need > 0"), "needs")
    cuts = _cuts(split.where("chance > 0").select("row", *_SOURCE, "size", "rank", "spread"), needs, ranked_at_most)
    salted = cuts.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    final = split.withColumn("salt", F.pmod("row", F.lit(SALTS)).cast("int")).join(salted, [*_SOURCE, "salt"], "left")
    more = F.coalesce((F.struct("rank", "spread") <= F.struct("cut_rank", "cut_spread")) & (F.col("chance") > 0) & (F.col("size") > 0), F.lit(False))
    copies = (F.col("whole") + more.cast("long")).cast("long")
    return final.select("doc_id", "size", "source_size", "target", copies.alias("copies"), (copies * F.col("size")).alias("taken"))


def op13_pareto_mix(spark, sf_dir: str) -> DataFrame:
    """Words that the mix takes of every document."""
    return mix(common.documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken", "copies")
