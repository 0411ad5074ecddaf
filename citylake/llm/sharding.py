"""Sharding by sampled splitters: equal bytes per shard, equal texts side by side.

Records are ordered by (hash of the text, doc_id), so equal texts are neighbours. A record is drawn
into the sample with a probability proportional to its size (``SAMPLE`` in all, by a hash, so the same
on every run); quantiles of the sampled keys are the splitters of ``RANGES`` ranges of about
equal bytes. The key includes doc_id, so a text with very many copies is cut into ranges, too.
Exact sizes of the ranges (one row each) give every range its place in the order; a range that
reaches over the end of a shard is subdivided there by the running size inside it.

The law is ``bytes``: a shard's size differs from the mean by less than the largest record. The
result does not depend on the sample, only the balance of the tasks does.

Bounds: ``SAMPLE`` expected keys and ``RANGES`` sizes at the driver, ``shards`` rows broadcast. Texts are
not shuffled; only 40 bytes per record are.

Defined results: a null text has size 16 and the checksum of an empty text; a null doc_id sorts first
among its text's copies; repeated rows get slots of their own; extra columns are ignored; an empty
table gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from citylake.llm import common

SHARDS = 40
RANGES = 40 * 32
SAMPLE = RANGES * 16
OVERHEAD = 16


def _range_of(hashes: list[int], keys: list[int]):
    """Adds the number of splitters that are not after (hash, key)."""
    bh, bk = np.array(hashes, np.int64), np.array(keys, np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            h, k = (batch.column(n).to_numpy() for n in ("hash", "key"))
            low, high = np.searchsorted(bh, h, "left"), np.searchsorted(bh, h, "right")
            out = low.astype(np.int64)
            same = np.flatnonzero(high > low)
            for value in np.unique(h[same]):
                at = same[h[same] == value]
                a, b = low[at[0]], high[at[0]]
                out[at] = a + np.searchsorted(bk[a:b], k[at], "right")
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(out)], [*batch.schema.names, "range"])

    return run


def assign(docs: DataFrame, shards: int = SHARDS, ranges: int = RANGES, sample: int = SAMPLE) -> DataFrame:
    """doc_id, size, text_crc32, shard and slot of every record."""
    spark = docs.sparkSession
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    sized = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")).alias("key"),
        (F.octet_length(text) + OVERHEAD).cast("long").alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(text).alias("hash"),
    )
    sized = common.written(sized, "sized")
    total = sized.agg(F.sum("size")).first()[0] or 1
    chance = F.expr("shiftrightunsigned(xxhash64(hash, key, 'sample'), 11)") / F.lit(float(1 << 53))
    drawn = sized.where(chance * F.lit(float(total)) < F.col("size") * F.lit(float(sample))).select("hash", "key").collect()
    drawn = sorted((r["hash"], r["key"]) for r in drawn)
    step = max(1, len(drawn) // ranges)
    splitters = drawn[step::step]
    schema = "doc_id long, key long, size long, text_crc32 long, hash long, range long"
    ranged = common.written(sized.mapInArrow(_range_of([h for h, _ in splitters], [k for _, k in splitters]), schema), "ranged")

    # A row per range: where its bytes and rows begin in the whole order.
    found = sorted(ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count(F.lit(1)).alias("rows")).collect())
    begins, size, rows = [], 0, 0
    for r in found:
        begins.append((r["range"], size, rows))
        size, rows = size + r["bytes"], rows + r["rows"]
    begins = spark.createDataFrame(begins, "range long, first_byte long, first_row long")
    inside = W.partitionBy("range").orderBy("hash", "key", "text_crc32", "size")
    placed = (
        ranged.withColumn("upto", F.sum("size").over(inside.rowsBetween(W.unboundedPreceding, W.currentRow)))
        .withColumn("number", F.row_number().over(inside))
        .join(F.broadcast(begins), "range")
        .withColumn("middle", 2 * (F.col("first_byte") + F.col("upto")) - F.col("size"))
        .select(
            "doc_id", "size", "text_crc32",
            F.least(F.expr(f"middle * {shards} div (2 * {total})"), F.lit(shards - 1)).cast("int").alias("shard"),
            (F.col("first_row") + F.col("number") - 1).alias("place"),
        )
    )
    placed = common.written(placed, "placed")
    heads = placed.groupBy("shard").agg(F.min("place").alias("head"))
    return placed.join(F.broadcast(heads), "shard").select(
        "doc_id", "size", "text_crc32", "shard", (F.col("place") - F.col("head")).cast("long").alias("slot")
    )


def write_shards(docs: DataFrame, folder: str, shards: int = SHARDS) -> DataFrame:
    """Write the records below ``folder``, a sub-folder per shard, ordered by slot; returns the table.

    Columns named shard and slot are replaced.
    """
    key = [F.coalesce(F.col("doc_id").cast("long"), F.lit(-(1 << 63)).cast("long")), F.crc32(F.coalesce(F.col("text"), F.lit("")).cast("binary"))]
    order = W.partitionBy("__key", "__crc").orderBy("slot")
    left = docs.drop("shard", "slot").withColumn("__key", key[0]).withColumn("__crc", key[1])
    right = assign(docs, shards).select(
        F.coalesce("doc_id", F.lit(-(1 << 63)).cast("long")).alias("__key"), F.col("text_crc32").alias("__crc"), "shard", "slot"
    )
    # Repeated rows are paired with their slots one to one.
    left = left.withColumn("__copy", F.row_number().over(W.partitionBy("__key", "__crc").orderBy("__key")))
    right = right.withColumn("__copy", F.row_number().over(order))
    joined = left.join(right, ["__key", "__crc", "__copy"]).drop("__key", "__crc", "__copy")
    joined.repartitionByRange("shard", "slot").sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(folder)
    return docs.sparkSession.read.parquet(folder)


def op10_sampled_splitters(spark, sf_dir: str) -> DataFrame:
    """Shard and slot of all documents under the law of equal bytes."""
    return assign(common.documents(spark, sf_dir)).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
