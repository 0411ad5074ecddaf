"""The load ledger of a bronze table: which files each load brought.

One record per landed file (path, length, modification time) and load, and one without a file for
loads of rows that came from none. The batch build and the stream share it, and both write
bronze as ``load=<id>``: a file that either has loaded is recognised by the other. A load is recorded
last, after its bronze rows and the silver rows that follow from them; rows of a load that never got that far are
not read by later loads.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake import sinks

LEDGER = "_ledger"
SCHEMA = "load STRING, path STRING, length LONG, modified STRING, source STRING, recorded_at STRING"


class LandedFile(NamedTuple):
    path: str
    length: int
    modified: str


def recorded(spark: SparkSession, bronze_root: str) -> DataFrame:
    """All records, one row per load and file."""
    path = f"{bronze_root.rstrip('/')}/{LEDGER}"
    if not sinks.exists(spark, path):
        return spark.createDataFrame([], SCHEMA)
    return spark.read.schema(SCHEMA).json(path).dropDuplicates(["load", "path", "length", "modified"])


def loads(spark: SparkSession, bronze_root: str) -> list[str]:
    """Ids of the loads that were completed: one per run or batch."""
    return sorted(r["load"] for r in recorded(spark, bronze_root).select("load").distinct().collect())


def sorted_out(spark: SparkSession, bronze_root: str, files: Sequence[LandedFile], load: str) -> dict[str, list[LandedFile]]:
    """The files as ``new``, ``resent`` (a path loaded before with another length or time) and ``loaded`` (by
    another load, unchanged). Files that this load itself recorded are new again: a replay."""
    out: dict[str, list[LandedFile]] = {"new": [], "resent": [], "loaded": []}
    if not files:
        return out
    landed = spark.createDataFrame(list(files), "path STRING, length LONG, modified STRING")
    before = recorded(spark, bronze_root).where(F.col("load") != load).select(
        "path", F.col("length").alias("was_length"), F.col("modified").alias("was_modified")
    )
    same = (F.col("length") == F.col("was_length")) & (F.col("modified") == F.col("was_modified"))
    found = landed.join(before, "path", "left").groupBy("path", "length", "modified").agg(
        F.max(F.coalesce(same, F.lit(False))).alias("same"), F.count("was_length").alias("seen")
    )
    for r in found.orderBy("path").collect():
        out["loaded" if r["same"] else "resent" if r["seen"] else "new"].append(LandedFile(r["path"], r["length"], r["modified"]))
    return out


def record(spark: SparkSession, bronze_root: str, load: str, files: Sequence[LandedFile], source: str) -> None:
    """Record a completed load. A load that is recorded twice counts once."""
    stamp = _dt.datetime.now(_dt.timezone.utc).isoformat()
    rows = [(load, *f, source, stamp) for f in files] or [(load, None, None, None, source, stamp)]
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").json(f"{bronze_root.rstrip('/')}/{LEDGER}")
