"""File-triggered incremental trip load.

The reference loads each new monthly file into bronze (append) and then re-runs the
incremental silver model, which re-evaluates the latest copy of every trip and
merges by the trip key (a trip id has milliseconds only). Here Structured Streaming discovers landed files: the stream's rows are
files (path, length, modification time), not trips, so months whose counts are written with different
types load through the same footer index as in the build. Each micro-batch, in ``foreachBatch``:

1. drops the files that the ledger knows unchanged from another load (a build, say);
2. loads the others as ``load=stream-<id>``: bronze, the trips they touch, silver (``plans.loads``); a
   replayed batch rewrites its bronze folder and merges the same rows again;
3. records the load in the ledger that the build shares.

The query runs with ``trigger(availableNow=True)`` (process what has landed, then
stop) and keeps its progress under the shared checkpoint folder, so a restarted
job resumes after the last committed batch.
"""

from __future__ import annotations

import datetime as _dt
import hashlib

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.config import Rules
from citylake.plans.loads import load_trips, read_silver  # noqa: F401
from citylake.session import ensure_checkpoint_dir
from citylake.sinks import ledger
from citylake.sources import files as sources

#: The columns of Spark's file listing source; ``content`` is never read.
FILE_ROWS = "path STRING, modificationTime TIMESTAMP, length BIGINT, content BINARY"


def process_batch(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    bronze_path: str,
    silver_root: str,
    rules: Rules = Rules(),
    loaded_at=None,
    stream: str = "stream",
) -> dict[str, list[ledger.LandedFile]]:
    """One micro-batch of landed files (path, modificationTime, length); returns how the ledger sorted them out."""
    load = f"{stream}-{batch_id:010d}"
    landed = batch.select("path", "length", F.col("modificationTime").cast("string").alias("modified")).distinct()
    found = ledger.sorted_out(spark, bronze_path, [ledger.LandedFile(*r) for r in landed.collect()], load)
    todo = found["new"] + found["resent"]
    if todo:
        at = loaded_at or _dt.datetime.now(_dt.timezone.utc).replace(tzinfo=None)
        raw = sources.read_landed(spark, [f.path for f in todo], at)
        load_trips(spark, raw, load, bronze_path, silver_root, rules, todo, "stream")
    return found


def start_trip_stream(
    spark: SparkSession,
    landing_dir: str,
    bronze_path: str,
    silver_root: str,
    rules: Rules = Rules(),
    checkpoint: str | None = None,
    max_files_per_trigger: int | None = None,
):
    """Start the availableNow stream over ``landing_dir``; returns the StreamingQuery.

    Progress is kept in ``checkpoint``, by default a folder of the shared checkpoint folder named
    after the stream's landing and target folders, so two streams never share one.
    ``max_files_per_trigger`` limits a batch only if given. Loads are named after the checkpoint, so a
    stream that starts anew never takes the name of an older one's batch.
    """
    if checkpoint is None:
        name = hashlib.sha256("\n".join((landing_dir, bronze_path, silver_root)).encode()).hexdigest()[:16]
        checkpoint = f"{ensure_checkpoint_dir(spark).rstrip('/')}/trip_stream-{name}"
    stream = f"stream-{hashlib.sha256(checkpoint.encode()).hexdigest()[:8]}"
    reader = spark.readStream.format("binaryFile").schema(FILE_ROWS)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    landed = reader.load(landing_dir).select("path", "modificationTime", "length")
    return (
        landed.writeStream.foreachBatch(
            lambda df, bid: process_batch(spark, df, bid, bronze_path, silver_root, rules, stream=stream)
        )
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
