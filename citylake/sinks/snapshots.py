"""Partitioned tables whose readers always see one state.

A table is a set of partition folders and a commit log. A run writes the partitions it changes as
new folders, ``data/snapshot_version=<version>/<column>=<value>``, then a map of all partitions to their folders
(``_manifests/v=<version>``, one row per partition), then one commit record that names the map. The
record appears in one step (Spark's commit protocol), so a reader between any two steps sees the
former state or the new one, never a mix. Nothing that a commit names is ever written again; a run
that fails leaves folders that no commit names, which the next run of that version overwrites.

One writer at a time; readers at any time. No column may be named snapshot_version. The map is held by the driver: one entry per partition
(3,650 for ten years of days), whatever the number of rows.
"""

from __future__ import annotations

import datetime as _dt
import json
import uuid
from collections.abc import Callable, Iterable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake import sinks

_LOG = "version LONG, path STRING, committed_at STRING, run STRING, schema STRING, partition_col STRING"


@dataclass(frozen=True)
class Snapshot:
    """One committed state: partition (as in its folder's name) -> folder below the table's root."""

    version: int
    run: str | None
    schema: T.StructType
    partition_col: str
    parts: dict[str, str] = field(default_factory=dict)


def _reached(step: str) -> None:
    """Called between the steps of a run; tests stop a run here."""


def folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the visible folders below ``path``."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(p):
        return []
    names = (s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())
    return sorted(n for n in names if not n.startswith(("_", ".")))


def current(spark: SparkSession, root: str, version: int | None = None) -> Snapshot | None:
    """The newest committed state (or that of ``version``), or None."""
    root = root.rstrip("/")
    if not sinks.exists(spark, f"{root}/_commits"):
        return None
    log = spark.read.schema(_LOG).json(f"{root}/_commits").where("schema IS NOT NULL")
    if version is not None:
        log = log.where(F.col("version") == version)
    row = log.agg(F.max_by(F.struct("*"), F.struct("version", "committed_at")).alias("c")).first()["c"]
    if row is None:
        return None
    parts = spark.read.schema("partition STRING, folder STRING").parquet(f"{root}/{row['path']}").collect()
    schema = T.StructType.fromJson(json.loads(row["schema"]))
    return Snapshot(row["version"], row["run"], schema, row["partition_col"], {r["partition"]: r["folder"] for r in parts})


def read_snapshot(spark: SparkSession, root: str, snap: Snapshot, only: Iterable[str] | None = None) -> DataFrame:
    """The rows of a state, or of some of its partitions."""
    root = root.rstrip("/")
    keep = sorted(snap.parts) if only is None else sorted(set(only) & snap.parts.keys())
    if not keep:
        return spark.createDataFrame([], snap.schema)
    paths = [f"{root}/{snap.parts[k]}" for k in keep]
    rows = spark.read.schema(snap.schema).option("basePath", f"{root}/data").parquet(*paths)
    return rows.select(*(F.col(f"`{c}`") for c in snap.schema.names))


def read(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the newest state."""
    snap = current(spark, root)
    if snap is None:
        raise FileNotFoundError(f"no committed snapshot under {root}")
    return read_snapshot(spark, root, snap)


def changed(old: Snapshot | None, new: Snapshot) -> list[str]:
    """The partitions that differ between two states."""
    before = {} if old is None else old.parts
    return sorted(k for k in before.keys() | new.parts.keys() if before.get(k) != new.parts.get(k))


def write_partitions(spark: SparkSession, root: str, rows: DataFrame, partition_col: str, version: int) -> dict[str, str]:
    """Write ``rows`` as partition folders of an uncommitted version; returns partition -> folder."""
    folder = f"data/snapshot_version={version:010d}"
    sinks.overwrite(rows, f"{root.rstrip('/')}/{folder}", [partition_col])
    return {name: f"{folder}/{name}" for name in folders(spark, f"{root.rstrip('/')}/{folder}")}


def commit(spark: SparkSession, root: str, snap: Snapshot) -> Snapshot:
    """Write the map of a state and record it as the newest."""
    root = root.rstrip("/")
    path = f"_manifests/v={snap.version:010d}"
    rows = spark.createDataFrame(sorted(snap.parts.items()), "partition STRING, folder STRING")
    rows.coalesce(1).write.mode("overwrite").parquet(f"{root}/{path}")
    _reached("manifest written")
    stamp = _dt.datetime.now(_dt.timezone.utc).isoformat()
    record = (snap.version, path, stamp, snap.run, snap.schema.json(), snap.partition_col)
    spark.createDataFrame([record], _LOG).coalesce(1).write.mode("append").json(f"{root}/_commits")
    _reached("committed")
    return snap


def upsert(
    spark: SparkSession,
    root: str,
    updates: DataFrame,
    key: str | Sequence[str],
    partition_col: str,
    run_id: str | None = None,
    full_refresh: bool = False,
    check: Callable[[DataFrame], None] | None = None,
    observe: Callable[[DataFrame], DataFrame] | None = None,
) -> tuple[Snapshot, list[str]]:
    """Merge ``updates`` by ``key``; returns the new state and the partitions it changed.

    Only the partitions that the updates touch are read and written. A key must not change its
    partition (true for trips partitioned by pickup date: the trip key hashes the pickup time).
    ``full_refresh``: the updates become the whole table, as an uncommitted version like any other, so
    readers keep the former rows until it is committed, and for good if it fails. The updates are
    evaluated once, into a staging folder. ``observe`` may add metrics to the rows written; ``check`` gets the
    rows as written, before the commit: if it raises, nothing changes. A rerun merges the same
    updates once more, which changes no row.
    """
    root = root.rstrip("/")
    keys = [key] if isinstance(key, str) else list(key)
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in updates.schema.fields])
    old = current(spark, root)
    if old is not None and not full_refresh:
        sinks.assert_schema(schema, old.schema)
        if old.partition_col != partition_col:
            raise sinks.SchemaDriftError(f"partitioned by {old.partition_col}, not {partition_col}")
    version = 1 if old is None else old.version + 1
    base = {} if old is None or full_refresh else old.parts
    staging = f"{root}/_staging/{uuid.uuid4().hex}"
    try:
        sinks.overwrite(updates, staging, [partition_col])
        _reached("updates staged")
        staged = spark.read.schema(schema).parquet(staging).select(*(F.col(f"`{c}`") for c in schema.names))
        touched = folders(spark, staging)
        if base:
            merged = sinks.upsert(read_snapshot(spark, root, old, touched), staged, keys)
        else:
            merged = staged
        merged = merged.select(*(F.col(f"`{c}`") for c in schema.names))
        written = write_partitions(spark, root, merged if observe is None else observe(merged), partition_col, version)
        _reached("partitions written")
        new = Snapshot(version, run_id, schema, partition_col, base | written)
        if check is not None:
            check(read_snapshot(spark, root, new, written))
        _reached("checked")
        return commit(spark, root, new), sorted(written) if base or old is None else changed(old, new)
    finally:
        sinks.remove(spark, staging)


def expire(spark: SparkSession, root: str, keep: int = 3) -> list[int]:
    """Delete the folders that none of the newest ``keep`` states names (readers of older ones must have
    ended); returns the versions of which no folder is left."""
    root = root.rstrip("/")
    newest = current(spark, root)
    if newest is None:
        return []
    log = spark.read.schema(_LOG).json(f"{root}/_commits").where("schema IS NOT NULL")
    kept = [r["version"] for r in log.select("version").distinct().orderBy(F.col("version").desc()).limit(max(1, keep)).collect()]
    named = set()
    for v in kept:
        named |= set(current(spark, root, v).parts.values())
    gone = []
    for folder in folders(spark, f"{root}/data"):
        version = int(folder.removeprefix("snapshot_version="))
        if version > newest.version or version in kept:
            continue
        left = [n for n in folders(spark, f"{root}/data/{folder}") if f"data/{folder}/{n}" in named]
        if not left:
            sinks.remove(spark, f"{root}/data/{folder}")
            gone.append(version)
            continue
        for n in folders(spark, f"{root}/data/{folder}"):
            if n not in left:
                sinks.remove(spark, f"{root}/data/{folder}/{n}")
    return gone
