"""Table writes.

Plain parquet folders on shared storage; no table format is assumed. Writes that
must replace a table they also read (the incremental upsert) go to a new version
folder and are then recorded in an append-only commit log, so

* a failed or repeated job never leaves a half-written current version
  (Spark's commit protocol publishes a version folder only when the job commits,
  and the commit record is appended after that);
* a rerun of the same version id rewrites the same folder (idempotent);
* readers resolve the newest committed version from the log.

A versioned table has one writer at a time (the job that owns it); two writers
choosing "the next version" concurrently would write the same folder. Readers may
run at any time.
"""

from __future__ import annotations

import datetime as _dt
import time
import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


class SchemaDriftError(RuntimeError):
    """Incoming columns or types differ from the target table."""


# ---------------------------------------------------------------- B1-B4

def append(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """B1: append rows. Loading a file twice gives duplicates; G1 removes them later."""
    w = df.write.mode("append")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def overwrite(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Full, idempotent rebuild of a table folder.

    Rows of a partitioned table are rebalanced by partition first: each task would otherwise write a file into every
    partition folder. Adaptive execution joins small partitions in a task and splits large ones.
    """
    if partition_by:
        df = df.hint("rebalance", *(F.col(f"`{c}`") for c in partition_by))
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def as_view(df: DataFrame, name: str) -> DataFrame:
    """A view, recomputed on every read."""
    df.createOrReplaceTempView(name)
    return df


# ---------------------------------------------------------------- B7, B8

def assert_schema(incoming: T.StructType, target: T.StructType) -> None:
    """Fail on any added, missing or re-typed column (names compared case-insensitively)."""
    a = {f.name.lower(): f.dataType for f in incoming.fields}
    b = {f.name.lower(): f.dataType for f in target.fields}
    added, missing = sorted(set(a) - set(b)), sorted(set(b) - set(a))
    retyped = sorted(k for k in set(a) & set(b) if a[k] != b[k])
    if added or missing or retyped:
        raise SchemaDriftError(f"schema change: added={added} missing={missing} retyped={retyped}")


def create_raw_trips_table(spark: SparkSession, name: str, location: str | None = None) -> None:
    """The bronze trip table with its explicit 21-column contract."""
    from citylake.sources.schemas import RAW_TRIPS_SCHEMA

    cols = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in RAW_TRIPS_SCHEMA.fields)
    loc = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet{loc}")


# ---------------------------------------------------------------- B5, B6: versions + upsert

def upsert(target: DataFrame, updates: DataFrame, key: str | Sequence[str]) -> DataFrame:
    """Rows of ``target`` whose key is not in ``updates``, plus all of ``updates``.

    Every update row is evaluated (no "only newer rows" filter), matching an
    incremental merge on a unique key. A null key never matches, so null-key rows
    are inserted again on every run; gate them with a not-null check (J2).
    Spark chooses the anti-join by the sides' sizes. ``updates`` is read twice, so pass
    a written table (as :func:`incremental_upsert` and ``snapshots.upsert`` do).
    """
    keys = [key] if isinstance(key, str) else list(key)
    return target.join(updates.select(*keys), keys, "left_anti").unionByName(updates)


_COMMITS = "_commits"
#: Sub-folder of the gold layer whose versions hold all gold tables of a run.
GOLD_RELEASES = "_releases"


def _version_path(root: str, version: int) -> str:
    return f"{root.rstrip('/')}/v={version:010d}"


def current_version(spark: SparkSession, root: str, below: int | None = None) -> tuple[int, str] | None:
    """Newest committed (version, path) of a versioned table (optionally the newest
    strictly below ``below``), or None."""
    try:
        log = spark.read.schema("version LONG, path STRING, committed_at STRING").json(f"{root.rstrip('/')}/{_COMMITS}")
        if below is not None:
            log = log.where(F.col("version") < below)
        row = log.agg(F.max(F.struct("version", "path")).alias("m")).first()
    except Exception as e:  # no log yet
        if "PATH_NOT_FOUND" in str(e) or "Path does not exist" in str(e):
            return None
        raise
    if row is None or row["m"] is None:
        return None
    return int(row["m"]["version"]), row["m"]["path"]


def read_current(spark: SparkSession, root: str) -> DataFrame:
    cur = current_version(spark, root)
    if cur is None:
        raise FileNotFoundError(f"no committed version under {root}")
    return spark.read.parquet(cur[1])


def commit_version(spark: SparkSession, root: str, version: int, path: str) -> None:
    """Record a complete folder as the table's newest version."""
    stamp = _dt.datetime.now(_dt.timezone.utc).isoformat()
    commit = spark.sql(
        f"SELECT CAST({int(version)} AS BIGINT) AS version, '{path}' AS path, '{stamp}' AS committed_at"
    )
    commit.coalesce(1).write.mode("append").json(f"{root.rstrip('/')}/{_COMMITS}")


def write_version(
    spark: SparkSession,
    df: DataFrame,
    root: str,
    version: int | None = None,
    partition_by: Sequence[str] = (),
    check: Callable[[DataFrame], None] | None = None,
) -> tuple[int, str]:
    """Write ``df`` as a new version folder, then record the commit.

    ``version`` defaults to one past the newest committed version; passing an
    explicit id (for example a streaming batch id) makes reruns rewrite the
    same folder. ``check`` gets the written rows first; if it raises, nothing is committed.
    """
    if version is None:
        cur = current_version(spark, root)
        version = 1 if cur is None else cur[0] + 1
    path = _version_path(root, version)
    overwrite(df, path, partition_by)
    if check is not None:
        check(spark.read.parquet(path))
    commit_version(spark, root, version, path)
    return version, path


def expire_versions(spark: SparkSession, root: str, keep: int = 3) -> list[int]:
    """Delete the folders of all but the newest ``keep`` committed versions (readers of older ones
    must have ended); returns their numbers. The commit log keeps its records."""
    log = spark.read.schema("version LONG, path STRING, committed_at STRING").json(f"{root.rstrip('/')}/{_COMMITS}")
    versions = sorted((r["version"], r["path"]) for r in log.select("version", "path").distinct().collect())
    old = [(v, p) for v, p in versions[: max(0, len(versions) - max(1, keep))] if exists(spark, p)]
    for _, path in old:
        remove(spark, path)
    return [v for v, _ in old]


def incremental_upsert(
    spark: SparkSession,
    root: str,
    updates: DataFrame,
    key: str | Sequence[str],
    full_refresh: bool = False,
    version: int | None = None,
    partition_by: Sequence[str] = (),
    check: Callable[[DataFrame], None] | None = None,
) -> tuple[int, str]:
    """B5 + B6 + B7: merge ``updates`` into the versioned table at ``root``.

    First run or ``full_refresh``: the updates become the table. Otherwise the
    schema must match the current version exactly, and the new version is
    ``upsert(current, updates, key)``. With an explicit ``version`` the merge base
    is the newest version below it, so re-running the same version (a replayed
    stream batch) recomputes the same result instead of merging into itself.
    The updates are evaluated once, into a staging folder that goes with the commit.
    ``check`` gets the written rows before the commit; if it raises, the table's current
    version stays what it was.
    """
    cur = None if full_refresh else current_version(spark, root, below=version)
    if cur is None:
        return write_version(spark, updates, root, version, partition_by, check)
    target = spark.read.parquet(cur[1])
    assert_schema(updates.schema, target.schema)
    staging = f"{root.rstrip('/')}/_staging/{uuid.uuid4().hex}"
    try:
        overwrite(updates, staging)
        staged = spark.read.schema(updates.schema).parquet(staging)
        return write_version(spark, upsert(target, staged, key), root, version, partition_by, check)
    finally:
        remove(spark, staging)


def exists(spark: SparkSession, path: str) -> bool:
    """Whether a file or folder is there, on any file system Spark knows."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()).exists(p)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a folder of ours with all it holds."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


# ---------------------------------------------------------------- B9, B10

@dataclass(frozen=True)
class LoadResult:
    rows: int
    seconds: float
    path: str


def load(
    df: DataFrame, path: str, mode: str = "append", partition_by: Sequence[str] = (), skip_empty: bool = True
) -> LoadResult:
    """Write and report rows written and duration, counted in the same pass
    through an ``Observation`` (no second scan). An empty input is skipped (nothing
    is written); finding that out reads at most one row."""
    t0 = time.time()
    if skip_empty and df.isEmpty():
        return LoadResult(rows=0, seconds=round(time.time() - t0, 3), path=path)
    obs = Observation("load")
    observed = df.observe(obs, F.count(F.lit(1)).alias("rows"))
    w = observed.write.mode(mode)
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)
    rows = int(obs.get.get("rows", 0))
    return LoadResult(rows=rows, seconds=round(time.time() - t0, 3), path=path)


def run_ingest(
    extract: Callable[[], DataFrame],
    transform: Callable[[DataFrame], DataFrame],
    sink: Callable[[DataFrame], LoadResult],
) -> LoadResult:
    """Extract -> transform -> load. Errors propagate to the caller."""
    return sink(transform(extract()))
