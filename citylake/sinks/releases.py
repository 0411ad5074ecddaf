"""Releases of a layer: one commit names the state of all its tables.

A release is a map (table, partition) -> folder, written whole per release and recorded by one commit.
Tables that a run rebuilds have one folder; partitioned tables keep the folders of the partitions that the run
did not change. Readers see all tables of one release or all of another. ``inputs`` remembers what the release
was made from, so the next run can tell what has changed since.
"""

from __future__ import annotations

import datetime as _dt
import json
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake import sinks

_LOG = "version LONG, path STRING, committed_at STRING, run STRING, inputs STRING, schemas STRING"


@dataclass(frozen=True)
class Release:
    version: int
    run: str | None
    inputs: dict[str, str]
    #: Table -> schema; table -> partition ("" for a table in one folder) -> folder below the layer's root.
    schemas: dict[str, str] = field(default_factory=dict)
    tables: dict[str, dict[str, str]] = field(default_factory=dict)


def root_of(layer: str) -> str:
    return f"{layer.rstrip('/')}/{sinks.GOLD_RELEASES}"


def current(spark: SparkSession, layer: str) -> Release | None:
    """The newest committed release, or None."""
    root = root_of(layer)
    if not sinks.exists(spark, f"{root}/_commits"):
        return None
    log = spark.read.schema(_LOG).json(f"{root}/_commits")
    row = log.agg(F.max_by(F.struct("*"), F.struct("version", "committed_at")).alias("c")).first()["c"]
    if row is None:
        return None
    tables: dict[str, dict[str, str]] = {}
    for r in spark.read.schema("name STRING, partition STRING, folder STRING").parquet(f"{layer.rstrip('/')}/{row['path']}").collect():
        tables.setdefault(r["name"], {})[r["partition"]] = r["folder"]
    schemas = json.loads(row["schemas"])
    for name in schemas:
        tables.setdefault(name, {})
    return Release(row["version"], row["run"], json.loads(row["inputs"]), schemas, tables)


def read_table(spark: SparkSession, layer: str, release: Release, name: str, only: set[str] | None = None) -> DataFrame:
    """A table of a release, or some of its partitions."""
    if name not in release.schemas:
        raise FileNotFoundError(f"no table {name} in release {release.version} under {layer}")
    schema = T.StructType.fromJson(json.loads(release.schemas[name]))
    parts = release.tables[name]
    keep = sorted(parts if only is None else only & parts.keys())
    if not keep:
        return spark.createDataFrame([], schema)
    layer = layer.rstrip("/")
    reader = spark.read.schema(schema)
    if "" not in parts:  # the partition column comes from the folders, so filters on it prune them
        reader = reader.option("basePath", f"{layer}/{name}/data")
    return reader.parquet(*(f"{layer}/{parts[k]}" for k in keep)).select(*(F.col(f"`{c}`") for c in schema.names))


def read(spark: SparkSession, layer: str, name: str) -> DataFrame:
    """A table of the newest release."""
    release = current(spark, layer)
    if release is None:
        raise FileNotFoundError(f"no release under {layer}")
    return read_table(spark, layer, release, name)


def commit(spark: SparkSession, layer: str, release: Release) -> Release:
    """Write the map of a release and record it as the newest."""
    layer = layer.rstrip("/")
    path = f"{sinks.GOLD_RELEASES}/v={release.version:010d}/_tables"
    rows = [(name, part, folder) for name, parts in sorted(release.tables.items()) for part, folder in sorted(parts.items())]
    spark.createDataFrame(rows, "name STRING, partition STRING, folder STRING").coalesce(1).write.mode("overwrite").parquet(f"{layer}/{path}")
    stamp = _dt.datetime.now(_dt.timezone.utc).isoformat()
    record = (release.version, path, stamp, release.run, json.dumps(release.inputs), json.dumps(release.schemas))
    spark.createDataFrame([record], _LOG).coalesce(1).write.mode("append").json(f"{root_of(layer)}/_commits")
    return release
