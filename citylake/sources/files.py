"""Scans of landed source files.

The reference downloads files and pushes pandas batches into the warehouse. Here the
files are already landed on shared storage; Spark splits them into input partitions
(``spark.sql.files.maxPartitionBytes``) in place of fixed 500k-row batches.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.functions.columns import rename_upper, with_audit
from citylake.sinks.ledger import LandedFile
from citylake.sources.schemas import (
    RAW_TRIPS_SCHEMA,
    TLC_FILE_SCHEMA,
    TRIP_SOURCE_COLUMNS,
    WEATHER_JSON_SCHEMA,
    ZONE_CSV_SCHEMA,
)

# pandas' default NA tokens, which the reference's CSV read turns into nulls.
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]


def monthly_trip_paths(base: str, first: str, last: str, prefix: str = "yellow_tripdata") -> list[str]:
    """``base/<prefix>_YYYY-MM.parquet`` for every month from ``first`` to ``last``
    (both 'YYYY-MM'), the monthly file naming of the trip source (A1)."""
    y, m = (int(x) for x in first.split("-"))
    ly, lm = (int(x) for x in last.split("-"))
    out = []
    while (y, m) <= (ly, lm):
        out.append(f"{base.rstrip('/')}/{prefix}_{y:04d}-{m:02d}.parquet")
        y, m = (y + 1, 1) if m == 12 else (y, m + 1)
    return out


def landed_files(spark: SparkSession, paths: str | Sequence[str]) -> list[LandedFile]:
    """Path, length and modification time of the files that ``paths`` name (files, folders or patterns).

    One scan lists them all; only the listing is read, not the files.
    """
    paths = [paths] if isinstance(paths, str) else list(paths)
    found = spark.read.format("binaryFile").load(paths).select("path", "length", F.col("modificationTime").cast("string").alias("modified"))
    return [LandedFile(*r) for r in found.distinct().orderBy("path").collect()]


def footer_index(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """path, column (lower case) and type (short name) of every column of the files, read from their footers by tasks.

    Tasks open the files with the Arrow file systems (local, hdfs, s3, gs, abfss); a file they cannot open has
    one row with null column and type.
    """

    def footers(batches):
        import pyarrow as pa
        import pyarrow.fs as pafs
        import pyarrow.parquet as pq

        names = {pa.int8(): "tinyint", pa.int16(): "smallint", pa.int32(): "int", pa.int64(): "bigint", pa.float32(): "float", pa.float64(): "double"}
        for batch in batches:
            rows = []
            for path in batch.column(0).to_pylist():
                try:
                    uri = "file://" + path[5:] if path.startswith("file:/") and not path.startswith("file://") else path.replace("s3a://", "s3://", 1)
                    fs, inner = pafs.FileSystem.from_uri(uri)
                    with fs.open_input_file(inner) as f:
                        rows += [(path, c.name.lower(), names.get(c.type, str(c.type))) for c in pq.read_schema(f)]
                except (pa.ArrowInvalid, pa.ArrowNotImplementedError, OSError):
                    rows.append((path, None, None))
            columns = list(zip(*rows)) if rows else [[], [], []]
            yield pa.RecordBatch.from_arrays([pa.array(c, pa.string()) for c in columns], ["path", "column", "type"])

    files = spark.createDataFrame([(p,) for p in paths], "path string")
    return files.repartition("path").mapInArrow(footers, "path string, `column` string, type string")


def _schema_groups(spark: SparkSession, paths: Sequence[str]) -> list[tuple[T.StructType, list[str]]]:
    """Files grouped by the types their numeric columns are written with.

    Counts are INT64 in some months and DOUBLE in others, and a scan reads one type per column; columns a
    file lacks are read as null. One job reads all footers; a file is read apart only if tasks cannot open it.
    """
    seen = F.collect_set(F.struct("column", "type"))
    groups: dict[str, tuple[T.StructType, list[str]]] = {}
    index = footer_index(spark, paths).groupBy("path").agg(F.sort_array(seen).alias("columns"))
    for types, files in index.groupBy("columns").agg(F.sort_array(F.collect_list("path")).alias("files")).collect():
        for group in [[f] for f in files] if types[0]["column"] is None else [files]:
            written = {c["column"]: c["type"] for c in types if c["column"] is not None}
            written = written or {c.name.lower(): c.dataType.simpleString() for c in spark.read.parquet(*group).schema.fields}
            # A column without any value may be written without a type: it is not read, and null.
            known = [c for c in TLC_FILE_SCHEMA.fields if written.get(c.name.lower()) != "null"]
            schema = T.StructType([T.StructField(c.name, _scanned(c.dataType, written.get(c.name.lower()))) for c in known])
            groups.setdefault(schema.json(), (schema, []))[1].extend(group)
    return list(groups.values())


def _scanned(wanted: T.DataType, written: str | None) -> T.DataType:
    """The type a column is scanned with: the declared one, but whole numbers or fractions as they were written."""
    if written in ("tinyint", "smallint", "int", "bigint") and isinstance(wanted, (T.DoubleType, T.LongType)):
        return T.LongType()
    if written in ("float", "double") and isinstance(wanted, T.LongType):
        return T.FloatType() if written == "float" else T.DoubleType()
    return wanted


def read_trips(spark: SparkSession, paths: str | Sequence[str], loaded_at=None) -> DataFrame:
    """Monthly TLC trip parquet files -> bronze trip rows (A1 + C1 + C2).

    Source names are mapped case-insensitively to the bronze names; SOURCE_FILE is
    the file name each row came from; LOADED_AT is the load timestamp (one value per
    load, as in the reference). Two jobs (the listing and the footers) run for any number of files.
    """
    return read_landed(spark, [f.path for f in landed_files(spark, paths)], loaded_at)


def read_landed(spark: SparkSession, files: Sequence[str], loaded_at=None) -> DataFrame:
    """:func:`read_trips` for files that are already listed."""
    src = F.regexp_extract(F.col("_metadata.file_path"), r"([^/]+)$", 1)
    ts = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at is not None else F.localtimestamp()
    parts = []
    for schema, group in _schema_groups(spark, files) if files else []:
        raw = spark.read.schema(schema).parquet(*group)
        raw = with_audit(raw, "SOURCE_FILE", src, ts)
        casts = [(F.col(f.name) if f.name in schema.names else F.lit(None)).cast(f.dataType).alias(f.name) for f in TLC_FILE_SCHEMA.fields]
        parts.append(raw.select(*casts, "SOURCE_FILE", "LOADED_AT"))
    if not parts:
        return spark.createDataFrame([], RAW_TRIPS_SCHEMA)
    df = rename_upper(reduce(DataFrame.unionByName, parts), TRIP_SOURCE_COLUMNS)
    return df.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_TRIPS_SCHEMA.fields])


def read_weather(spark: SparkSession, path: str, source_url: str = "", loaded_at: str | None = None) -> DataFrame:
    """Weather JSON ``{"hourly": {"time": [...], "temperature_2m": [...], ...}}`` -> one
    row per hour (A2). A file without ``hourly`` yields no rows.

    Parallel arrays are zipped and exploded by ``inline`` on the executors; each file
    is one JSON document (``multiLine``), so a file is one task.
    """
    doc = spark.read.schema(WEATHER_JSON_SCHEMA).option("multiLine", True).json(path)
    h = F.col("hourly")
    zipped = F.arrays_zip(
        h["time"].alias("TIME"),
        h["temperature_2m"].alias("TEMPERATURE_2M"),
        h["precipitation"].alias("PRECIPITATION"),
        h["snowfall"].alias("SNOWFALL"),
        h["windspeed_10m"].alias("WINDSPEED_10M"),
        h["weathercode"].alias("WEATHERCODE"),
    )
    rows = doc.where(h.isNotNull()).select(F.inline(zipped))
    stamp = F.lit(loaded_at) if loaded_at is not None else F.date_format(F.localtimestamp(), "yyyy-MM-dd HH:mm:ss")
    return rows.withColumn("SOURCE_URL", F.lit(source_url)).withColumn("LOADED_AT", stamp)


def read_zones(spark: SparkSession, path: str, source_url: str = "", loaded_at: str | None = None) -> DataFrame:
    """Zone lookup CSV with header (A3); pandas' NA tokens become null."""
    df = spark.read.schema(ZONE_CSV_SCHEMA).option("header", True).csv(path)
    for c in ("Borough", "Zone", "service_zone"):
        df = df.withColumn(c, F.when(F.trim(F.col(c)).isin(NA_TOKENS), None).otherwise(F.col(c)))
    df = rename_upper(df)
    stamp = F.lit(loaded_at) if loaded_at is not None else F.date_format(F.localtimestamp(), "yyyy-MM-dd HH:mm:ss")
    return df.withColumn("SOURCE_URL", F.lit(source_url)).withColumn("LOADED_AT", stamp)


# ---------------------------------------------------------------- A6: logical table names

LAYERS = ("bronze", "silver", "gold")
SOURCES = {
    "raw_taxi_trips": ("bronze", "raw_taxi_trips"),
    "raw_weather_hourly": ("bronze", "raw_weather_hourly"),
    "raw_taxi_zone_lookup": ("bronze", "raw_taxi_zone_lookup"),
}


def table(spark: SparkSession, layer: str, name: str, root: str | None = None) -> DataFrame:
    """Resolve a logical (layer, name): a catalog table ``layer.name``, or below a storage
    root the table of the current gold release, the newest snapshot or committed version, or the
    plain folder ``root/layer/name`` (A6)."""
    if layer not in LAYERS:
        raise ValueError(f"unknown layer {layer!r}")
    if root is None:
        return spark.table(f"{layer}.{name}")
    from citylake.sinks import current_version, releases, snapshots

    base = f"{root.rstrip('/')}/{layer}"
    if layer == "gold" and releases.current(spark, base) is not None:
        return releases.read(spark, base, name)
    if snapshots.current(spark, f"{base}/{name}") is not None:
        return snapshots.read(spark, f"{base}/{name}")
    version = current_version(spark, f"{base}/{name}")
    return spark.read.parquet(version[1] if version is not None else f"{base}/{name}")
