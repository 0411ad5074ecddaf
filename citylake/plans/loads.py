"""One load of trips: bronze, the silver trips that follow from it, and its record in the ledger.

The batch build and the stream both load through here, so they share one bronze table, one silver table
and one ledger. Bronze is laid out as ``load=<id>/pickup_day=<day>/trip_bucket=<n>``: day and bucket are
functions of the trip key (the bucket is a hash of it), so all copies of a trip, of whatever load, lie in one
day and bucket, and a load re-evaluates its trips by reading only the days and buckets it touches
(partition filters). Only completed loads and the current one are read.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake import sinks
from citylake.config import Rules
from citylake.functions import columns as C
from citylake.operators import quality as Q
from citylake.plans.silver import STG_COLUMNS, TRIP_KEY, cast_trips, stg_taxi_trips
from citylake.sinks import ledger, snapshots
from citylake.sources.schemas import RAW_TRIPS_SCHEMA
from citylake.sources.seeds import seed

SILVER_PARTITION = "pickup_date"
TRIP_NOT_NULL = ("trip_id", "co2_emission_grams", "is_distance_anomaly", "is_fare_anomaly")
#: Buckets of a day: a load of few trips reads this fraction of each day it touches.
TRIP_BUCKETS = 4


def _bronze_schema() -> T.StructType:
    layout = [("load", T.StringType()), ("pickup_day", T.DateType()), ("trip_bucket", T.IntegerType())]
    return T.StructType([*RAW_TRIPS_SCHEMA.fields, *(T.StructField(n, t) for n, t in layout)])


def with_trip_bucket(raw: DataFrame, rules: Rules, buckets: int = TRIP_BUCKETS) -> DataFrame:
    """Adds pickup_day and trip_bucket, both functions of the typed trip key."""
    kind = {f.name: f.dataType for f in raw.schema.fields}["TPEP_PICKUP_DATETIME"]
    pickup = C.repair_epoch("TPEP_PICKUP_DATETIME", kind, rules.epoch_micros_threshold)
    key = F.xxhash64(C.to_int("VENDORID"), pickup, C.to_int("PULOCATIONID"))
    return raw.withColumns({"pickup_day": F.to_date(pickup), "trip_bucket": F.pmod(key, F.lit(buckets)).cast("int")})


def write_bronze(raw: DataFrame, bronze_root: str, load: str, rules: Rules) -> None:
    """B1: the load's rows as a folder of its own; a repeated load rewrites it."""
    rows = raw.select(*(F.col(f.name).cast(f.dataType).alias(f.name) for f in RAW_TRIPS_SCHEMA.fields))
    sinks.overwrite(with_trip_bucket(rows, rules), f"{bronze_root.rstrip('/')}/load={load}", ["pickup_day", "trip_bucket"])


def read_bronze(spark: SparkSession, bronze_root: str, also: Sequence[str] = ()) -> DataFrame:
    """Rows of all completed loads (and of ``also``), with load, pickup_day and trip_bucket."""
    known = sorted({*ledger.loads(spark, bronze_root), *also})
    rows = spark.read.schema(_bronze_schema()).option("basePath", bronze_root)
    paths = [p for p in (f"{bronze_root.rstrip('/')}/load={k}" for k in known) if sinks.exists(spark, p)]
    return rows.parquet(*paths) if paths else spark.createDataFrame([], _bronze_schema())


def _touched(pairs: Sequence[tuple], buckets: int) -> Column:
    """The condition that a row lies in one of the (day, bucket) pairs, on the partition columns alone."""
    days: dict[object, set[int]] = {}
    for day, bucket in pairs:
        days.setdefault(day, set()).add(bucket)
    alike: dict[frozenset[int], list[object]] = {}
    for day, found in days.items():
        alike.setdefault(frozenset(found), []).append(day)
    terms = []
    for found, of in alike.items():
        known = [d for d in of if d is not None]
        on_day = F.col("pickup_day").isin(known) if known else F.lit(False)
        on_day = on_day | F.col("pickup_day").isNull() if len(known) < len(of) else on_day
        terms.append(on_day if len(found) == buckets else on_day & F.col("trip_bucket").isin(sorted(found)))
    return reduce(lambda a, b: a | b, terms, F.lit(False))


def touched_trips(bronze: DataFrame, load: str, rules: Rules, buckets: int = TRIP_BUCKETS) -> DataFrame:
    """All copies, old and new, of the trips that are in ``load``."""
    own = bronze.where(F.col("load") == load)
    # Days times buckets of one load: bounded by the days it covers.
    pairs = [tuple(r) for r in own.select("pickup_day", "trip_bucket").distinct().collect()]
    near = bronze.where(_touched(pairs, buckets)).select(*RAW_TRIPS_SCHEMA.names)
    names = [f"__{c}" for c in TRIP_KEY]
    keys = cast_trips(own.select(*RAW_TRIPS_SCHEMA.names), rules).select(*(F.col(c).alias(n) for c, n in zip(TRIP_KEY, names))).distinct()
    typed = near.withColumn("__raw", F.struct(*RAW_TRIPS_SCHEMA.names))
    kind = RAW_TRIPS_SCHEMA["TPEP_PICKUP_DATETIME"].dataType
    typed = typed.select(
        "__raw", C.to_int("VENDORID").alias("v"), C.repair_epoch("TPEP_PICKUP_DATETIME", kind, rules.epoch_micros_threshold).alias("p"),
        C.to_int("PULOCATIONID").alias("l"),
    )
    same = reduce(lambda a, b: a & b, (F.col(c).eqNullSafe(F.col(n)) for c, n in zip("vpl", names)))
    return typed.join(keys, same, "left_semi").select("__raw.*")


def load_trips(
    spark: SparkSession,
    raw: DataFrame,
    load: str,
    bronze_root: str,
    silver_root: str,
    rules: Rules = Rules(),
    files: Sequence[ledger.LandedFile] = (),
    source: str = "build",
    full_refresh: bool = False,
    keep_bronze: bool = True,
    gated: Callable[[DataFrame, dict[str, int]], None] | None = None,
) -> tuple[snapshots.Snapshot, list[str]]:
    """Load trips into bronze and silver; returns the silver state and the pickup dates it changed.

    ``full_refresh`` evaluates all of bronze anew, as a state that replaces the former one when it is committed.
    ``gated`` gets the rows as written and the counts of the row checks; if it raises, silver is as before and
    the load is not recorded.
    """
    if keep_bronze:
        write_bronze(raw, bronze_root, load, rules)
        bronze = read_bronze(spark, bronze_root, [load])
        raw = bronze.select(*RAW_TRIPS_SCHEMA.names) if full_refresh else touched_trips(bronze, load, rules)
    stg = stg_taxi_trips(raw, seed(spark, "seed_emission_factors"), rules).withColumn(SILVER_PARTITION, F.to_date("pickup_datetime"))
    rows = Q.RowChecks({"stg_taxi_trips not null": Q.any_null(TRIP_NOT_NULL)})

    def check(written: DataFrame) -> None:
        if gated is not None:
            gated(written, rows.failures(written))

    done = snapshots.upsert(
        spark, silver_root, stg, TRIP_KEY, SILVER_PARTITION, run_id=load, full_refresh=full_refresh, check=check, observe=rows.observe
    )
    if keep_bronze:
        ledger.record(spark, bronze_root, load, files, source)
    return done


def read_silver(spark: SparkSession, silver_root: str) -> DataFrame:
    """The silver trips of the newest state (without the partition column)."""
    return snapshots.read(spark, silver_root).select(*STG_COLUMNS)
