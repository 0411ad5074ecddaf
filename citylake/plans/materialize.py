"""End-to-end materialisation: bronze -> silver -> gold, each gated before it is published.

Each layer is written before the next one reads it, so lineage is cut at every
table and a lost executor costs at most a rerun of the current stage's tasks. Gold
reads the written silver tables, never the silver plans. The gate (J6) runs the declared
checks on written rows that no reader sees yet, an uncommitted state of silver or a gold
release that is not recorded, so a failing gate leaves the former silver and gold in place. Checks of single
rows (J2, J3) are counted by the write itself; only uniqueness and grain (J1, J4) scan what was written.

Gold follows the changes of a run. A release remembers the states of silver it was made from; the
next one compares them (the folder of each pickup date, the rows of weather and zones) and rewrites only the fact
partitions and aggregate hours of the dates that differ. All other partitions keep their folders.
"""

from __future__ import annotations

import datetime as _dt
import hashlib
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake import sinks
from citylake.config import Rules
from citylake.functions import columns as C
from citylake.functions.columns import WEATHER_CATEGORIES
from citylake.operators import quality as Q
from citylake.plans import dims, facts, silver
from citylake.plans.loads import SILVER_PARTITION, TRIP_NOT_NULL, load_trips
from citylake.sinks import ledger, releases, snapshots
from citylake.sources.seeds import seed


def _p(root: str, layer: str, name: str) -> str:
    return f"{root.rstrip('/')}/{layer}/{name}"


#: Declared tests by table (J1-J3): unique columns, columns without nulls, accepted values.
UNIQUE = {
    "stg_taxi_trips": ["trip_id"], "stg_weather_hourly": ["weather_time"], "stg_zone_lookup": ["location_id"],
    "gold_fact_trips": ["trip_id"], "gold_agg_demand_weather": ["agg_id"], "dim_calendar": ["date_id", "date_day"],
}
NOT_NULL = {
    "stg_taxi_trips": list(TRIP_NOT_NULL), "stg_weather_hourly": ["weather_time"], "stg_zone_lookup": ["location_id", "borough"],
    "gold_fact_trips": ["trip_id"], "gold_agg_demand_weather": ["agg_id", "total_trips"], "dim_calendar": ["date_id", "date_day"],
}
ACCEPTED = {"stg_weather_hourly": {"weather_category": WEATHER_CATEGORIES}}

#: Gold tables whose partitions follow the pickup dates, with the column that has the date's key.
DATED = {
    "gold_fact_trips": "pickup_date_id", "gold_fact_financials": "pickup_date_id", "gold_fact_sustainability": "pickup_date_id",
    "gold_agg_demand_weather": "demand_date_id", "gold_demand_days": "demand_date_id", "gold_trip_days": "pickup_date_id",
}
#: Columns that say when a row was made, not what it holds.
AUDIT = ("dbt_updated_at", "last_updated_at", "last_aggregated_at", "loaded_at", "loaded_at_bronze")


def row_checks(table: str) -> Q.RowChecks:
    """The declared tests of single rows (J2, J3), to be counted by a write."""
    checks = {f"{table} not null": Q.any_null(NOT_NULL[table])} if table in NOT_NULL else {}
    for col, values in ACCEPTED.get(table, {}).items():
        checks[f"{table}.{col} accepted"] = Q.not_accepted(col, values)
    return Q.RowChecks(checks)


def unique_checks(table: str, rows: DataFrame) -> dict[str, DataFrame]:
    """The declared unique columns (J1), one scan per table. A trip id has its pickup time in milliseconds, so different
    trips may share one: it stands for the whole trip key here."""
    cols = UNIQUE.get(table, [])
    if not cols:
        return {}
    if cols == ["trip_id"]:
        rows = rows.select(F.when(F.col("trip_id").isNotNull(), F.struct(*silver.TRIP_KEY)).alias("trip_id"))
    found = Q.unique(rows, cols[0]) if len(cols) == 1 else Q.unique_each(rows, cols)
    return {f"{table}.{'/'.join(cols)} unique": found}


def read_gold(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A table of the current gold release."""
    return releases.read(spark, f"{root.rstrip('/')}/gold", name)


def calendar_bounds(trips: DataFrame) -> tuple[str, int]:
    """First day and number of days of a calendar of whole years that covers all trips."""
    row = trips.agg(F.min("pickup_datetime").alias("lo"), F.max("pickup_datetime").alias("hi")).first()
    if row["lo"] is None:
        return "2023-01-01", 365
    first, last = _dt.date(row["lo"].year, 1, 1), _dt.date(row["hi"].year, 12, 31)
    return first.isoformat(), (last - first).days + 1


def build_warehouse(
    spark: SparkSession,
    raw_trips: DataFrame,
    raw_weather: DataFrame,
    raw_zones: DataFrame,
    root: str,
    rules: Rules = Rules(),
    full_refresh: bool = False,
    silver_layout: str = "by_pickup_date",
    run_id: str | None = None,
    bronze: bool = True,
    check_gaps: bool = False,
    files: Sequence[ledger.LandedFile] = (),
) -> dict[str, str]:
    """Build every model under ``root``; return name -> path of the tables (read them with ``files.table`` or
    :func:`read_gold`: a path alone does not say which of its folders are current).

    * ``bronze``: the run's trips are first kept under ``root/bronze/raw_taxi_trips/load=<run_id>``,
      and every trip key they touch is re-evaluated over all its copies, old and new. ``files`` are
      recorded in the ledger as loaded.
    * Silver trips are merged by the trip key: ``"by_pickup_date"`` keeps the table partitioned
      by pickup date and rewrites only the dates the run touches; ``"versioned"`` writes a
      complete new version per run. ``full_refresh`` evaluates all of bronze anew. Weather and zones
      are full rebuilds, as new versions.
    * Gold is one release per run (:func:`refresh_gold`).

    ``run_id`` names the run's load; a rerun under the same name loads it again in its place.
    """
    if silver_layout not in ("by_pickup_date", "versioned"):
        raise ValueError(f"unknown silver layout {silver_layout!r}")
    out: dict[str, str] = {}
    run_id = run_id or uuid.uuid4().hex

    # ---- silver weather and zones
    for name, df in (
        ("stg_weather_hourly", silver.stg_weather_hourly(raw_weather, rules)),
        ("stg_zone_lookup", silver.stg_zone_lookup(raw_zones, rules)),
    ):
        rows = row_checks(name)

        def gated(written: DataFrame, name=name, rows=rows) -> None:
            checks = unique_checks(name, written)
            if check_gaps and name == "stg_weather_hourly":
                checks["stg_weather_hourly missing hours"] = Q.hourly_gaps(written, "weather_time")
            Q.gate(checks, counted=rows.failures(written))

        _, out[name] = sinks.write_version(spark, rows.observe(df), _p(root, "silver", name), check=gated)

    # ---- bronze and silver trips
    bronze_root, trips_root = _p(root, "bronze", "raw_taxi_trips"), _p(root, "silver", "stg_taxi_trips")
    out["stg_taxi_trips"] = trips_root
    if silver_layout == "by_pickup_date":
        load_trips(
            spark, raw_trips, run_id, bronze_root, trips_root, rules, files, full_refresh=full_refresh, keep_bronze=bronze,
            gated=lambda written, counted: Q.gate(unique_checks("stg_taxi_trips", written), counted=counted),
        )
    else:
        stg = silver.stg_taxi_trips(raw_trips, seed(spark, "seed_emission_factors"), rules)
        rows = row_checks("stg_taxi_trips")
        _, out["stg_taxi_trips"] = sinks.incremental_upsert(
            spark, trips_root, stg, silver.TRIP_KEY, full_refresh=full_refresh,
            check=lambda written: Q.gate(unique_checks("stg_taxi_trips", written) | {
                "stg_taxi_trips not null": Q.not_null(written, TRIP_NOT_NULL)}),
        )
    if bronze and silver_layout == "by_pickup_date":
        out["raw_taxi_trips"] = bronze_root

    # ---- gold
    release = refresh_gold(spark, root, rules, run_id)
    return out | {name: f"{root.rstrip('/')}/gold/{name}" for name in release.schemas}


def _inputs(spark: SparkSession, root: str, rules: Rules, calendar: tuple[str, int]) -> dict[str, str]:
    """What a release is made from: states of the silver tables, and the rules."""
    found = {"rules": hashlib.sha256(repr((rules.with_(run_ts=None), calendar)).encode()).hexdigest()}
    snap = snapshots.current(spark, _p(root, "silver", "stg_taxi_trips"))
    if snap is not None:
        found["stg_taxi_trips"] = str(snap.version)
    for name in ("stg_weather_hourly", "stg_zone_lookup"):
        found[name] = sinks.current_version(spark, _p(root, "silver", name))[1]
    return found


def _differing(spark: SparkSession, old: str, new: str, columns: Sequence[str]) -> DataFrame:
    """``columns`` of the rows that only one of two versions of a table has (audit columns aside)."""
    a, b = spark.read.parquet(old), spark.read.parquet(new)
    if {(f.name, f.dataType) for f in a.schema} != {(f.name, f.dataType) for f in b.schema}:
        return a.select(*columns).union(b.select(*columns)).distinct()
    kept = [c for c in a.columns if c not in AUDIT]
    a, b = a.select(*kept), b.select(*kept)
    return a.exceptAll(b).union(b.exceptAll(a)).select(*columns).distinct()


def changed_dates(spark: SparkSession, root: str, old: releases.Release | None, inputs: dict[str, str]) -> set[str] | None:
    """Pickup dates (silver partitions) whose gold rows can differ from the release's; None for all of them.

    Dates whose silver folder differs, dates with hours whose weather differs, and dates with trips from zones that differ.
    """
    trips_root = _p(root, "silver", "stg_taxi_trips")
    new = snapshots.current(spark, trips_root)
    if old is None or new is None or old.inputs.get("rules") != inputs["rules"] or "stg_taxi_trips" not in old.inputs:
        return None
    before = snapshots.current(spark, trips_root, int(old.inputs["stg_taxi_trips"]))
    out = set(snapshots.changed(before, new))
    if old.inputs["stg_weather_hourly"] != inputs["stg_weather_hourly"]:
        if not sinks.exists(spark, old.inputs["stg_weather_hourly"]):
            return None
        hours = _differing(spark, old.inputs["stg_weather_hourly"], inputs["stg_weather_hourly"], ["weather_time"])
        days = hours.where("weather_time IS NOT NULL").select(F.to_date("weather_time").cast("string").alias("d")).distinct()
        out |= {f"{SILVER_PARTITION}={r['d']}" for r in days.collect()}
    if old.inputs["stg_zone_lookup"] != inputs["stg_zone_lookup"]:
        if not sinks.exists(spark, old.inputs["stg_zone_lookup"]):
            return None
        zones = _differing(spark, old.inputs["stg_zone_lookup"], inputs["stg_zone_lookup"], ["location_id"])
        if not zones.isEmpty():
            there = snapshots.read_snapshot(spark, trips_root, new).join(
                zones, F.col("pickup_location_id").eqNullSafe(zones["location_id"]), "left_semi"
            )
            days = there.select(F.col(SILVER_PARTITION).cast("string").alias("d")).distinct()
            out |= {f"{SILVER_PARTITION}={r['d']}" for r in days.collect()}
    return out


def refresh_gold(spark: SparkSession, root: str, rules: Rules = Rules(), run_id: str | None = None) -> releases.Release:
    """Bring gold up to the current silver tables, as one release.

    The fact partitions and aggregate hours of changed dates are computed from the silver rows of these
    dates alone; the others keep their folders. Dimensions are small and written whole.
    """
    layer = f"{root.rstrip('/')}/gold"
    old = releases.current(spark, layer)
    number = 1 if old is None else old.version + 1
    trips_root = _p(root, "silver", "stg_taxi_trips")
    weather = spark.read.parquet(sinks.current_version(spark, _p(root, "silver", "stg_weather_hourly"))[1])
    zones = spark.read.parquet(sinks.current_version(spark, _p(root, "silver", "stg_zone_lookup"))[1])
    snap = snapshots.current(spark, trips_root)
    if snap is not None:
        trips = snapshots.read_snapshot(spark, trips_root, snap)
    else:
        trips = sinks.read_current(spark, trips_root)
    bounds = calendar_bounds(trips)
    inputs = _inputs(spark, root, rules, bounds)
    dates = changed_dates(spark, root, old, inputs)
    if dates is not None:
        trips = snapshots.read_snapshot(spark, trips_root, snap, dates)
    trips = trips.select(*silver.STG_COLUMNS)
    calendar = dims.dim_calendar(spark, rules, *bounds)
    folder = f"{sinks.GOLD_RELEASES}/v={number:010d}"
    schemas: dict[str, str] = {}
    tables: dict[str, dict[str, str]] = {}
    counted: dict[str, tuple[Q.RowChecks, DataFrame]] = {}

    def write(name: str, df: DataFrame) -> DataFrame:
        """Write a table of the release; returns its written rows."""
        rows = row_checks(name)
        schemas[name] = T.StructType([T.StructField(f.name, f.dataType) for f in df.schema.fields]).json()
        if name not in DATED:
            sinks.overwrite(rows.observe(df), f"{layer}/{folder}/{name}")
            tables[name] = {"": f"{folder}/{name}"}
            read = spark.read.schema(df.schema).parquet(f"{layer}/{folder}/{name}")
            counted[name] = rows, read
            return read
        observed = rows.observe(df)
        if DATED[name] not in df.columns:
            observed = observed.withColumn(DATED[name], C.date_key("pickup_hour_truncated"))
        written = f"{name}/data/release_version={number:010d}"
        sinks.overwrite(observed, f"{layer}/{written}", [DATED[name]])
        parts = {n: f"{written}/{n}" for n in snapshots.folders(spark, f"{layer}/{written}")}
        kept = {}
        if dates is not None:
            gone = {_date_folder(DATED[name], d) for d in dates}
            kept = {k: v for k, v in old.tables.get(name, {}).items() if k not in gone}
        tables[name] = kept | parts
        read = releases.read_table(spark, layer, releases.Release(number, run_id, inputs, schemas, {name: parts}), name)
        counted[name] = rows, read
        return read

    for name, df in {
        "dim_calendar": calendar,
        "dim_zones": dims.dim_zones(zones, rules),
        "dim_vendors": dims.dim_vendors(spark, rules),
        "dim_rate_codes": dims.dim_rate_codes(spark, rules),
        "dim_payment_types": dims.dim_payment_types(spark, rules),
        "dim_weather_lookup": dims.dim_weather_lookup(weather),
    }.items():
        written_dim = write(name, df)
        if name == "dim_calendar":
            written_calendar = written_dim
    # The three facts read silver independently; their writes are submitted
    # together so the scheduler can overlap them.
    fact_jobs = {
        "gold_fact_trips": facts.gold_fact_trips(trips, weather, zones, calendar, rules),
        "gold_fact_financials": facts.gold_fact_financials(trips, rules),
        "gold_fact_sustainability": facts.gold_fact_sustainability(trips, rules),
    }
    with ThreadPoolExecutor(max_workers=len(fact_jobs)) as pool:
        fact = dict(zip(fact_jobs, pool.map(lambda n: write(n, fact_jobs[n]), fact_jobs)))["gold_fact_trips"]
    agg = write("gold_agg_demand_weather", facts.gold_agg_demand_weather(fact, rules))
    write("gold_demand_days", facts.demand_days(agg, rules))
    write("gold_trip_days", facts.trip_days(fact))
    checks = unique_checks("gold_fact_trips", fact) | unique_checks("gold_agg_demand_weather", agg)
    checks |= unique_checks("dim_calendar", written_calendar) | {"gold_fact_trips grain": Q.grain_preserved(trips, fact)}
    Q.gate(checks, counted=reduce(lambda a, b: a | b, (rows.failures(read) for rows, read in counted.values())))
    return releases.commit(spark, layer, releases.Release(number, run_id, inputs, schemas, tables))


def _date_folder(column: str, silver_partition: str) -> str:
    """pickup_date=2024-01-31 -> <column>=20240131."""
    value = silver_partition.split("=", 1)[1]
    return f"{column}={value if value.startswith('__') else value.replace('-', '')}"
