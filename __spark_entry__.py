"""

Every query reads the driver tables under ``sf_dir`` (events, nation, region,
lineitem, orders) and runs the library's models over the whole tables. The DuckDB
equivalents live in ``oracle_sql.py``.
"""

from __future__ import annotations

import os
import sys
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from citylake import session as _session  # noqa: E402
from citylake.functions import columns as C  # noqa: E402
from citylake.operators import profile as P  # noqa: E402
from citylake.operators import quality as Q  # noqa: E402
from citylake.operators.joins import lookup_join  # noqa: E402
from citylake.plans import dims, reports  # noqa: E402
from citylake.plans.warehouse import FIXTURE_RULES, Warehouse  # noqa: E402
from citylake.sources import files, fixtures  # noqa: E402
from citylake.sources.seeds import seed  # noqa: E402

try:  # the training-data operators are optional: without them the other queries still work
    import corpus_pipeline as _pipeline  # noqa: E402
    from citylake.llm import queries as _llm  # noqa: E402
except ImportError:
    _pipeline = _llm = None

SF_SMOKE = "/root/testdata/sf0.001"


def _prep(spark: SparkSession) -> None:
    _session.configure(spark)


def _wh(spark: SparkSession, sf_dir: str) -> Warehouse:
    _prep(spark)
    return Warehouse.from_testdata(spark, sf_dir)


def entry(spark: SparkSession) -> DataFrame:
    """Flagship: the demand-by-weather aggregate (I13) over the sf0.001 fixtures."""
    return _wh(spark, SF_SMOKE).agg_demand_weather


# ---------------------------------------------------------------- fixture L helpers

def _l_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    _prep(spark)
    return fixtures.latest_lineitem(fixtures.table(spark, sf_dir, "lineitem"), fixtures.table(spark, sf_dir, "orders"))


def _l_clean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixtures.time_ordered(_l_latest(spark, sf_dir))


def _k9_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = FIXTURE_RULES
    cal = dims.dim_calendar(spark, rules, fixtures.L_CALENDAR_START, fixtures.L_CALENDAR_DAYS)
    rows = _l_clean(spark, sf_dir).withColumn("ship_date_id", C.date_key("l_shipdate"))
    j = lookup_join(rows, cal, ["ship_date_id"], ["date_id"], ["is_holiday"])
    return reports.holiday_demand(j, day_col="ship_date_id")


def _k5_lineitem(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = FIXTURE_RULES
    trips = fixtures.lineitem_as_trips(_l_clean(spark, sf_dir))
    ef = seed(spark, "seed_emission_factors")
    j = lookup_join(
        trips, ef, ["vendor_id"], ["vendor_id"], ["emission_factor_g_mile"]
    )
    with_co2 = j.withColumn(
        "co2_emission_grams", F.col("trip_distance") * C.emission_factor("emission_factor_g_mile", rules)
    )
    return reports.co2_by_vendor(with_co2, rules)


# ---------------------------------------------------------------- checks that find something

def _copies(spark: SparkSession, sf_dir: str) -> list[DataFrame]:
    """The first and the re-sent copies of trips."""
    key = C.trip_key("VENDORID", "TPEP_PICKUP_DATETIME", "PULOCATIONID").alias("trip_id")
    rows = _wh(spark, sf_dir).raw_trips.select(
        key, F.col("FARE_AMOUNT").alias("fare_amount"), F.col("SOURCE_FILE").alias("source_file"),
        F.col("LOADED_AT").alias("loaded_at"), F.col("TPEP_PICKUP_DATETIME").alias("pickup"),
    )
    return [rows.where(F.col("source_file") == f) for f in fixtures.SOURCE_FILES]


def _b5_upsert_resent(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The re-sent copies merged by trip key into the first copies."""
    from citylake import sinks

    return sinks.upsert(*_copies(spark, sf_dir), "trip_id")


def _raw_keyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    trips = _wh(spark, sf_dir).raw_trips
    return trips.select(C.trip_key("VENDORID", "TPEP_PICKUP_DATETIME", "PULOCATIONID").alias("trip_id"))


def _i4_calendar_demand(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event joined to its calendar day, counted by the day's attributes."""
    _prep(spark)
    events = fixtures.table(spark, sf_dir, "events").select(C.date_key("ts").alias("date_id"), "value")
    columns = ["year", "quarter", "month", "month_name", "day_of_month", "day_of_week", "day_name", "week_of_year",
               "is_weekend", "is_holiday", "holiday_name"]
    joined = lookup_join(events, dims.dim_calendar(spark, FIXTURE_RULES), ["date_id"], ["date_id"], columns)
    return joined.groupBy(*columns).agg(F.count(F.lit(1)).alias("events"), F.count("value").alias("valued"))


def _c4_repaired_epochs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """C4 on every event: its epoch written in seconds, milliseconds or microseconds."""
    _prep(spark)
    scale = "CASE event_id % 3 WHEN 0 THEN 1L WHEN 1 THEN 1000L ELSE 1000000L END"
    epochs = fixtures.table(spark, sf_dir, "events").selectExpr("event_id", f"(1700000000 + event_id) * {scale} AS epoch")
    repaired = C.repair_epoch("epoch", T.LongType(), FIXTURE_RULES.epoch_micros_threshold)
    return epochs.select("event_id", "epoch", repaired.alias("repaired_ts"))


# ---------------------------------------------------------------- files and tables written on the way

def _landing(spark: SparkSession, name: str) -> str:
    _prep(spark)
    return f"{_session.ensure_checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}"


def _a1_read_trip_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Trips landed as two months with counts of different types, read back."""
    folder = _landing(spark, "trip-files")
    trips = _wh(spark, sf_dir).raw_trips
    names = [c for c in trips.columns if c not in ("SOURCE_FILE", "LOADED_AT")]
    for month, source, kind in (("01", fixtures.SOURCE_FILES[0], "double"), ("02", fixtures.SOURCE_FILES[1], "bigint")):
        counts = {"PASSENGER_COUNT": kind, "RATECODEID": kind}
        rows = trips.where(F.col("SOURCE_FILE") == source)
        columns = [F.col(c).cast(counts[c]).alias(c.lower()) if c in counts else F.col(c).alias(c.lower()) for c in names]
        rows.select(*columns).write.parquet(f"{folder}/yellow_tripdata_2024-{month}.parquet")
    paths = files.monthly_trip_paths(folder, "2024-01", "2024-02")
    return files.read_trips(spark, paths, fixtures.BASE_LOADED_AT).drop("SOURCE_FILE")


def _a2_read_weather_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A2: hourly weather landed as one JSON document of parallel arrays, read back."""
    folder = _landing(spark, "weather-files")
    names = ["TIME", "TEMPERATURE_2M", "PRECIPITATION", "SNOWFALL", "WINDSPEED_10M", "WEATHERCODE"]
    hours = _wh(spark, sf_dir).raw_weather.agg(F.array_sort(F.collect_list(F.struct(*names))).alias("h"))
    arrays = F.struct(*(F.col("h")[c].alias(c.lower()) for c in names)).alias("hourly")
    hours.select(F.to_json(F.struct(arrays)).alias("value")).write.text(folder)
    return files.read_weather(spark, folder, fixtures.WEATHER_SOURCE_URL, fixtures.BASE_LOADED_AT)


def _a3_read_zone_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A3: zones landed as CSV with a header and a missing-value token, read back."""
    folder = _landing(spark, "zone-files")
    zones = _wh(spark, sf_dir).raw_zones
    text = [F.coalesce(c, F.lit("N/A")).alias(n) for c, n in (("BOROUGH", "Borough"), ("ZONE", "Zone"), ("SERVICE_ZONE", "service_zone"))]
    zones.select(F.col("LOCATIONID").alias("LocationID"), *text).write.option("header", True).csv(folder)
    return files.read_zones(spark, folder, fixtures.ZONE_SOURCE_URL, fixtures.BASE_LOADED_AT)


def _b6_upserted_versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first copies written as a version, the re-sent ones merged into the next, read back."""
    from citylake import sinks

    root = _landing(spark, "versions")
    first, again = _copies(spark, sf_dir)
    sinks.incremental_upsert(spark, root, first, "trip_id", full_refresh=True)
    sinks.incremental_upsert(spark, root, again, "trip_id")
    return sinks.read_current(spark, root)


def _b5_upserted_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same merge into a table partitioned by pickup date, read back."""
    from citylake.sinks import snapshots

    root = _landing(spark, "dated")
    for run, rows in zip(("first", "again"), _copies(spark, sf_dir)):
        snapshots.upsert(spark, root, rows.withColumn("pickup_date", F.to_date("pickup")), "trip_id", "pickup_date", run)
    return snapshots.read(spark, root).select("trip_id", "fare_amount", "source_file", "loaded_at", "pickup")


def _b1_ledger_loads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """B1: two loads that are both offered the first file; the ledger lets each file in once."""
    from citylake.plans import loads
    from citylake.sinks import ledger

    folder = _landing(spark, "ledger")
    trips = _wh(spark, sf_dir).raw_trips
    paths = [f"{folder}/landing/{name}" for name in fixtures.SOURCE_FILES]
    for path, source in zip(paths, fixtures.SOURCE_FILES):
        trips.where(F.col("SOURCE_FILE") == source).drop("SOURCE_FILE", "LOADED_AT").write.parquet(path)
    for load, offered in (("first", paths[:1]), ("second", paths)):
        found = ledger.sorted_out(spark, f"{folder}/bronze", files.landed_files(spark, offered), load)
        todo = found["new"] + found["resent"]
        raw = files.read_landed(spark, [f.path for f in todo], fixtures.BASE_LOADED_AT)
        loads.write_bronze(raw, f"{folder}/bronze", load, FIXTURE_RULES)
        ledger.record(spark, f"{folder}/bronze", load, todo, "query")
    rows = loads.read_bronze(spark, f"{folder}/bronze")
    return rows.groupBy("load").agg(F.count(F.lit(1)).alias("rows"), F.count("TPEP_PICKUP_DATETIME").alias("timed"))


def _b6_full_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A table that has the first copies, refreshed with the re-sent ones alone, read back."""
    from citylake.sinks import snapshots

    root = _landing(spark, "refreshed")
    first, again = (rows.withColumn("pickup_date", F.to_date("pickup")) for rows in _copies(spark, sf_dir))
    snapshots.upsert(spark, root, first, "trip_id", "pickup_date", "first")
    snapshots.upsert(spark, root, again, "trip_id", "pickup_date", "again", full_refresh=True)
    return snapshots.read(spark, root).drop("pickup_date")


def _b7_schema_drift(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Upserts with an added, a missing and a re-typed column are stopped and change nothing."""
    from citylake import sinks

    root, zones = _landing(spark, "drift"), _wh(spark, sf_dir).zones
    sinks.incremental_upsert(spark, root, zones, "location_id")
    tried = {
        "added": zones.withColumn("more", F.lit(1)), "missing": zones.drop("zone"),
        "retyped": zones.withColumn("location_id", F.col("location_id").cast("long")), "none": zones,
    }
    out = []
    for drift, rows in tried.items():
        try:
            sinks.incremental_upsert(spark, root, rows, "location_id")
            out.append((drift, False, sinks.read_current(spark, root).count()))
        except sinks.SchemaDriftError:
            out.append((drift, True, sinks.read_current(spark, root).count()))
    return spark.createDataFrame(out, "drift string, stopped boolean, rows_after long")


def _b9_load_count(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows that a load reports, beside the rows it wrote."""
    from citylake import sinks

    path = _landing(spark, "load")
    done = sinks.load(fixtures.table(spark, sf_dir, "events"), path)
    return spark.read.parquet(path).agg(F.lit(done.rows).cast("long").alias("rows_reported"), F.count(F.lit(1)).alias("rows_written"))


def _c5_iso_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every event's minute as ISO text, parsed and written again."""
    _prep(spark)
    iso = F.date_format("ts", "yyyy-MM-dd'T'HH:mm")
    parsed = fixtures.table(spark, sf_dir, "events").select("event_id", iso.alias("iso")).select("event_id", C.parse_ntz("iso").alias("t"))
    return parsed.select("event_id", C.iso_text("t").alias("iso_text"))


def _j6_gate_failures(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The failures with which the gate stops on raw rows; row checks are counted by a write."""
    w = _wh(spark, sf_dir)
    rows = Q.RowChecks({
        "weather category accepted": Q.not_accepted("weather_category", [c for c in C.WEATHER_CATEGORIES if c != "Unknown"])
    })
    path = _landing(spark, "gated-weather")
    rows.observe(w.weather).write.parquet(path)
    checks = {
        "raw trip key unique": Q.unique(_raw_keyed(spark, sf_dir), "trip_id"),
        "raw zones not null": Q.not_null(w.raw_zones, ["BOROUGH", "SERVICE_ZONE"]),
        "zone unique": Q.unique(w.zones, "location_id"),
    }
    try:
        Q.gate(checks, counted=rows.failures(spark.read.parquet(path)))
        failures: dict[str, int] = {}
    except Q.QualityGateError as e:
        failures = e.failures
    return spark.createDataFrame(sorted(failures.items()), "check string, failures long")


def _a6_named_silver_zones(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A silver table found by its layer and name, in its newest version."""
    from citylake import sinks

    root, zones = _landing(spark, "layers"), _wh(spark, sf_dir).zones
    for rows in (zones.limit(0), zones):
        sinks.write_version(spark, rows, f"{root}/silver/stg_zone_lookup")
    return files.table(spark, "silver", "stg_zone_lookup", root=root)


def _b4_zone_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Zones through a view."""
    from citylake import sinks

    sinks.as_view(_wh(spark, sf_dir).zones, "citylake_stg_zones")
    return spark.table("citylake_stg_zones")


def _incremental_root(spark: SparkSession, sf_dir: str) -> str:
    """A warehouse that two runs have built, the first copies and then the re-sent ones. Every query builds its own:
    the tables at a path may change, and the scratch folder may be cleared, while an application runs."""
    from citylake.plans.materialize import build_warehouse

    root, w = _landing(spark, "incremental"), _wh(spark, sf_dir)
    for run, source in zip(("first", "again"), fixtures.SOURCE_FILES):
        rows = w.raw_trips.where(F.col("SOURCE_FILE") == source)
        build_warehouse(spark, rows, w.raw_weather, w.raw_zones, root, FIXTURE_RULES, run_id=run)
    return root


def _gold(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def read(spark: SparkSession, sf_dir: str) -> DataFrame:
        from citylake.plans.materialize import read_gold

        return read_gold(spark, _incremental_root(spark, sf_dir), name)

    return read


# ---------------------------------------------------------------- registry

def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    R = FIXTURE_RULES
    trip_key = ["VENDORID", "TPEP_PICKUP_DATETIME", "PULOCATIONID"]
    llm = {} if _llm is None else {"pipeline": _pipeline.run, **_llm.QUERIES}
    return llm | {
        "a1_raw_trips": lambda s, d: _wh(s, d).raw_trips,
        "g1_latest_per_trip": lambda s, d: _wh(s, d).latest_trips,
        "i1_stg_taxi_trips": lambda s, d: _wh(s, d).stg_trips,
        "i2_stg_weather_hourly": lambda s, d: _wh(s, d).weather,
        "i3_stg_zone_lookup": lambda s, d: _wh(s, d).zones,
        "i5_dim_zones": lambda s, d: _wh(s, d).dim_zones,
        "i9_dim_weather_lookup": lambda s, d: _wh(s, d).dim_weather_lookup,
        "i10_fact_trips": lambda s, d: _wh(s, d).fact_trips,
        "i11_fact_financials": lambda s, d: _wh(s, d).fact_financials,
        "i12_fact_sustainability": lambda s, d: _wh(s, d).fact_sustainability,
        "i13_agg_demand_weather": lambda s, d: _wh(s, d).agg_demand_weather,
        "e5_fact_trips_labeled": lambda s, d: _wh(s, d).fact_trips_labeled,
        "f3_trip_profile": lambda s, d: P.trip_profile(_wh(s, d).raw_trips),
        "f4_duplicate_candidates": lambda s, d: P.duplicate_candidates(_wh(s, d).raw_trips, trip_key),
        "f4_duplicate_candidates_concat": lambda s, d: P.duplicate_candidates(_wh(s, d).raw_trips, trip_key, "concat"),
        "f5_duplicate_trip_keys": lambda s, d: P.duplicate_keys(_wh(s, d).raw_trips, trip_key),
        "f5_duplicate_weather_hours": lambda s, d: P.duplicate_keys(_wh(s, d).raw_weather, ["TIME"]),
        "f7_raw_trip_count": lambda s, d: P.row_count(_wh(s, d).raw_trips),
        "h2_repaired_pickup_preview": lambda s, d: P.preview(
            _wh(s, d).raw_trips.select(
                C.repair_epoch("TPEP_PICKUP_DATETIME", T.TimestampNTZType()).alias("pickup_datetime")
            ),
            ["pickup_datetime"],
            100,
        ),
        "j1_unique_location_id": lambda s, d: Q.unique(_wh(s, d).zones, "location_id"),
        "j2_not_null_agg_columns": lambda s, d: Q.not_null(
            _wh(s, d).agg_demand_weather, ["agg_id", "total_trips"], keep=["agg_id"]
        ),
        "f6_weather_code_histogram": lambda s, d: P.value_histogram(
            _wh(s, d).raw_weather, "WEATHERCODE", "weather_code", "hours"
        ),
        "f7_fact_row_count": lambda s, d: P.row_count(_wh(s, d).fact_trips),
        "d3_weather_null_rows": lambda s, d: P.rows_with_nulls(
            _wh(s, d).raw_weather, ["TEMPERATURE_2M", "PRECIPITATION", "WEATHERCODE"]
        ),
        "h1_distinct_pickup_sample": lambda s, d: P.distinct_sample(_wh(s, d).raw_trips, ["TPEP_PICKUP_DATETIME"], 1000),
        "h2_trip_preview": lambda s, d: P.preview(_wh(s, d).stg_trips, ["trip_id"], 100),
        "h3_top_pickup_zones": lambda s, d: P.top_k(
            reports.pickup_density(_wh(s, d).fact_trips), "pickups", 10, ["pickup_location_id"]
        ),
        "j1_unique_trip_id": lambda s, d: Q.unique(_wh(s, d).fact_trips, "trip_id"),
        "j1_unique_agg_id": lambda s, d: Q.unique(_wh(s, d).agg_demand_weather, "agg_id"),
        "j1_unique_weather_time": lambda s, d: Q.unique(_wh(s, d).weather, "weather_time"),
        "j2_not_null_trip_columns": lambda s, d: Q.not_null(
            _wh(s, d).stg_trips,
            ["trip_id", "co2_emission_grams", "is_distance_anomaly", "is_fare_anomaly"],
            keep=["trip_id"],
        ),
        "j3_accepted_weather_category": lambda s, d: Q.accepted_values(
            _wh(s, d).weather, "weather_category", C.WEATHER_CATEGORIES, keep=["weather_time", "weather_category"]
        ),
        "j4_fact_grain": lambda s, d: (lambda w: Q.grain_preserved(w.stg_trips, w.fact_trips))(_wh(s, d)),
        "j5_weather_gaps": lambda s, d: Q.hourly_gaps(_wh(s, d).weather, "weather_time"),
        "k1_top_vendor_co2_week": lambda s, d: reports.top_vendor_co2(
            _wh(s, d).between(*reports.week_bounds("2024-01-01")).fact_trips, "2024-01-01", "AMERICA", 1, R
        ),
        "k2_kpi_tiles": lambda s, d: reports.kpi_tiles(_wh(s, d).fact_trips, R),
        "k3_pickup_density": lambda s, d: reports.pickup_density(_wh(s, d).fact_trips),
        "k4_weather_impact": lambda s, d: reports.weather_impact(_wh(s, d).agg_demand_weather, True, R),
        "k5_co2_by_vendor": lambda s, d: reports.co2_by_vendor(_wh(s, d).fact_sustainability, R),
        "k6_price_anomalies": lambda s, d: reports.price_anomalies(_wh(s, d).fact_financials),
        "k7_filtered_kpis": lambda s, d: reports.kpi_tiles(
            reports.apply_filters(
                _wh(s, d).between("2024-01-08", "2024-01-22").fact_trips,
                "2024-01-08", "2024-01-22", ["EUROPE", "ASIA"], ["Rain", "Clear"],
            ),
            R,
        ),
        "k8_payment_mix": lambda s, d: reports.payment_mix(_wh(s, d).fact_trips, "week"),
        "k9_holiday_demand": lambda s, d: reports.holiday_demand(_wh(s, d).fact_trips),
        "k10_flat_rate_discovery": lambda s, d: reports.flat_rate_discovery(_wh(s, d).stg_trips),
        "k11_vendor_risk": lambda s, d: reports.vendor_risk(_wh(s, d).fact_financials, R),
        "k12_short_trip_share": lambda s, d: (
            lambda w: reports.short_trip_share(w.fact_sustainability, w.zones, R)
        )(_wh(s, d)),
        "k13_co2_correlation": lambda s, d: reports.co2_correlation(_wh(s, d).fact_trips, R),
        "a1_read_trip_files": _a1_read_trip_files,
        "a2_read_weather_json": _a2_read_weather_json,
        "a3_read_zone_csv": _a3_read_zone_csv,
        "b5_upsert_resent": _b5_upsert_resent,
        "b5_upserted_partitions": _b5_upserted_partitions,
        "b6_upserted_versions": _b6_upserted_versions,
        "a6_named_silver_zones": _a6_named_silver_zones,
        "b1_ledger_loads": _b1_ledger_loads,
        "b4_zone_view": _b4_zone_view,
        "b6_full_refresh": _b6_full_refresh,
        "b7_schema_drift": _b7_schema_drift,
        "b9_load_count": _b9_load_count,
        "c5_iso_text": _c5_iso_text,
        "j6_gate_failures": _j6_gate_failures,
        "i13_incremental_agg_demand": _gold("gold_agg_demand_weather"),
        "k4_incremental_weather_impact": lambda s, d: reports.weather_impact_of_days(_gold("gold_demand_days")(s, d), True, R),
        "k9_incremental_holiday_demand": lambda s, d: reports.holiday_demand_of_days(_gold("gold_trip_days")(s, d)),
        "c4_repaired_epochs": _c4_repaired_epochs,
        "i4_calendar_demand": _i4_calendar_demand,
        "d3_zone_null_rows": lambda s, d: P.rows_with_nulls(_wh(s, d).raw_zones, ["BOROUGH", "SERVICE_ZONE"]),
        "f5_duplicate_event_users": lambda s, d: P.duplicate_keys(fixtures.table(s, d, "events"), ["user_id"]),
        "j1_unique_raw_trip_key": lambda s, d: Q.unique(_raw_keyed(s, d), "trip_id"),
        "j2_not_null_raw_zones": lambda s, d: Q.not_null(_wh(s, d).raw_zones, ["BOROUGH", "SERVICE_ZONE"], keep=["LOCATIONID"]),
        "j3_accepted_without_unknown": lambda s, d: Q.accepted_values(
            _wh(s, d).weather, "weather_category", [c for c in C.WEATHER_CATEGORIES if c != "Unknown"],
            keep=["weather_time", "weather_category"],
        ),
        "j4_raw_to_staged_grain": lambda s, d: (lambda w: Q.grain_preserved(w.raw_trips, w.stg_trips))(_wh(s, d)),
        "g1_latest_lineitem": _l_latest,
        "d1_lineitem_time_ordered": _l_clean,
        "k9_holiday_demand_lineitem": _k9_lineitem,
        "k5_co2_by_vendor_lineitem": _k5_lineitem,
    }


def oracle_sql() -> dict[str, str]:
    from oracle_sql import oracle_sql as _sql

    llm = {} if _llm is None else dict(_llm.ORACLE_SQL)
    if _pipeline is not None and _pipeline.ORACLE_SQL:
        llm["pipeline"] = _pipeline.ORACLE_SQL
    return _sql() | llm
