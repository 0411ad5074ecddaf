"""Gold follows a run's changes; one warehouse for build and stream; the gate scans a layer twice at most."""

import json
import os

import pytest
from test_sources_sinks import tlc_row, write_tlc

from citylake.config import Rules
from citylake.operators import quality as Q
from citylake.plans import materialize as M
from citylake.plans import facts, reports
from citylake.plans.loads import read_silver
from citylake.sinks import releases, snapshots
from citylake.sources import files

DAY = 60 * 24
RULES = Rules(sum_scale=2)


def weather(spark, tmp_root, name="weather.json", days=4, rain=()):
    hours = [f"2023-01-{d + 1:02d}T{h:02d}:00" for d in range(days) for h in range(24)]
    path = os.path.join(tmp_root, name)
    n = len(hours)
    codes = [61 if t in rain else 0 for t in hours]
    with open(path, "w") as f:
        json.dump({"hourly": {"time": hours, "temperature_2m": [1.0] * n, "precipitation": [0.0] * n, "snowfall": [0.0] * n,
                              "windspeed_10m": [2.0] * n, "weathercode": codes}}, f)
    return files.read_weather(spark, path, loaded_at="2024-02-01 00:00:00")


def zones(spark, tmp_root, borough="Queens"):
    path = os.path.join(tmp_root, f"zones-{borough}.csv")
    with open(path, "w") as f:
        f.write(f"LocationID,Borough,Zone,service_zone\n100,Manhattan,Midtown,Yellow Zone\n101,{borough},JFK Airport,Airports\n")
    return files.read_zones(spark, path, loaded_at="2024-02-01 00:00:00")


def trips(spark, tmp_root, name, rows, at):
    path = os.path.join(tmp_root, f"{name}.parquet")
    write_tlc(path, [dict(r, trip_distance=2.5, PULocationID=100 + r["tpep_pickup_datetime"].hour % 2) for r in rows])
    return files.read_trips(spark, path, at)


def gold(spark, root, name):
    rows = M.read_gold(spark, root, name)
    return sorted(map(str, rows.drop(*(c for c in M.AUDIT if c in rows.columns)).collect()))


ALL = ["gold_fact_trips", "gold_fact_financials", "gold_fact_sustainability", "gold_agg_demand_weather", "gold_demand_days", "gold_trip_days", "dim_calendar", "dim_zones"]


def test_a_run_rewrites_only_the_dates_it_changes(spark, tmp_root):
    root = os.path.join(tmp_root, "wh")
    first = trips(spark, tmp_root, "a", [tlc_row(DAY * d + 60 * k) for d in range(4) for k in range(3)], "2024-02-01 00:00:00")
    w, z = weather(spark, tmp_root), zones(spark, tmp_root)
    M.build_warehouse(spark, first, w, z, root, RULES, run_id="r1")
    before = releases.current(spark, f"{root}/gold")
    # two dates: a corrected fare on the second, a new trip on the third
    second = trips(spark, tmp_root, "b", [tlc_row(DAY, fare=33.0), tlc_row(2 * DAY + 480)], "2024-02-02 00:00:00")
    M.build_warehouse(spark, second, w, z, root, RULES, run_id="r2")
    after = releases.current(spark, f"{root}/gold")
    for name, column in M.DATED.items():
        differ = {k for k in before.tables[name].keys() | after.tables[name].keys() if before.tables[name].get(k) != after.tables[name].get(k)}
        assert differ == {f"{column}=20230102", f"{column}=20230103"}, name
    # the same as a build of everything at once
    whole = os.path.join(tmp_root, "whole")
    M.build_warehouse(spark, first.unionByName(second), w, z, whole, RULES, run_id="all")
    for name in ALL:
        assert gold(spark, root, name) == gold(spark, whole, name), name
    # stored days give the reports of hours and trips
    agg, fact = M.read_gold(spark, root, "gold_agg_demand_weather"), M.read_gold(spark, root, "gold_fact_trips")
    days, trip_days = M.read_gold(spark, root, "gold_demand_days"), M.read_gold(spark, root, "gold_trip_days")
    for by in (True, False):
        assert sorted(map(str, reports.weather_impact_of_days(days, by, RULES).collect())) == sorted(map(str, reports.weather_impact(agg, by, RULES).collect()))
    assert sorted(map(str, reports.holiday_demand_of_days(trip_days).collect())) == sorted(map(str, reports.holiday_demand(fact).collect()))
    # a filter on the date key prunes partitions
    plan = fact.where("pickup_date_id = 20230102")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(pickup_date_id" in plan


def test_changed_weather_and_zones_reach_their_dates(spark, tmp_root):
    root = os.path.join(tmp_root, "wh")
    first = trips(spark, tmp_root, "a", [tlc_row(DAY * d + 60 * k) for d in range(4) for k in range(3)], "2024-02-01 00:00:00")
    M.build_warehouse(spark, first, weather(spark, tmp_root), zones(spark, tmp_root), root, RULES, run_id="r1")
    before = releases.current(spark, f"{root}/gold")
    none = first.limit(0)
    rainy = weather(spark, tmp_root, "rain.json", rain=("2023-01-04T01:00",))
    M.build_warehouse(spark, none, rainy, zones(spark, tmp_root), root, RULES, run_id="r2")
    after = releases.current(spark, f"{root}/gold")
    differ = [k for k in after.tables["gold_fact_trips"] if before.tables["gold_fact_trips"][k] != after.tables["gold_fact_trips"][k]]
    assert differ == ["pickup_date_id=20230104"]
    M.build_warehouse(spark, none, rainy, zones(spark, tmp_root, "Bronx"), root, RULES, run_id="r3")
    whole = os.path.join(tmp_root, "whole")
    M.build_warehouse(spark, first, rainy, zones(spark, tmp_root, "Bronx"), whole, RULES, run_id="all")
    for name in ALL:
        assert gold(spark, root, name) == gold(spark, whole, name), name


def test_failing_gate_under_full_refresh_leaves_silver(spark, tmp_root):
    root = os.path.join(tmp_root, "wh")
    first = trips(spark, tmp_root, "a", [tlc_row(k) for k in range(5)], "2024-02-01 00:00:00")
    w, z = weather(spark, tmp_root), zones(spark, tmp_root)
    columns = list(first.columns)
    M.build_warehouse(spark, first, w, z, root, RULES, run_id="r1")
    assert first.columns == columns and first.schema.names == columns  # the caller's frame is as it was
    trips_root = f"{root}/silver/stg_taxi_trips"
    old = snapshots.current(spark, trips_root)

    def fail(self, written):
        return {"stg_taxi_trips not null": 1}

    with pytest.MonkeyPatch.context() as m:
        m.setattr(Q.RowChecks, "failures", fail)
        with pytest.raises(Q.QualityGateError):
            M.load_trips(spark, first, "r2", f"{root}/bronze/raw_taxi_trips", trips_root, RULES, full_refresh=True,
                         gated=lambda rows, counted: Q.gate({}, counted=counted))
    assert snapshots.current(spark, trips_root) == old and read_silver(spark, trips_root).count() == 5
    # and a refresh that passes rebuilds from all completed loads, without the failed one's rows twice
    M.build_warehouse(spark, trips(spark, tmp_root, "b", [tlc_row(50)], "2024-02-02 00:00:00"), w, z, root, RULES, run_id="r3", full_refresh=True)
    assert read_silver(spark, trips_root).count() == 6
    new = snapshots.current(spark, trips_root)
    assert not set(new.parts.values()) & set(old.parts.values())


@pytest.mark.parametrize("order", ["build first", "stream first"])
def test_build_and_stream_share_a_warehouse(spark, tmp_root, order):
    """The README's two commands on one warehouse, in either order; every file is loaded once."""
    from citylake.__main__ import main

    land, out = os.path.join(tmp_root, "landing"), os.path.join(tmp_root, "wh")
    os.makedirs(land)
    weather(spark, tmp_root)
    zones(spark, tmp_root)
    build = ["build", "--trips", f"{land}/*.parquet", "--weather", f"{tmp_root}/weather.json", "--zones", f"{tmp_root}/zones-Queens.csv", "--out", out]
    stream = ["stream", "--landing", land, "--bronze", f"{out}/bronze/raw_taxi_trips", "--silver", f"{out}/silver/stg_taxi_trips",
              "--checkpoint", f"{tmp_root}/ckpt"]
    write_tlc(os.path.join(land, "yellow_tripdata_2023-01.parquet"), [tlc_row(k) for k in range(6)])
    jobs = [build, stream] if order == "build first" else [stream, build]
    assert main(jobs[0]) == 0
    import pandas as pd

    # a second month whose counts are whole numbers, and a file that only the second job sees new
    second = os.path.join(land, "yellow_tripdata_2023-02.parquet")
    write_tlc(second, [tlc_row(DAY), tlc_row(0, fare=11.0)])
    pd.read_parquet(second).assign(passenger_count=pd.Series([1, 1], dtype="int64")).to_parquet(second, index=False, coerce_timestamps="us")
    assert main(jobs[1]) == 0
    assert main(jobs[0]) == 0  # nothing new for it
    if order == "build first":
        assert main(["gold", "--out", out]) == 0
    from citylake.plans.loads import read_bronze

    bronze = read_bronze(spark, f"{out}/bronze/raw_taxi_trips")
    assert {r["SOURCE_FILE"]: r["count"] for r in bronze.groupBy("SOURCE_FILE").count().collect()} == {
        "yellow_tripdata_2023-01.parquet": 6, "yellow_tripdata_2023-02.parquet": 2}
    assert read_silver(spark, f"{out}/silver/stg_taxi_trips").count() == 7
    fact = M.read_gold(spark, out, "gold_fact_trips")
    assert fact.count() == 7 and fact.where("fare_amount = 11").count() == 1
    assert files.table(spark, "silver", "stg_taxi_trips", root=out).count() == 7


def test_row_checks_are_counted_by_the_write(spark, tmp_root):
    from pyspark.sql import functions as F

    rows = spark.range(100).select(F.when(F.col("id") % 10 > 0, F.col("id")).alias("k"), F.col("id").cast("string").alias("c"))
    checks = Q.RowChecks({"k not null": Q.any_null(["k"]), "c accepted": Q.not_accepted("c", [str(k) for k in range(98)])})
    checks.observe(rows).write.parquet(os.path.join(tmp_root, "t"))
    none = spark.range(0).selectExpr("id AS k", "'a' AS c")  # the counts are the write's: what is passed here is not scanned
    assert checks.failures(none) == {"k not null": 10, "c accepted": 2}
    with pytest.raises(Q.QualityGateError) as e:
        Q.gate({}, counted=checks.failures(none))
    assert e.value.failures == {"k not null": 10, "c accepted": 2}


def test_unique_each(spark):
    df = spark.createDataFrame([(1, "a"), (1, "b"), (None, "b"), (None, None)], "x int, y string")
    assert sorted(map(tuple, Q.unique_each(df, ["x", "y"]).collect())) == [("x", "1", 2), ("y", "b", 2)]


def test_gate_scans_a_layer_twice_at_most(spark, tmp_root, monkeypatch):
    """J2 and J3 come from the write; each written table is scanned for J1, the fact once more for J4."""
    scans = []
    plain = Q.gate

    def gate(checks, parallelism=8, counted=None):
        scans.append(sorted(checks))
        return plain(checks, parallelism, counted)

    monkeypatch.setattr(Q, "gate", gate)
    first = trips(spark, tmp_root, "a", [tlc_row(k) for k in range(5)], "2024-02-01 00:00:00")
    M.build_warehouse(spark, first, weather(spark, tmp_root), zones(spark, tmp_root), os.path.join(tmp_root, "wh"), RULES, run_id="r1")
    assert scans == [
        ["stg_weather_hourly.weather_time unique"], ["stg_zone_lookup.location_id unique"], ["stg_taxi_trips.trip_id unique"],
        ["dim_calendar.date_id/date_day unique", "gold_agg_demand_weather.agg_id unique", "gold_fact_trips grain", "gold_fact_trips.trip_id unique"],
    ]


def test_days_merge_like_hours(spark):
    """Hours of one day in two categories and boroughs are counted once where they are merged."""
    rows = [("2023-01-01 05:00:00", "Rain", "A", 2, 10.0), ("2023-01-01 05:00:00", "Rain", "B", 3, 20.0), ("2023-01-01 06:00:00", "Rain", "A", 1, 5.0),
            ("2023-01-02 05:00:00", "Rain", "A", 4, 1.0), ("2023-01-02 05:00:00", None, None, 1, 1.0)]
    agg = spark.createDataFrame(rows, "h string, weather_category string, pickup_borough string, total_trips long, total_revenue double").selectExpr(
        "CAST(h AS TIMESTAMP_NTZ) AS pickup_hour_truncated", "weather_category", "pickup_borough", "total_trips", "total_revenue")
    days = facts.demand_days(agg, RULES)
    for by in (True, False):
        got = sorted(map(str, reports.weather_impact_of_days(days, by, RULES).collect()))
        assert got == sorted(map(str, reports.weather_impact(agg, by, RULES).collect()))
