"""End-to-end materialisation with the quality gate, on the sf0.001 fixtures."""

import os

import pytest

from citylake.operators.quality import QualityGateError
from citylake.plans.loads import read_silver
from citylake.plans.materialize import build_warehouse, read_gold
from citylake.plans.warehouse import FIXTURE_RULES, Warehouse

SF = "/root/testdata/sf0.001"


def test_build_matches_lazy_models(spark, tmp_root):
    wh = Warehouse.from_testdata(spark, SF)
    out = build_warehouse(spark, wh.raw_trips, wh.raw_weather, wh.raw_zones, os.path.join(tmp_root, "wh"),
                       FIXTURE_RULES, silver_layout="versioned")
    assert spark.read.parquet(out["stg_taxi_trips"]).count() == wh.stg_trips.count()
    assert read_gold(spark, os.path.join(tmp_root, "wh"), "gold_fact_trips").count() == wh.fact_trips.count()
    agg = read_gold(spark, os.path.join(tmp_root, "wh"), "gold_agg_demand_weather")
    got = sorted(map(tuple, agg.select("agg_id", "total_trips").collect()))
    want = sorted(map(tuple, wh.agg_demand_weather.select("agg_id", "total_trips").collect()))
    assert got == want
    # second run merges into a new silver version and keeps the same result
    out2 = build_warehouse(spark, wh.raw_trips, wh.raw_weather, wh.raw_zones, os.path.join(tmp_root, "wh"), FIXTURE_RULES,
                       silver_layout="versioned")
    assert out2["stg_taxi_trips"] != out["stg_taxi_trips"]
    assert spark.read.parquet(out2["stg_taxi_trips"]).count() == wh.stg_trips.count()


def test_gate_stops_on_duplicate_weather_hours(spark, tmp_root):
    wh = Warehouse.from_testdata(spark, SF)
    doubled = wh.raw_weather.unionByName(wh.raw_weather)
    with pytest.raises(QualityGateError) as e:
        build_warehouse(spark, wh.raw_trips, doubled, wh.raw_zones, os.path.join(tmp_root, "bad"), FIXTURE_RULES)
    assert "stg_weather_hourly.weather_time unique" in e.value.failures
    assert not os.path.exists(os.path.join(tmp_root, "bad", "gold"))


def test_build_with_date_partitioned_silver(spark, tmp_root):
    wh = Warehouse.from_testdata(spark, SF)
    root = os.path.join(tmp_root, "dated")
    for run in ("r1", "r2"):
        out = build_warehouse(spark, wh.raw_trips, wh.raw_weather, wh.raw_zones, root, FIXTURE_RULES,
                              silver_layout="by_pickup_date", run_id=run)
    from citylake.sinks import snapshots

    assert len(snapshots.current(spark, out["stg_taxi_trips"]).parts) >= 28
    assert read_silver(spark, out["stg_taxi_trips"]).count() == wh.stg_trips.count()
    assert read_gold(spark, root, "gold_fact_trips").count() == wh.stg_trips.count()


def test_failing_gate_leaves_silver_and_gold_current(spark, tmp_root):
    wh = Warehouse.from_testdata(spark, SF)
    root = os.path.join(tmp_root, "gated")
    out = build_warehouse(spark, wh.raw_trips, wh.raw_weather, wh.raw_zones, root, FIXTURE_RULES, run_id="good")
    trips = read_silver(spark, out["stg_taxi_trips"]).count()
    weather = spark.read.parquet(out["stg_weather_hourly"]).count()
    with pytest.raises(QualityGateError):
        build_warehouse(spark, wh.raw_trips, wh.raw_weather.unionByName(wh.raw_weather), wh.raw_zones, root, FIXTURE_RULES, run_id="bad")
    from citylake import sinks

    assert read_silver(spark, out["stg_taxi_trips"]).count() == trips
    assert sinks.read_current(spark, os.path.join(root, "silver", "stg_weather_hourly")).count() == weather
    assert read_gold(spark, root, "gold_fact_trips").count() == trips
    with pytest.raises(QualityGateError) as e:
        build_warehouse(spark, wh.raw_trips, wh.raw_weather, wh.raw_zones, root, FIXTURE_RULES, run_id="gaps", check_gaps=True)
    assert list(e.value.failures) == ["stg_weather_hourly missing hours"]


def test_bronze_lets_a_later_run_see_older_copies(spark, tmp_root):
    """A re-sent copy that arrives alone still competes with the copy of the first run."""
    from pyspark.sql import functions as F

    wh = Warehouse.from_testdata(spark, SF)
    root = os.path.join(tmp_root, "bronze")
    newest = wh.raw_trips.where("SOURCE_FILE = 'events_resend.parquet'")
    build_warehouse(spark, newest, wh.raw_weather, wh.raw_zones, root, FIXTURE_RULES, run_id="newest")
    first = wh.raw_trips.where("SOURCE_FILE = 'events.parquet'")
    out = build_warehouse(spark, first, wh.raw_weather, wh.raw_zones, root, FIXTURE_RULES, run_id="older")
    got = sorted(map(tuple, read_silver(spark, out["stg_taxi_trips"]).select("trip_id", F.round("fare_amount", 2)).collect()))
    assert got == sorted(map(tuple, wh.stg_trips.select("trip_id", F.round("fare_amount", 2)).collect()))
