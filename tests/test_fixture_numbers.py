"""The expected numbers of FIXTURES.md section 6 (sf0.01), pinned."""

import os

import pytest
from pyspark.sql import functions as F

from citylake.plans.warehouse import Warehouse
from citylake.sources import fixtures

SF = "/root/testdata/sf0.01"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.from_testdata(spark, SF)


def test_trip_counts_and_flags(wh):
    assert wh.raw_trips.count() == 11000
    assert wh.latest_trips.count() == 10000
    s = wh.stg_trips
    r = s.agg(
        F.count(F.lit(1)).alias("n"), F.count_distinct("trip_id").alias("ids"),
        F.sum(F.col("is_distance_anomaly").cast("int")).alias("dist"),
        F.sum(F.col("is_fare_anomaly").cast("int")).alias("fare"),
        F.count_distinct("pickup_hour_truncated").alias("hours"),
        F.sum("trip_duration_minutes").alias("minutes"), F.min("trip_id").alias("min_id"),
        F.sum((F.col("emission_factor") == 406.0).cast("int")).alias("no_factor"),
    ).first()
    assert (r.n, r.ids, r.dist, r.fare, r.hours, r.minutes) == (7007, 7007, 892, 857, 720, 631037)
    assert r.min_id == "00081cfc097ef493d9bf47af80dbeb14"


def test_fact_and_aggregate(wh):
    f = wh.fact_trips.agg(
        F.count(F.lit(1)).alias("n"),
        F.sum(F.col("weather_category").isNull().cast("int")).alias("no_weather"),
        F.sum((F.col("pickup_borough") == "Unknown").cast("int")).alias("unknown"),
    ).first()
    assert (f.n, f.no_weather, f.unknown) == (7007, 125, 244)
    a = wh.agg_demand_weather.agg(
        F.count(F.lit(1)).alias("groups"), F.sum("total_trips").alias("trips"),
        F.round(F.sum("total_co2_grams"), 2).alias("co2"), F.min("agg_id").alias("min_id"),
    ).first()
    assert (a.groups, a.trips, a.co2) == (3127, 5372, 74778331.97)
    assert a.min_id == "00060883b482861d9fbd6083017ece73"


def test_price_short_factor_and_zone_counts(wh):
    fin = wh.fact_financials.where("is_price_anomaly").count()
    short = wh.stg_trips.where("trip_distance < 1.5").count()
    no_factor = wh.stg_trips.where("emission_factor = 406.0").count()
    no_zone = wh.fact_trips.where("pickup_zone IS NULL").count()
    assert (fin, short, no_factor, no_zone) == (580, 211, 3446, 508)
    # the sustainability fact counts short trips after dropping anomalies
    assert wh.fact_sustainability.where("is_short_efficiency_risk").count() == 197


def test_lineitem_fixture(spark):
    li = fixtures.table(spark, SF, "lineitem")
    latest = fixtures.latest_lineitem(li, fixtures.table(spark, SF, "orders"))
    assert li.count() == 60000
    assert latest.count() == 45832
    assert fixtures.time_ordered(latest).count() == 25678
