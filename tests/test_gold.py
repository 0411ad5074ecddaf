"""Gold facts and reports on hand-made silver rows (FIXTURES section 7 edge cases)."""

import datetime as dt

import pytest

from citylake.config import Rules
from citylake.plans import dims, facts, reports, silver
from citylake.sources.seeds import seed
from test_silver import raw, trip


@pytest.fixture()
def stg(spark):
    def run(rows, rules=Rules(run_ts=dt.datetime(2024, 3, 1))):
        return silver.stg_taxi_trips(raw(spark, rows), seed(spark, "seed_emission_factors"), rules)
    return run


def test_price_anomaly_boundary_and_airport_flag(stg):
    rows = [trip(rate=2.0, fare=70.5, pu=1), trip(rate=2.0, fare=70.51, pu=2), trip(rate=2.0, fare=69.5, pu=3),
            trip(rate=3.0, fare=99.0, pu=4), trip(rate=1.0, fare=12.0, pu=5)]
    fin = {r.trip_id: r for r in facts.gold_fact_financials(stg(rows)).collect()}
    by_fare = {r.fare_amount: r for r in fin.values()}
    assert not by_fare[70.5].is_price_anomaly and by_fare[70.51].is_price_anomaly
    assert not by_fare[69.5].is_price_anomaly
    assert by_fare[99.0].is_airport_trip and not by_fare[99.0].is_price_anomaly and by_fare[99.0].fare_variance == 0.0
    assert by_fare[12.0].expected_fare == 12.0 and not by_fare[12.0].is_airport_trip


def test_pickup_outside_calendar_and_missing_weather(spark, stg):
    t_out = dt.datetime(2022, 12, 31, 23, 30)  # calendar starts 2023-01-01
    t_in = dt.datetime(2023, 12, 25, 8, 15)
    s = stg([trip(p=t_out, pu=1), trip(p=t_in, pu=2)])
    w = spark.createDataFrame([(dt.datetime(2023, 12, 25, 8), 1.0, True, "Snow")],
                              "weather_time timestamp_ntz, temperature_2m double, is_precipitation boolean, weather_category string")
    z = spark.createDataFrame([(2, "Manhattan", "Midtown")], "location_id int, borough string, zone string")
    f = {r.pickup_location_id: r for r in facts.gold_fact_trips(s, w, z, dims.dim_calendar(spark)).collect()}
    assert f[1].is_holiday is None and f[1].weather_category is None and f[1].pickup_borough is None
    assert f[1].pickup_date_id == 20221231
    assert f[2].is_holiday and f[2].holiday_name == "Christmas Day" and f[2].weather_category == "Snow"
    assert f[2].pickup_borough == "Manhattan"


def test_sustainability_filters_anomalies_and_nulls_zero_passenger_mile(stg):
    s = stg([trip(dist=150.0, pu=1), trip(dist=1.2, pu=2), trip(fare=600.0, pu=3)])
    out = facts.gold_fact_sustainability(s).collect()
    assert len(out) == 1 and out[0].is_short_efficiency_risk
    assert out[0].co2_emission_kg == pytest.approx(1.2 * 400.0 / 1000)


def test_christmas_week_top_vendor(spark):
    rows = [(1, dt.datetime(2023, 12, 26, 9), "Brooklyn", 1, 500.0), (2, dt.datetime(2023, 12, 27, 9), "Brooklyn", 1, 700.0),
            (2, dt.datetime(2023, 12, 20, 9), "Brooklyn", 1, 9000.0),   # week before
            (1, dt.datetime(2023, 12, 28, 9), "Queens", 1, 9000.0),     # other borough
            (1, dt.datetime(2023, 12, 28, 9), "Brooklyn", 2, 9000.0)]   # cash
    f = spark.createDataFrame(rows, "vendor_id int, pickup_datetime timestamp_ntz, pickup_borough string, "
                                    "payment_type_id int, co2_emission_grams double")
    top = reports.top_vendor_co2(f, "2023-12-25", "Brooklyn", 1).collect()
    assert [(r.vendor_id, r.total_co2_grams, r.trips) for r in top] == [(2, 700.0, 1)]


def test_flat_rate_discovery_tie_takes_lower_fare(spark):
    rows = [(2, 70.0)] * 3 + [(2, 52.0)] * 3 + [(2, 10.0)] + [(1, 8.5)]
    df = spark.createDataFrame(rows, "rate_code_id int, fare_amount double")
    got = {r.rate_code_id: r for r in reports.flat_rate_discovery(df).collect()}
    assert (got[2].top_fare, got[2].top_fare_trips, got[2].trips) == (52.0, 3, 7)
    assert got[1].top_fare_share == 1.0


def test_agg_null_groups_kept_and_key_unique(spark):
    rows = [(dt.datetime(2024, 1, 1, 5), 0, None, None, False, 1, 10.0, 400.0, 5, 1.0),
            (dt.datetime(2024, 1, 1, 5), 0, None, None, False, 2, 20.0, 800.0, 7, 2.0),
            (dt.datetime(2024, 1, 1, 5), 0, "Queens", "Rain", True, 1, 30.0, 400.0, 9, 1.0)]
    f = spark.createDataFrame(rows, "pickup_hour_truncated timestamp_ntz, pickup_day_of_week int, pickup_borough string, "
                                    "weather_category string, is_precipitation boolean, passenger_count int, "
                                    "fare_amount double, co2_emission_grams double, trip_duration_minutes long, "
                                    "trip_distance double")
    from pyspark.sql import functions as F
    f = f.withColumn("is_distance_anomaly", F.lit(False)).withColumn("is_fare_anomaly", F.lit(False))
    agg = {r.pickup_borough: r for r in facts.gold_agg_demand_weather(f).collect()}
    assert agg[None].total_trips == 2 and agg[None].total_passengers == 3 and agg[None].avg_fare_amount == 15.0
    assert agg[None].agg_id != agg["Queens"].agg_id


def test_production_sums_agree_with_the_rounded_ones(spark):
    """The default rules (no ``sum_scale``) against the fixture's, which the oracle checks."""
    import pytest

    from citylake.plans.warehouse import FIXTURE_RULES, Warehouse

    key = ["agg_id", "pickup_day_of_week", "is_precipitation"]
    sums = ["total_revenue", "total_co2_grams", "avg_co2_grams_per_trip", "avg_fare_amount", "avg_trip_distance"]
    got, want = (
        {tuple(map(str, r[:3])): r[3:] for r in Warehouse.from_testdata(spark, "/root/testdata/sf0.001", rules).agg_demand_weather.select(*key, *sums).collect()}
        for rules in (FIXTURE_RULES.with_(sum_scale=None), FIXTURE_RULES)
    )
    assert got.keys() == want.keys() and len(got) > 100
    for k, row in want.items():
        assert list(got[k]) == pytest.approx(list(row), abs=0.006)
