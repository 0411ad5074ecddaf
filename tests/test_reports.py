"""Report semantics on hand-made gold rows."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from citylake.config import Rules
from citylake.plans import reports

H = dt.datetime(2024, 1, 1, 8)


@pytest.fixture()
def fact(spark):
    rows = [  # pickup, borough, zone, loc, weather, precip, vendor, payment, fare, co2, holiday, date_id, temp
        (H, "Manhattan", "Midtown", 1, "Rain", True, 1, 1, 10.0, 400.0, True, 20240101, 5.0),
        (H, "Manhattan", "Midtown", 1, "Rain", True, 2, 2, 20.0, 822.0, True, 20240101, 5.0),
        (H + dt.timedelta(hours=1), "Queens", "JFK Airport", 2, "Snow", True, 1, 1, 70.0, 4000.0, True, 20240101, -1.0),
        (H + dt.timedelta(days=1), "Manhattan", "Midtown", 1, "Clear", False, 1, 1, 12.0, 800.0, False, 20240102, 9.0),
        (H + dt.timedelta(days=1, hours=2), "Manhattan", "Midtown", 1, "Clear", False, 2, 2, 14.0, 1233.0, False, 20240102, 9.0),
        (H + dt.timedelta(days=2), "Queens", "Astoria", 3, "Clear", False, 1, 1, 9.0, 400.0, False, 20240103, 12.0),
    ]
    return spark.createDataFrame(rows, "pickup_datetime timestamp_ntz, pickup_borough string, pickup_zone string, "
                                       "pickup_location_id int, weather_category string, is_precipitation boolean, "
                                       "vendor_id int, payment_type_id int, fare_amount double, "
                                       "co2_emission_grams double, is_holiday boolean, pickup_date_id int, "
                                       "temperature_2m double")


def test_kpis_and_filters(fact):
    r = reports.kpi_tiles(fact).first()
    assert (r.total_revenue, r.total_co2_grams, r.trip_count) == (135.0, 7655.0, 6)
    f = reports.apply_filters(fact, "2024-01-02", "2024-01-03", ["Manhattan"], ["Clear"])
    assert reports.kpi_tiles(f).first().trip_count == 2


def test_pickup_density_and_top_k(fact):
    from citylake.operators.profile import top_k

    top = top_k(reports.pickup_density(fact), "pickups", 1, ["pickup_location_id"]).first()
    assert (top.pickup_zone, top.pickups) == ("Midtown", 4)


def test_weather_impact_from_aggregate(spark):
    agg = spark.createDataFrame(
        [("Rain", "Manhattan", H, 3, 30.0), ("Rain", "Manhattan", H + dt.timedelta(hours=1), 1, 10.0),
         ("Clear", "Manhattan", H, 4, 60.0)],
        "weather_category string, pickup_borough string, pickup_hour_truncated timestamp_ntz, total_trips long, "
        "total_revenue double")
    got = {r.weather_category: r for r in reports.weather_impact(agg).collect()}
    assert (got["Rain"].trips, got["Rain"].hours, got["Rain"].trips_per_hour, got["Rain"].avg_fare) == (4, 2, 2.0, 10.0)
    assert got["Clear"].avg_fare == 15.0


def test_co2_by_vendor(spark):
    s = spark.createDataFrame([(1, 400.0, 1.0), (1, 800.0, 2.0), (2, 0.0, 0.0)],
                              "vendor_id int, co2_emission_grams double, trip_distance double")
    got = {r.vendor_id: r for r in reports.co2_by_vendor(s).collect()}
    assert (got[1].trips, got[1].total_co2_kg, got[1].co2_grams_per_mile) == (2, 1.2, 400.0)
    assert got[2].co2_grams_per_mile is None  # zero distance


def test_payment_mix_shares_sum_to_one(fact):
    mix = reports.payment_mix(fact, "day").collect()
    per_day = {}
    for r in mix:
        per_day[r.period_start] = per_day.get(r.period_start, 0) + r.share
    assert all(abs(v - 1.0) < 1e-12 for v in per_day.values())
    assert len(per_day) == 3


def test_holiday_demand(fact):
    got = {r.is_holiday: r for r in reports.holiday_demand(fact).collect()}
    assert (got[True].trips, got[True].days, got[True].trips_per_day) == (3, 1, 3.0)
    assert (got[False].trips, got[False].days, got[False].trips_per_day) == (3, 2, 1.5)


def test_vendor_risk(spark):
    fin = spark.createDataFrame([(1, True, 1.0), (1, True, -3.0), (2, True, 0.75), (2, False, 9.0)],
                                "vendor_id int, is_price_anomaly boolean, fare_variance double")
    got = {r.vendor_id: (r.error_count, r.total_abs_variance) for r in reports.vendor_risk(fin).collect()}
    assert got == {1: (2, 4.0), 2: (1, 0.75)}


def test_short_trip_share(spark):
    s = spark.createDataFrame([(1, True), (1, False), (1, False), (2, True)],
                              "pickup_location_id int, is_short_efficiency_risk boolean")
    z = spark.createDataFrame([(1, "Midtown"), (2, "Astoria")], "location_id int, zone string")
    got = {r.pickup_zone: r.short_trip_share for r in reports.short_trip_share(s, z).collect()}
    assert got == {"Midtown": 1 / 3, "Astoria": 1.0}


def test_co2_correlation_perfect(spark):
    rows = [(H + dt.timedelta(hours=h), 100.0 * (h + 1), float(h), True) for h in range(5) for _ in range(h + 1)]
    f = spark.createDataFrame(rows, "pickup_hour_truncated timestamp_ntz, co2_emission_grams double, "
                                    "temperature_2m double, is_precipitation boolean")
    r = reports.co2_correlation(f.withColumn("co2_emission_grams", F.lit(100.0)), Rules(sum_scale=2)).first()
    assert r.hours == 5 and r.corr_trips_co2 == 1.0 and r.corr_temperature_trips == 1.0
