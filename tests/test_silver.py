"""Silver trip model on hand-made bronze rows (FIXTURES section 7)."""

import datetime as dt

import pytest

from citylake.config import Rules
from citylake.plans import silver
from citylake.sources.schemas import RAW_TRIPS_SCHEMA
from citylake.sources.seeds import seed

T0 = dt.datetime(2024, 1, 1, 10, 0, 0)
L1, L2 = dt.datetime(2024, 2, 1, 0), dt.datetime(2024, 2, 1, 1)


def raw(spark, rows):
    """rows: dicts of bronze columns; everything else null."""
    names = [f.name for f in RAW_TRIPS_SCHEMA.fields]
    return spark.createDataFrame([tuple(r.get(n) for n in names) for r in rows], RAW_TRIPS_SCHEMA)


def trip(v=1, p=T0, d=None, pas=1.0, dist=2.0, pu=5, do=6, rate=1.0, pay=1, fare=12.0, src="f1", at=L1):
    return {"VENDORID": v, "TPEP_PICKUP_DATETIME": p, "TPEP_DROPOFF_DATETIME": d or p + dt.timedelta(minutes=10),
            "PASSENGER_COUNT": pas, "TRIP_DISTANCE": dist, "PULOCATIONID": pu, "DOLOCATIONID": do,
            "RATECODEID": rate, "PAYMENT_TYPE": pay, "FARE_AMOUNT": fare, "SOURCE_FILE": src, "LOADED_AT": at}


@pytest.fixture()
def stg(spark):
    def run(rows, rules=Rules()):
        return silver.stg_taxi_trips(raw(spark, rows), seed(spark, "seed_emission_factors"), rules)
    return run


def test_newest_copy_bad_drops_trip(stg):
    out = stg([trip(fare=12.0, at=L1), trip(fare=-3.0, at=L2)])
    assert out.count() == 0


def test_newest_copy_wins(stg):
    out = stg([trip(fare=12.0, at=L1), trip(fare=13.0, at=L2)]).collect()
    assert [r.fare_amount for r in out] == [13.0]


def test_null_loaded_at_counts_as_newest(stg):
    out = stg([trip(fare=12.0, at=L2), trip(fare=14.0, at=None)]).collect()
    assert [r.fare_amount for r in out] == [14.0]


def test_reload_of_same_file_is_deduplicated(stg):
    out = stg([trip(), trip()])
    assert out.count() == 1


def test_half_passengers_round_away_from_zero(stg):
    out = stg([trip(pas=0.5, pu=1), trip(pas=2.5, pu=2)]).collect()
    assert sorted(r.passenger_count for r in out) == [1, 3]


def test_boundaries_fare_500_distance_100_duration_180(stg):
    rows = [trip(fare=500.0, pu=1), trip(dist=100.0, pu=2), trip(d=T0 + dt.timedelta(minutes=180), pu=3),
            trip(fare=500.01, pu=4), trip(dist=100.01, pu=5), trip(d=T0 + dt.timedelta(minutes=181), pu=6)]
    out = {r.pickup_location_id: r for r in stg(rows).collect()}
    assert set(out) == {1, 2, 3, 4, 5}
    assert not out[1].is_fare_anomaly and out[4].is_fare_anomaly
    assert not out[2].is_distance_anomaly and out[5].is_distance_anomaly
    assert out[3].trip_duration_minutes == 180


def test_two_seconds_across_a_minute(stg):
    p = dt.datetime(2024, 1, 1, 10, 0, 59)
    out = stg([trip(p=p, d=p + dt.timedelta(seconds=2))]).collect()
    assert out[0].trip_duration_minutes == 1


def test_null_vendor_gives_null_trip_id_and_default_factor(stg):
    out = {r.vendor_id: r for r in stg([trip(v=None, pu=1), trip(v=3, pu=2), trip(v=2, pu=3)]).collect()}
    assert out[None].trip_id is None
    assert out[3].emission_factor == 406.0 and out[3].co2_emission_grams == 2.0 * 406.0
    assert out[2].emission_factor == 411.0


def test_epoch_micro_columns_are_repaired(spark):
    secs = int(T0.replace(tzinfo=dt.timezone.utc).timestamp())
    df = raw(spark, [trip()]).drop("TPEP_PICKUP_DATETIME", "TPEP_DROPOFF_DATETIME")
    from pyspark.sql import functions as F
    df = df.withColumn("TPEP_PICKUP_DATETIME", F.lit(secs * 1_000_000)).withColumn(
        "TPEP_DROPOFF_DATETIME", F.lit((secs + 600) * 1_000_000))
    out = silver.stg_taxi_trips(df, seed(spark, "seed_emission_factors")).collect()
    assert out[0].pickup_datetime == T0 and out[0].trip_duration_minutes == 10


def test_columns_and_plan(stg):
    out = stg([trip()])
    assert len(out.columns) == 23
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1  # only the dedup shuffle
    assert "BroadcastHashJoin" in plan


def test_weather_and_zones(spark):
    from pyspark.sql import types as T
    from citylake.sources.schemas import RAW_WEATHER_SCHEMA
    w = spark.createDataFrame([("2023-01-01T05:00", 1.0, 0.0, 0.2, 3.0, 71, "u", "x"),
                               ("2023-01-01T06:00", 1.0, None, None, 3.0, None, "u", "x")], RAW_WEATHER_SCHEMA)
    out = silver.stg_weather_hourly(w).collect()
    assert out[0].weather_time == dt.datetime(2023, 1, 1, 5) and out[0].weather_category == "Snow"
    assert out[0].is_precipitation and not out[1].is_precipitation and out[1].weather_category == "Unknown"
    z = spark.createDataFrame([(264, None, None, None, "u", "x")],
                              "LOCATIONID int, BOROUGH string, ZONE string, SERVICE_ZONE string, SOURCE_URL string, LOADED_AT string")
    r = silver.stg_zone_lookup(z).first()
    assert (r.borough, r.zone, r.service_zone) == ("Unknown", "Unknown", "Unknown")
