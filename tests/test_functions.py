"""Scalar functions, including the dialect traps listed in SURVEY section 8."""

import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from citylake.functions import columns as C


def one(spark, expr, data, schema):
    return [r[0] for r in spark.createDataFrame(data, schema).select(expr.alias("x")).collect()]


def test_to_int_rounds_half_away_from_zero(spark):
    got = one(spark, C.to_int("v"), [(0.5,), (2.5,), (-2.5,), (1.49,), (None,)], "v double")
    assert got == [1, 3, -3, 1, None]


def test_repair_epoch_numeric_seconds_millis_micros(spark):
    secs = 1672533129  # 2023-01-01 00:32:09
    data = [(secs,), (secs * 1000 + 971,), (secs * 1_000_000 + 971_200,), (None,)]
    got = one(spark, C.repair_epoch("v", T.LongType()), data, "v long")
    assert got[0] == dt.datetime(2023, 1, 1, 0, 32, 9)
    assert got[1] == dt.datetime(2023, 1, 1, 0, 32, 9, 971000)
    assert got[2] == dt.datetime(2023, 1, 1, 0, 32, 9, 971200)
    assert got[3] is None


def test_repair_epoch_timestamp_kept_or_rescaled(spark):
    good = dt.datetime(2023, 1, 1, 0, 32, 9, 500000)
    df = spark.createDataFrame([(good,)], "v timestamp_ntz")
    # a timestamp whose epoch seconds are really milliseconds (year ~ 55000)
    bad = df.select(F.timestamp_seconds(F.lit(1672533129000)).cast("timestamp_ntz").alias("v"))
    assert df.select(C.repair_epoch("v", T.TimestampNTZType())).first()[0] == good
    assert bad.select(C.repair_epoch("v", T.TimestampNTZType())).first()[0] == dt.datetime(2023, 1, 1, 0, 32, 9)


def test_minutes_crossed_counts_boundaries(spark):
    df = spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, 0, 0, 59), dt.datetime(2024, 1, 1, 0, 1, 1)),
         (dt.datetime(2024, 1, 1, 0, 0, 0), dt.datetime(2024, 1, 1, 3, 0, 0)),
         (dt.datetime(2024, 1, 1, 0, 0, 10), dt.datetime(2024, 1, 1, 0, 0, 50))],
        "a timestamp_ntz, b timestamp_ntz",
    )
    assert [r[0] for r in df.select(C.minutes_crossed("a", "b")).collect()] == [1, 180, 0]


def test_calendar_parts(spark):
    d = dt.date(2024, 1, 7)  # a Sunday
    df = spark.createDataFrame([(d,)], "d date")
    r = df.select(
        C.day_of_week0("d"), C.date_key("d"), C.month_abbr("d"), C.day_abbr("d"), F.weekofyear("d"),
    ).first()
    assert df.select(C.day_of_week0("d").alias("w")).select(C.weekend_flag("w")).first()[0] is True
    assert tuple(r) == (0, 20240107, "Jan", "Sun", 1)


def test_truncate_hour_stays_ntz(spark):
    df = spark.createDataFrame([(dt.datetime(2024, 3, 10, 2, 30),)], "t timestamp_ntz")
    out = df.select(C.truncate_hour("t").alias("h"))
    assert isinstance(out.schema["h"].dataType, T.TimestampNTZType)
    assert out.first()[0] == dt.datetime(2024, 3, 10, 2, 0)


def test_trip_key_nulls_and_milliseconds(spark):
    t = dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    df = spark.createDataFrame([(1, t, 5), (None, t, 5)], "v int, p timestamp_ntz, l int")
    got = [r[0] for r in df.select(C.trip_key("v", "p", "l")).collect()]
    import hashlib

    assert got[0] == hashlib.md5(b"1-2024-01-01 00:00:07.179-5").hexdigest()
    assert got[1] is None


def test_null_safe_key(spark):
    df = spark.createDataFrame([("a", None)], "x string, y string")
    import hashlib

    got = df.select(C.null_safe_key(["x", "y"])).first()[0]
    assert got == hashlib.md5(b"a-_null_").hexdigest()


def test_weather_category_and_flags(spark):
    codes = [0, 3, 45, 48, 51, 67, 71, 77, 80, 82, 85, 86, 95, 99, 10, None]
    got = one(spark, C.weather_category("c"), [(c,) for c in codes], "c int")
    assert got == ["Clear", "Clear", "Fog", "Fog", "Rain", "Rain", "Snow", "Snow", "Showers", "Showers",
                   "Snow Showers", "Snow Showers", "Thunderstorm", "Thunderstorm", "Unknown", "Unknown"]
    flags = one(spark, C.precipitation_flag("r", "s"), [(0.0, 0.0), (0.1, None), (None, None)], "r double, s double")
    assert flags == [False, True, False]


def test_zone_flags(spark):
    df = spark.createDataFrame([("JFK Airport", "Queens"), ("Midtown", "Manhattan"), ("x", "Unknown")],
                               "z string, b string")
    r = df.select(C.airport_flag("z"), C.borough_group("b")).collect()
    assert [tuple(x) for x in r] == [(True, "Outer Boroughs"), (False, "Core"), (False, "Unknown")]


def test_holidays(spark):
    df = spark.createDataFrame([(1, 1), (7, 4), (11, 11), (12, 25), (12, 24)], "m int, d int")
    assert [r[0] for r in df.select(C.holiday_name("m", "d")).collect()] == [
        "New Years Day", "Independence Day", "Veterans Day", "Christmas Day", None]


def test_co2_per_passenger_mile_zero_denominator(spark):
    got = one(spark, C.co2_per_passenger_mile("c", "d", "p"), [(100.0, 2.0, 0), (100.0, 2.0, 5)],
              "c double, d double, p int")
    assert got == [None, 10.0]
