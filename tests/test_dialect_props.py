"""Column functions agree with DuckDB on random inputs (the dialect traps of
SURVEY section 8: rounding casts, minute boundaries, day-of-week base, ISO weeks,
month/day names, millisecond key text)."""

import datetime as dt
import random

import duckdb
import pandas as pd

from citylake.functions import columns as C


def test_functions_match_duckdb_on_random_rows(spark):
    rnd = random.Random(11)
    base = dt.datetime(2019, 12, 25)
    rows = []
    for _ in range(3000):
        a = base + dt.timedelta(seconds=rnd.randint(0, 5 * 365 * 86400), microseconds=rnd.randint(0, 999999))
        b = a + dt.timedelta(seconds=rnd.randint(-600, 4 * 3600), microseconds=rnd.randint(0, 999999))
        x = rnd.choice([rnd.uniform(-10, 10), rnd.randint(-5, 5) + 0.5])
        rows.append((a, b, x, rnd.randint(1, 4), rnd.randint(1, 265)))
    pdf = pd.DataFrame(rows, columns=["a", "b", "x", "v", "l"])
    sdf = spark.createDataFrame(rows, "a timestamp_ntz, b timestamp_ntz, x double, v int, l int")
    got = sdf.select(
        "a", "b", "x",
        C.minutes_crossed("a", "b").alias("m"),
        C.to_int("x").alias("i"),
        C.date_key("a").alias("k"),
        C.day_of_week0("a").alias("w"),
        C.month_abbr("a").alias("mn"),
        C.day_abbr("a").alias("dn"),
        C.trip_key("v", "a", "l").alias("t"),
        C.truncate_hour("a").alias("h"),
    ).toPandas()
    want = duckdb.sql("""
        SELECT a, b, x, date_diff('minute', a, b) AS m, CAST(round(x) AS INTEGER) AS i,
            CAST(year(a) * 10000 + month(a) * 100 + day(a) AS INTEGER) AS k,
            CAST(dayofweek(a) AS INTEGER) AS w, strftime(a, '%b') AS mn, strftime(a, '%a') AS dn,
            md5(CAST(v AS VARCHAR) || '-' || strftime(a, '%Y-%m-%d %H:%M:%S.%g') || '-' || CAST(l AS VARCHAR)) AS t,
            date_trunc('hour', a) AS h
        FROM pdf""").df()
    key = ["a", "b", "x"]
    got = got.sort_values(key).reset_index(drop=True)
    want = want.sort_values(key).reset_index(drop=True)
    for c in ["m", "i", "k", "w", "mn", "dn", "t"]:
        assert got[c].astype(str).tolist() == want[c].astype(str).tolist(), c
    assert (pd.to_datetime(got["h"]) == pd.to_datetime(want["h"])).all()
    iso = sdf.selectExpr("weekofyear(a) AS wk").toPandas()["wk"].tolist()
    assert iso == [d.isocalendar()[1] for d in pdf["a"]]
