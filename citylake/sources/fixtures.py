"""Reference-shaped inputs derived from the driver tables (FIXTURES.md 2-5).

No trip data ships with the reference, so the bronze inputs are derived with integer
arithmetic from ``events``, ``nation``/``region`` and ``lineitem``/``orders``. Every
derivation is a narrow projection (no shuffle) except the lineitem-orders join, and
each grows with its source table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.sources.schemas import RAW_TRIPS_SCHEMA, RAW_WEATHER_SCHEMA

BASE_LOADED_AT = "2024-02-01 00:00:00"
SOURCE_FILES = ("events.parquet", "events_resend.parquet")


# Declared schemas of the driver tables this package reads, so a scan does not
# start with a footer-reading job to infer them.
DRIVER_SCHEMAS = {
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "region": "r_regionkey INT, r_name STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = DRIVER_SCHEMAS.get(name)
    return (spark.read.schema(schema) if schema else spark.read).parquet(path)


# ---------------------------------------------------------------- Fixture E: trips

def trips_from_events(events: DataFrame) -> DataFrame:
    """Bronze trip rows: every event once (b = 0) plus a re-sent copy (b = 1, one hour
    later, fare + 1) of every event with ``event_id % 10 = 0``.

    The copy is produced by exploding ``[0]`` or ``[0, 1]`` per row, so the events
    table is scanned once. The projection is one SQL select list (parsed in the
    JVM in one call).
    """
    ev = events.selectExpr(
        "event_id", "user_id", "ts", "value",
        "explode(sequence(0, CASE WHEN event_id % 10 = 0 THEN 1 ELSE 0 END)) AS b",
    )
    values = {
        "VENDORID": "user_id % 4",
        "TPEP_PICKUP_DATETIME": "CAST(ts AS TIMESTAMP_NTZ)",
        "TPEP_DROPOFF_DATETIME": "timestampadd(MINUTE, CAST((event_id * 7) % 200 - 5 AS INT), CAST(ts AS TIMESTAMP_NTZ))",
        "PASSENGER_COUNT": "event_id % 5",
        "TRIP_DISTANCE": "value",
        "RATECODEID": "event_id % 6 + 1",
        "STORE_AND_FWD_FLAG": "'N'",
        "PULOCATIONID": "user_id % 27",
        "DOLOCATIONID": "event_id % 27",
        "PAYMENT_TYPE": "event_id % 7 + 1",
        "FARE_AMOUNT": "CASE WHEN event_id % 6 + 1 = 2 AND event_id % 4 <> 1 THEN 70.0D "
        "ELSE CAST((user_id * 37 + event_id * 13) % 6000 AS DOUBLE) / 10 - 20 END + CAST(b AS DOUBLE)",
        "SOURCE_FILE": f"CASE WHEN b = 0 THEN '{SOURCE_FILES[0]}' ELSE '{SOURCE_FILES[1]}' END",
        "LOADED_AT": f"timestampadd(HOUR, b, TIMESTAMP_NTZ '{BASE_LOADED_AT}')",
    }
    return ev.selectExpr(
        *[f"CAST({values.get(f.name, 'NULL')} AS {f.dataType.simpleString()}) AS {f.name}" for f in RAW_TRIPS_SCHEMA.fields]
    )


# ---------------------------------------------------------------- Fixture W: hourly weather

# Weather code of hour i is WEATHER_CODE_CYCLE[i % 13].
WEATHER_CODE_CYCLE = [0, 1, 2, 3, 45, 51, 61, 63, 71, 80, 85, 95, 10]
WEATHER_SOURCE_URL = "file:weather/hourly.json"


def weather_from_events(events: DataFrame) -> DataFrame:
    """Bronze hourly weather over the hours the events span, with gaps.

    Hour i counts from the first event's hour; hours with ``i % 48 = 17`` are
    missing. The spine is generated from the one-row min/max aggregate by
    ``sequence`` + ``explode``: its size is the covered period in hours, not the
    number of events.
    """
    cycle = ", ".join(str(c) for c in WEATHER_CODE_CYCLE)
    hours = events.selectExpr(
        "CAST(date_trunc('hour', min(ts)) AS TIMESTAMP_NTZ) AS h0",
        "CAST(date_trunc('hour', max(ts)) AS TIMESTAMP_NTZ) AS h1",
    ).selectExpr("h0", "explode(sequence(h0, h1, INTERVAL 1 HOUR)) AS t")
    idx = hours.selectExpr(
        "t", "CAST((unix_micros(CAST(t AS TIMESTAMP)) - unix_micros(CAST(h0 AS TIMESTAMP))) / 3600000000 AS BIGINT) AS i"
    ).where("i % 48 != 17").selectExpr("t", "i", f"CAST(element_at(array({cycle}), CAST(i % 13 + 1 AS INT)) AS BIGINT) AS code")
    values = {
        "TIME": "date_format(t, \"yyyy-MM-dd'T'HH:mm\")",
        "TEMPERATURE_2M": "i % 40 - 10",
        "PRECIPITATION": "CASE WHEN code BETWEEN 51 AND 67 OR code BETWEEN 80 AND 82 THEN 0.5D ELSE 0.0D END",
        "SNOWFALL": "CASE WHEN code BETWEEN 71 AND 77 OR code IN (85, 86) THEN 0.3D ELSE 0.0D END",
        "WINDSPEED_10M": "i % 25",
        "WEATHERCODE": "code",
        "SOURCE_URL": f"'{WEATHER_SOURCE_URL}'",
        "LOADED_AT": f"'{BASE_LOADED_AT}'",
    }
    return idx.selectExpr(
        *[f"CAST({values[f.name]} AS {f.dataType.simpleString()}) AS {f.name}" for f in RAW_WEATHER_SCHEMA.fields]
    )


# ---------------------------------------------------------------- Fixture Z: zones

ZONE_SOURCE_URL = "file:zones/taxi_zone_lookup.csv"
FIXTURE_CORE_BOROUGH = "AMERICA"


def zones_from_nations(nation: DataFrame, region: DataFrame) -> DataFrame:
    """Bronze zone rows: one per nation; borough = region name (null for key 24),
    zone = nation name (+ ' Airport' when key % 8 = 0), service zone null."""
    n = nation.select("n_nationkey", "n_name", "n_regionkey")
    r = region.select("r_regionkey", "r_name")
    j = n.join(r, n.n_regionkey == r.r_regionkey, "left")
    return j.selectExpr(
        "CAST(n_nationkey AS INT) AS LOCATIONID",
        "CASE WHEN n_nationkey = 24 THEN CAST(NULL AS STRING) ELSE r_name END AS BOROUGH",
        "CASE WHEN n_nationkey % 8 = 0 THEN concat(n_name, ' Airport') ELSE n_name END AS ZONE",
        "CAST(NULL AS STRING) AS SERVICE_ZONE",
        f"'{ZONE_SOURCE_URL}' AS SOURCE_URL",
        f"'{BASE_LOADED_AT}' AS LOADED_AT",
    )


# ---------------------------------------------------------------- Fixture L: day-grain rows

L_CALENDAR_START = "1995-01-01"
L_CALENDAR_DAYS = 2600


def lineitem_rows(lineitem: DataFrame) -> DataFrame:
    """The lineitem columns fixture L uses."""
    return lineitem.select(
        "l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"
    )


def latest_lineitem(lineitem: DataFrame, orders: DataFrame) -> DataFrame:
    """Fixture L: the latest copy per (order, line) -- newest ship date, then lowest
    part, supplier and price -- with its order date.

    The dedup runs first and keeps one row per key and task before its shuffle; the order
    join follows without a hint, so Spark chooses it by size and splits skewed partitions.
    """
    from citylake.operators.dedup import ASC_NULLS_LAST, DESC_NULLS_LAST, latest_per_key

    order = [
        ("l_shipdate", DESC_NULLS_LAST),
        ("l_partkey", ASC_NULLS_LAST),
        ("l_suppkey", ASC_NULLS_LAST),
        ("l_extendedprice", ASC_NULLS_LAST),
    ]
    latest = latest_per_key(lineitem_rows(lineitem), ["l_orderkey", "l_linenumber"], order)
    o = orders.select(F.col("o_orderkey"), F.col("o_orderdate"))
    return latest.join(o, latest["l_orderkey"] == o["o_orderkey"], "inner").drop("o_orderkey")


def time_ordered(l_latest: DataFrame) -> DataFrame:
    """Fixture L quality filter (after dedup): shipped after it was ordered."""
    return l_latest.where(F.col("l_shipdate") > F.col("o_orderdate"))


def lineitem_as_trips(l_rows: DataFrame) -> DataFrame:
    """Fixture L read as day-grain trips: vendor = supplier % 4, distance = quantity,
    fare = extended price, pickup = ship date."""
    return l_rows.select(
        (F.col("l_suppkey") % 4).cast("int").alias("vendor_id"),
        F.col("l_quantity").cast("double").alias("trip_distance"),
        F.col("l_extendedprice").cast("double").alias("fare_amount"),
        F.col("l_shipdate").cast("timestamp_ntz").alias("pickup_datetime"),
    )
