"""DuckDB SQL equivalents of the registered queries (the correctness oracle).

Each query is self-contained SQL over the driver's views (events, nation, region,
lineitem, orders). Shared steps are CTEs; DuckDB skips CTEs a query does not use.
The trip models are written from the business rules in a form of their own: one select per
model, calendar attributes and emission factors computed instead of joined.
"""

from __future__ import annotations

RUN_TS = "TIMESTAMP '2024-03-01 00:00:00'"

# Fixed values of the reference's rules (weather classes, holidays, seeds, the
# thresholds 100 / 500 / 180 / 406 / 70 / 0.5 / 1.5) appear below as SQL literals;
# they are the same values as in citylake (functions/columns.py, sources/seeds.py,
# config.Rules).
CATEGORY = """CASE
    WHEN {c} IN (0, 1, 2, 3) THEN 'Clear'
    WHEN {c} IN (45, 48) THEN 'Fog'
    WHEN {c} BETWEEN 51 AND 67 THEN 'Rain'
    WHEN {c} BETWEEN 71 AND 77 THEN 'Snow'
    WHEN {c} BETWEEN 80 AND 82 THEN 'Showers'
    WHEN {c} IN (85, 86) THEN 'Snow Showers'
    WHEN {c} >= 95 THEN 'Thunderstorm'
    ELSE 'Unknown' END"""


def _repair(c: str) -> str:
    e = f"CAST(floor(epoch({c})) AS BIGINT)"
    return (f"CASE WHEN abs(epoch({c})) > 1e14 THEN make_timestamp({e}) "
            f"WHEN abs(epoch({c})) > 1e11 THEN make_timestamp({e} * 1000) ELSE {c} END")


def _ms(c: str) -> str:
    return f"strftime({c}, '%Y-%m-%d %H:%M:%S.%g')"


def _datekey(c: str) -> str:
    return f"CAST(year({c}) * 10000 + month({c}) * 100 + day({c}) AS INTEGER)"


_NULL_MONEY = ",\n    ".join(
    f"CAST(NULL AS DOUBLE) AS {c}"
    for c in (
        "EXTRA", "MTA_TAX", "TIP_AMOUNT", "TOLLS_AMOUNT", "IMPROVEMENT_SURCHARGE",
        "TOTAL_AMOUNT", "CONGESTION_SURCHARGE", "AIRPORT_FEE",
    )
)

CTES: dict[str, str] = {}

CTES["raw_trips"] = f"""
SELECT
    CAST(user_id % 4 AS INTEGER) AS VENDORID,
    ts AS TPEP_PICKUP_DATETIME,
    ts + to_minutes(CAST((event_id * 7) % 200 - 5 AS BIGINT)) AS TPEP_DROPOFF_DATETIME,
    CAST(event_id % 5 AS DOUBLE) AS PASSENGER_COUNT,
    CAST(value AS DOUBLE) AS TRIP_DISTANCE,
    CAST(event_id % 6 + 1 AS DOUBLE) AS RATECODEID,
    'N' AS STORE_AND_FWD_FLAG,
    CAST(user_id % 27 AS INTEGER) AS PULOCATIONID,
    CAST(event_id % 27 AS INTEGER) AS DOLOCATIONID,
    CAST(event_id % 7 + 1 AS INTEGER) AS PAYMENT_TYPE,
    CASE WHEN event_id % 6 + 1 = 2 AND event_id % 4 <> 1 THEN CAST(70 AS DOUBLE)
         ELSE CAST((user_id * 37 + event_id * 13) % 6000 AS DOUBLE) / 10 - 20 END
      + CAST(b AS DOUBLE) AS FARE_AMOUNT,
    {_NULL_MONEY},
    CASE WHEN b = 0 THEN 'events.parquet' ELSE 'events_resend.parquet' END AS SOURCE_FILE,
    TIMESTAMP '2024-02-01 00:00:00' + to_hours(CAST(b AS BIGINT)) AS LOADED_AT
FROM (SELECT *, 0 AS b FROM events UNION ALL SELECT *, 1 AS b FROM events WHERE event_id % 10 = 0) e"""

# G1: the newest copy per (vendor, pickup, zone), straight from the raw rows. Every other
# column, in reverse, breaks ties.
_LATER = "loaded_at DESC NULLS FIRST, " + ", ".join(
    f"{c} DESC NULLS LAST"
    for c in (
        "source_file", "dropoff_datetime", "passenger_count", "trip_distance", "dropoff_location_id",
        "rate_code_id", "payment_type_id", "fare_amount",
    )
)
_WHOLE = {
    "vendor_id": "VENDORID", "passenger_count": "PASSENGER_COUNT", "pickup_location_id": "PULOCATIONID",
    "dropoff_location_id": "DOLOCATIONID", "rate_code_id": "RATECODEID", "payment_type_id": "PAYMENT_TYPE",
}
CTES["newest_trip"] = f"""
SELECT {", ".join(f"round({c})::INTEGER AS {n}" for n, c in _WHOLE.items())},
    {_repair('TPEP_PICKUP_DATETIME')} AS pickup_datetime, {_repair('TPEP_DROPOFF_DATETIME')} AS dropoff_datetime,
    TRIP_DISTANCE::DOUBLE AS trip_distance, FARE_AMOUNT::DOUBLE AS fare_amount,
    SOURCE_FILE AS source_file, LOADED_AT AS loaded_at, 1::INTEGER AS row_num
FROM raw_trips
QUALIFY row_number() OVER (PARTITION BY vendor_id, pickup_datetime, pickup_location_id ORDER BY {_LATER}) = 1"""

# I1 in one select: D1's rules as one bounds check, features by lateral aliases.
CTES["stg_trips"] = f"""
SELECT md5(concat(vendor_id, '-', {_ms('pickup_datetime')}, '-', pickup_location_id)) AS trip_id, t.*,
    date_diff('minute', pickup_datetime, dropoff_datetime) AS trip_duration_minutes,
    hour(pickup_datetime)::INTEGER AS pickup_hour, dayofweek(pickup_datetime)::INTEGER AS pickup_day_of_week,
    date_trunc('hour', pickup_datetime) AS pickup_hour_truncated, {RUN_TS} AS dbt_updated_at,
    (CASE vendor_id WHEN 1 THEN 400 WHEN 2 THEN 411 ELSE 406 END)::DOUBLE AS emission_factor,
    trip_distance * emission_factor AS co2_emission_grams,
    coalesce(trip_distance > 100, false) AS is_distance_anomaly, coalesce(fare_amount > 500, false) AS is_fare_anomaly
FROM newest_trip t
WHERE least(fare_amount, trip_distance, passenger_count) > 0
  AND fare_amount IS NOT NULL AND trip_distance IS NOT NULL AND passenger_count IS NOT NULL
  AND dropoff_datetime > pickup_datetime
  AND NOT date_diff('minute', pickup_datetime, dropoff_datetime) > 180"""

CTES["w_bounds"] = "SELECT date_trunc('hour', min(ts)) AS h0, date_trunc('hour', max(ts)) AS h1 FROM events"
CTES["w_hours"] = "SELECT h0, unnest(generate_series(h0, h1, INTERVAL 1 HOUR)) AS t FROM w_bounds"
CTES["w_idx"] = """
SELECT t, i, CAST(list_extract([0, 1, 2, 3, 45, 51, 61, 63, 71, 80, 85, 95, 10], CAST(i % 13 + 1 AS INTEGER)) AS BIGINT) AS code
FROM (SELECT t, CAST((epoch_us(t) - epoch_us(h0)) // 3600000000 AS BIGINT) AS i FROM w_hours)
WHERE i % 48 <> 17"""
CTES["raw_weather"] = """
SELECT
    strftime(t, '%Y-%m-%dT%H:%M') AS TIME,
    CAST(i % 40 - 10 AS DOUBLE) AS TEMPERATURE_2M,
    CAST(CASE WHEN code BETWEEN 51 AND 67 OR code BETWEEN 80 AND 82 THEN 0.5 ELSE 0.0 END AS DOUBLE) AS PRECIPITATION,
    CAST(CASE WHEN code BETWEEN 71 AND 77 OR code IN (85, 86) THEN 0.3 ELSE 0.0 END AS DOUBLE) AS SNOWFALL,
    CAST(i % 25 AS DOUBLE) AS WINDSPEED_10M,
    code AS WEATHERCODE,
    'file:weather/hourly.json' AS SOURCE_URL,
    '2024-02-01 00:00:00' AS LOADED_AT
FROM w_idx"""

CTES["stg_weather"] = f"""
SELECT *,
    {CATEGORY.format(c='weather_code')} AS weather_category,
    CASE WHEN precipitation > 0 OR snowfall > 0 THEN TRUE ELSE FALSE END AS is_precipitation,
    {RUN_TS} AS dbt_updated_at
FROM (
  SELECT CAST(TIME AS TIMESTAMP) AS weather_time,
      CAST(TEMPERATURE_2M AS DOUBLE) AS temperature_2m,
      CAST(PRECIPITATION AS DOUBLE) AS precipitation,
      CAST(SNOWFALL AS DOUBLE) AS snowfall,
      CAST(WINDSPEED_10M AS DOUBLE) AS windspeed_10m,
      CAST(round(WEATHERCODE) AS INTEGER) AS weather_code,
      SOURCE_URL AS source_url,
      LOADED_AT AS loaded_at
  FROM raw_weather)"""

CTES["raw_zones"] = """
SELECT CAST(n.n_nationkey AS INTEGER) AS LOCATIONID,
    CASE WHEN n.n_nationkey = 24 THEN NULL ELSE r.r_name END AS BOROUGH,
    CASE WHEN n.n_nationkey % 8 = 0 THEN n.n_name || ' Airport' ELSE n.n_name END AS ZONE,
    CAST(NULL AS VARCHAR) AS SERVICE_ZONE,
    'file:zones/taxi_zone_lookup.csv' AS SOURCE_URL,
    '2024-02-01 00:00:00' AS LOADED_AT
FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey"""

CTES["stg_zones"] = f"""
SELECT CAST(round(LOCATIONID) AS INTEGER) AS location_id,
    COALESCE(BOROUGH, 'Unknown') AS borough,
    COALESCE(ZONE, 'Unknown') AS zone,
    COALESCE(SERVICE_ZONE, 'Unknown') AS service_zone,
    SOURCE_URL AS source_file,
    LOADED_AT AS loaded_at_bronze,
    {RUN_TS} AS dbt_updated_at
FROM raw_zones"""

CTES["dim_zones"] = f"""
SELECT COLUMNS('^(location_id|borough|zone|service_zone)$'), contains(lower(zone), 'airport') AS is_airport,
    coalesce(map(['AMERICA', 'Unknown'], ['Core', 'Unknown'])[borough], 'Outer Boroughs') AS borough_group, {RUN_TS} AS dbt_updated_at
FROM stg_zones"""


# The holidays by month and day.
_HOLIDAYS = {101: "New Years Day", 704: "Independence Day", 1111: "Veterans Day", 1225: "Christmas Day"}


def _calendar_sql(start: str, days: int) -> str:
    """A row per day, from the day's key alone: months and days are its digits, the week's days count from Sunday."""
    names = f"map([{', '.join(map(str, _HOLIDAYS))}], [{', '.join(repr(v) for v in _HOLIDAYS.values())}])"
    return f"""
SELECT key AS date_id, d AS date_day, key // 10000 AS year, key // 100 % 100 AS month, key % 100 AS day_of_month,
    (key // 100 % 100 + 2) // 3 AS quarter, strftime(d, '%V')::INTEGER AS week_of_year,
    strftime(d, '%b') AS month_name, strftime(d, '%a') AS day_name,
    (isodow(d) % 7)::INTEGER AS day_of_week, isodow(d) % 7 % 6 = 0 AS is_weekend,
    {names}[key % 10000] AS holiday_name, key % 10000 IN ({', '.join(map(str, _HOLIDAYS))}) AS is_holiday, {RUN_TS} AS dbt_updated_at
FROM (SELECT t::DATE AS d, strftime(t, '%Y%m%d')::INTEGER AS key
      FROM generate_series(TIMESTAMP '{start}', TIMESTAMP '{start}' + INTERVAL {days - 1} DAY, INTERVAL 1 DAY) days(t))"""


CTES["calendar"] = _calendar_sql("2023-01-01", 3650)

# I10 without a calendar: the day's attributes follow from the date itself.
_HOLIDAY = f"map([{', '.join(map(str, _HOLIDAYS))}], [{', '.join(repr(v) for v in _HOLIDAYS.values())}])[pickup_date_id % 10000]"


def _fact(extra: str = "") -> str:
    return f"""
SELECT t.*, {_datekey('t.pickup_datetime')} AS pickup_date_id,
    w.temperature_2m, w.is_precipitation, w.weather_category{extra}, z.borough AS pickup_borough, z.zone AS pickup_zone,
    {_HOLIDAY} AS holiday_name, holiday_name IS NOT NULL AS is_holiday,
    t.pickup_day_of_week % 6 = 0 AS is_weekend, {RUN_TS} AS last_updated_at
FROM stg_trips t
LEFT JOIN stg_weather w ON w.weather_time = t.pickup_hour_truncated
LEFT JOIN stg_zones z ON z.location_id = t.pickup_location_id"""


CTES["fact_trips"] = _fact()
CTES["fact_trips_code"] = _fact(", w.weather_code")

CTES["financials"] = f"""
SELECT trip_id, vendor_id, {_datekey('pickup_datetime')} AS pickup_date_id, rate_code_id, payment_type_id, fare_amount,
    if(rate_code_id = 2, 70::DOUBLE, fare_amount) AS expected_fare, fare_amount - expected_fare AS fare_variance,
    coalesce(rate_code_id BETWEEN 2 AND 3, false) AS is_airport_trip,
    coalesce(rate_code_id = 2 AND fare_variance NOT BETWEEN -0.5 AND 0.5, false) AS is_price_anomaly,
    {RUN_TS} AS dbt_updated_at
FROM stg_trips"""

CTES["sustainability"] = f"""
SELECT trip_id, vendor_id, pickup_location_id, dropoff_location_id, rate_code_id, passenger_count, trip_distance,
    {_datekey('pickup_datetime')} AS pickup_date_id, co2_emission_grams, co2_emission_grams / 1000::DOUBLE AS co2_emission_kg,
    if(trip_distance * passenger_count = 0, NULL, co2_emission_grams / (trip_distance * passenger_count)) AS co2_per_passenger_mile,
    coalesce(trip_distance < 1.5, false) AS is_short_efficiency_risk, {RUN_TS} AS dbt_updated_at
FROM stg_trips WHERE NOT (is_distance_anomaly OR is_fare_anomaly)"""

_KEY_PARTS = [_ms("pickup_hour_truncated"), "pickup_borough", "weather_category"]


def _mean(total: str, column: str) -> str:
    return f"{total} / nullif(count({column}), 0)"


CTES["agg_demand"] = f"""
SELECT pickup_hour_truncated, pickup_day_of_week, pickup_borough, weather_category, is_precipitation,
    md5({" || '-' || ".join(f"coalesce({c}, '_null_')" for c in _KEY_PARTS)}) AS agg_id,
    count() AS total_trips, sum(passenger_count)::BIGINT AS total_passengers,
    round(sum(fare_amount), 2) AS total_revenue, round(sum(co2_emission_grams), 2) AS total_co2_grams,
    {_mean('total_co2_grams', 'co2_emission_grams')} AS avg_co2_grams_per_trip,
    {_mean('total_revenue', 'fare_amount')} AS avg_fare_amount, avg(trip_duration_minutes) AS avg_trip_duration_minutes,
    {_mean('round(sum(trip_distance), 2)', 'trip_distance')} AS avg_trip_distance, {RUN_TS} AS last_aggregated_at
FROM fact_trips WHERE NOT (is_distance_anomaly OR is_fare_anomaly)
GROUP BY ALL"""

CTES["dim_weather_lookup"] = f"""
SELECT weather_code, {CATEGORY.format(c='weather_code')} AS weather_category
FROM (SELECT DISTINCT weather_code FROM stg_weather)"""

CTES["seed_vendors"] = f"""SELECT CAST(v AS INTEGER) AS vendor_id, n AS vendor_name, {RUN_TS} AS dbt_updated_at
FROM (VALUES (1, 'Creative Mobile Technologies'), (2, 'VeriFone Inc.')) t(v, n)"""
CTES["seed_rate_codes"] = f"""SELECT CAST(v AS INTEGER) AS rate_code_id, n AS rate_code_name, {RUN_TS} AS dbt_updated_at
FROM (VALUES (1, 'Standard'), (2, 'JFK'), (3, 'Newark'), (4, 'Nassau or Westchester'), (5, 'Negotiated'),
             (6, 'Group ride')) t(v, n)"""
CTES["seed_payment_types"] = f"""SELECT CAST(v AS INTEGER) AS payment_type_id, n AS payment_type_name, {RUN_TS} AS dbt_updated_at
FROM (VALUES (1, 'Credit Card'), (2, 'Cash'), (3, 'No charge'), (4, 'Dispute'), (5, 'Unknown'),
             (6, 'Voided trip')) t(v, n)"""

# Fixture L: the newest copy per (order, line), with its order date.
CTES["l_latest"] = """
SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate, o_orderdate
FROM lineitem JOIN orders ON o_orderkey = l_orderkey
QUALIFY row_number() OVER (PARTITION BY l_orderkey, l_linenumber
    ORDER BY l_shipdate DESC NULLS LAST, l_partkey NULLS LAST, l_suppkey NULLS LAST, l_extendedprice NULLS LAST,
             l_quantity DESC NULLS LAST) = 1"""
CTES["l_clean"] = "SELECT * FROM l_latest WHERE l_shipdate > o_orderdate"
CTES["l_calendar"] = _calendar_sql("1995-01-01", 2600)


def _with(sql: str) -> str:
    """Prefix every CTE the statement (transitively) mentions, in definition order."""
    import re

    names = list(CTES)
    needed: set[str] = set()
    frontier = [sql]
    while frontier:
        text = frontier.pop()
        for n in names:
            if n not in needed and re.search(rf"\b{n}\b", text):
                needed.add(n)
                frontier.append(CTES[n])
    ordered = [n for n in names if n in needed]
    if not ordered:
        return sql
    return "WITH " + ",\n".join(f"{n} AS ({CTES[n]})" for n in ordered) + "\n" + sql


STG_COLS = """trip_id, vendor_id, pickup_datetime, dropoff_datetime, passenger_count, trip_distance,
    pickup_location_id, dropoff_location_id, rate_code_id, payment_type_id, fare_amount, source_file, loaded_at,
    row_num, trip_duration_minutes, pickup_hour, pickup_day_of_week, pickup_hour_truncated, dbt_updated_at,
    emission_factor, co2_emission_grams, is_distance_anomaly, is_fare_anomaly"""

_Q: dict[str, str] = {
    "a1_raw_trips": "SELECT * FROM raw_trips",
    "g1_latest_per_trip": "SELECT * FROM newest_trip",
    "i1_stg_taxi_trips": f"SELECT {STG_COLS} FROM stg_trips",
    "i2_stg_weather_hourly": "SELECT * FROM stg_weather",
    "i3_stg_zone_lookup": "SELECT * FROM stg_zones",
    "i5_dim_zones": "SELECT * FROM dim_zones",
    "i9_dim_weather_lookup": "SELECT * FROM dim_weather_lookup",
    "i10_fact_trips": "SELECT * FROM fact_trips",
    "i11_fact_financials": "SELECT * FROM financials",
    "i12_fact_sustainability": "SELECT * FROM sustainability",
    "i13_agg_demand_weather": "SELECT * FROM agg_demand",
    "e5_fact_trips_labeled": """
SELECT f.*, v.vendor_name, r.rate_code_name, p.payment_type_name,
    zp.is_airport AS pickup_is_airport, zp.borough_group AS pickup_borough_group,
    zd.borough AS dropoff_borough, zd.zone AS dropoff_zone,
    wl.weather_category AS weather_code_category
FROM fact_trips_code f
LEFT JOIN seed_vendors v ON f.vendor_id = v.vendor_id
LEFT JOIN seed_rate_codes r ON f.rate_code_id = r.rate_code_id
LEFT JOIN seed_payment_types p ON f.payment_type_id = p.payment_type_id
LEFT JOIN dim_zones zp ON f.pickup_location_id = zp.location_id
LEFT JOIN dim_zones zd ON f.dropoff_location_id = zd.location_id
LEFT JOIN dim_weather_lookup wl ON f.weather_code = wl.weather_code""",
    "f3_trip_profile": """
SELECT COUNT(*) AS total_rows,
    COUNT(*) - COUNT(VENDORID) AS null_vendors,
    COUNT(*) - COUNT(TPEP_PICKUP_DATETIME) AS null_pickups,
    COUNT(*) - COUNT(PULOCATIONID) AS null_pickup_locations,
    CAST(SUM(CASE WHEN FARE_AMOUNT <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_or_neg_fare,
    CAST(SUM(CASE WHEN TRIP_DISTANCE <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_or_neg_distance,
    CAST(SUM(CASE WHEN PASSENGER_COUNT <= 0 THEN 1 ELSE 0 END) AS BIGINT) AS zero_passengers,
    MIN(TPEP_PICKUP_DATETIME) AS min_date,
    MAX(TPEP_PICKUP_DATETIME) AS max_date
FROM raw_trips""",
    "f4_duplicate_candidates": """
SELECT COUNT(*) - COUNT(DISTINCT CASE WHEN VENDORID IS NOT NULL AND TPEP_PICKUP_DATETIME IS NOT NULL
                                          AND PULOCATIONID IS NOT NULL
                                     THEN (VENDORID, TPEP_PICKUP_DATETIME, PULOCATIONID) END)
       AS duplicate_candidate_count
FROM raw_trips""",
    "f4_duplicate_candidates_concat": f"""
SELECT COUNT(*) - COUNT(DISTINCT CAST(VENDORID AS VARCHAR) || {_ms('TPEP_PICKUP_DATETIME')}
                               || CAST(PULOCATIONID AS VARCHAR)) AS duplicate_candidate_count
FROM raw_trips""",
    "f5_duplicate_trip_keys": """
SELECT VENDORID, TPEP_PICKUP_DATETIME, PULOCATIONID, COUNT(*) AS copies
FROM raw_trips GROUP BY VENDORID, TPEP_PICKUP_DATETIME, PULOCATIONID HAVING COUNT(*) > 1""",
    "f5_duplicate_weather_hours": """
SELECT TIME, COUNT(*) AS copies FROM raw_weather GROUP BY TIME HAVING COUNT(*) > 1""",
    "f5_duplicate_event_users": "SELECT user_id, count() AS copies FROM events GROUP BY ALL HAVING copies > 1",
    "b5_upsert_resent": f"""
SELECT unnest(CASE WHEN any_sent THEN list_filter(rows_, lambda r: r.source_file = 'events_resend.parquet') ELSE rows_ END, recursive := true)
FROM (
  SELECT bool_or(SOURCE_FILE = 'events_resend.parquet') AS any_sent,
      list({{'trip_id': md5(concat(VENDORID, '-', {_ms('TPEP_PICKUP_DATETIME')}, '-', PULOCATIONID)), 'fare_amount': FARE_AMOUNT,
            'source_file': SOURCE_FILE, 'loaded_at': LOADED_AT, 'pickup': TPEP_PICKUP_DATETIME}}) AS rows_
  FROM raw_trips GROUP BY VENDORID, TPEP_PICKUP_DATETIME, PULOCATIONID)""",
    "b1_ledger_loads": """
SELECT CASE b WHEN 0 THEN 'first' ELSE 'second' END AS "load", count() AS "rows", count() FILTER (event_id >= 0) AS timed
FROM (SELECT event_id, unnest(range(CASE WHEN event_id % 10 = 0 THEN 2 ELSE 1 END)) AS b FROM events) GROUP BY ALL""",
    "b6_full_refresh": f"""
SELECT md5(concat(VENDORID, '-', {_ms('TPEP_PICKUP_DATETIME')}, '-', PULOCATIONID)) AS trip_id, FARE_AMOUNT AS fare_amount,
    SOURCE_FILE AS source_file, LOADED_AT AS loaded_at, TPEP_PICKUP_DATETIME AS pickup
FROM raw_trips WHERE SOURCE_FILE = 'events_resend.parquet'""",
    "b7_schema_drift": """
SELECT unnest(['added', 'missing', 'none', 'retyped']) AS drift, unnest([true, true, false, true]) AS stopped, n AS rows_after
FROM (SELECT count() AS n FROM stg_zones)""",
    "b9_load_count": "SELECT count() AS rows_reported, count() AS rows_written FROM events",
    "c5_iso_text": "SELECT event_id, strftime(date_trunc('minute', ts), '%Y-%m-%d %H:%M:%S') AS iso_text FROM events",
    "j6_gate_failures": """
SELECT * FROM (
  SELECT 'raw trip key unique' AS "check", count() AS failures FROM (
    SELECT 1 FROM raw_trips GROUP BY VENDORID, TPEP_PICKUP_DATETIME, PULOCATIONID HAVING count() > 1)
  UNION ALL SELECT 'raw zones not null', count() FROM raw_zones WHERE BOROUGH IS NULL OR SERVICE_ZONE IS NULL
  UNION ALL SELECT 'weather category accepted', count() FROM stg_weather WHERE weather_category = 'Unknown')
WHERE failures > 0""",
    "a1_read_trip_files": "SELECT * EXCLUDE (SOURCE_FILE) REPLACE (TIMESTAMP '2024-02-01' AS LOADED_AT) FROM raw_trips",
    "a2_read_weather_json": "SELECT * FROM raw_weather",
    "a3_read_zone_csv": "SELECT * FROM raw_zones",
    "c4_repaired_epochs": """
SELECT event_id, (1700000000 + event_id) * [1, 1000, 1000000][event_id % 3 + 1] AS epoch,
    make_timestamp((1700000000 + event_id) * 1000000) AS repaired_ts
FROM events""",
    "i4_calendar_demand": """
SELECT year, quarter, month, month_name, day_of_month, day_of_week, day_name, week_of_year, is_weekend, is_holiday, holiday_name,
    count(*) AS events, count(value) AS valued
FROM (SELECT value, strftime(ts, '%Y%m%d')::INTEGER AS day FROM events) LEFT JOIN calendar ON date_id = day
GROUP BY ALL""",
    "d3_zone_null_rows": "SELECT * FROM raw_zones WHERE BOROUGH IS NULL OR SERVICE_ZONE IS NULL",
    "j1_unique_raw_trip_key": f"""
SELECT md5(concat(VENDORID, '-', {_ms('TPEP_PICKUP_DATETIME')}, '-', PULOCATIONID)) AS trip_id, count() AS copies
FROM raw_trips GROUP BY ALL HAVING copies > 1""",
    "j2_not_null_raw_zones": """
SELECT LOCATIONID, BOROUGH IS NULL AS BOROUGH_is_null, SERVICE_ZONE IS NULL AS SERVICE_ZONE_is_null
FROM raw_zones WHERE BOROUGH_is_null OR SERVICE_ZONE_is_null""",
    "j3_accepted_without_unknown": "SELECT weather_time, weather_category FROM stg_weather WHERE weather_category = 'Unknown'",
    "j4_raw_to_staged_grain": """
SELECT a AS expected_rows, b AS actual_rows FROM (SELECT count() AS a FROM raw_trips), (SELECT count() AS b FROM stg_trips) WHERE a <> b""",
    "f7_raw_trip_count": "SELECT COUNT(*) AS row_count FROM raw_trips",
    "h2_repaired_pickup_preview": f"""
SELECT {_repair('TPEP_PICKUP_DATETIME')} AS pickup_datetime FROM raw_trips
ORDER BY pickup_datetime ASC NULLS LAST LIMIT 100""",
    "j1_unique_location_id": """
SELECT location_id, COUNT(*) AS copies FROM stg_zones WHERE location_id IS NOT NULL
GROUP BY location_id HAVING COUNT(*) > 1""",
    "j2_not_null_agg_columns": """
SELECT agg_id, agg_id IS NULL AS agg_id_is_null, total_trips IS NULL AS total_trips_is_null
FROM agg_demand WHERE agg_id IS NULL OR total_trips IS NULL""",
    "f6_weather_code_histogram": "SELECT WEATHERCODE AS weather_code, COUNT(*) AS hours FROM raw_weather GROUP BY WEATHERCODE",
    "f7_fact_row_count": "SELECT COUNT(*) AS row_count FROM fact_trips",
    "d3_weather_null_rows": """
SELECT * FROM raw_weather WHERE TEMPERATURE_2M IS NULL OR PRECIPITATION IS NULL OR WEATHERCODE IS NULL""",
    "h1_distinct_pickup_sample": """
SELECT DISTINCT TPEP_PICKUP_DATETIME FROM raw_trips ORDER BY TPEP_PICKUP_DATETIME ASC NULLS LAST LIMIT 1000""",
    "h2_trip_preview": f"SELECT {STG_COLS} FROM stg_trips ORDER BY trip_id ASC NULLS LAST LIMIT 100",
    "h3_top_pickup_zones": """
SELECT pickup_location_id, pickup_zone, pickup_borough, COUNT(*) AS pickups
FROM fact_trips GROUP BY pickup_location_id, pickup_zone, pickup_borough
ORDER BY pickups DESC, pickup_location_id ASC NULLS LAST LIMIT 10""",
    "j1_unique_trip_id": """
SELECT trip_id, COUNT(*) AS copies FROM fact_trips WHERE trip_id IS NOT NULL GROUP BY trip_id HAVING COUNT(*) > 1""",
    "j1_unique_agg_id": """
SELECT agg_id, COUNT(*) AS copies FROM agg_demand WHERE agg_id IS NOT NULL GROUP BY agg_id HAVING COUNT(*) > 1""",
    "j1_unique_weather_time": """
SELECT weather_time, COUNT(*) AS copies FROM stg_weather WHERE weather_time IS NOT NULL
GROUP BY weather_time HAVING COUNT(*) > 1""",
    "j2_not_null_trip_columns": """
SELECT trip_id, trip_id IS NULL AS trip_id_is_null, co2_emission_grams IS NULL AS co2_emission_grams_is_null,
    is_distance_anomaly IS NULL AS is_distance_anomaly_is_null, is_fare_anomaly IS NULL AS is_fare_anomaly_is_null
FROM stg_trips
WHERE trip_id IS NULL OR co2_emission_grams IS NULL OR is_distance_anomaly IS NULL OR is_fare_anomaly IS NULL""",
    "j3_accepted_weather_category": """
SELECT weather_time, weather_category FROM stg_weather
WHERE weather_category NOT IN ('Clear', 'Fog', 'Rain', 'Snow', 'Showers', 'Snow Showers', 'Thunderstorm', 'Unknown')""",
    "j4_fact_grain": """
SELECT expected_rows, actual_rows FROM (
  SELECT (SELECT COUNT(*) FROM stg_trips) AS expected_rows, (SELECT COUNT(*) FROM fact_trips) AS actual_rows)
WHERE expected_rows <> actual_rows""",
    "j5_weather_gaps": """
SELECT h AS missing_hour FROM (
  SELECT unnest(generate_series(min(date_trunc('hour', weather_time)), max(date_trunc('hour', weather_time)),
                                INTERVAL 1 HOUR)) AS h
  FROM stg_weather)
WHERE h NOT IN (SELECT date_trunc('hour', weather_time) FROM stg_weather)""",
    "k1_top_vendor_co2_week": """
SELECT vendor_id, round(SUM(co2_emission_grams), 2) AS total_co2_grams, COUNT(*) AS trips
FROM fact_trips
WHERE pickup_datetime >= TIMESTAMP '2024-01-01 00:00:00' AND pickup_datetime < TIMESTAMP '2024-01-08 00:00:00'
  AND pickup_borough = 'AMERICA' AND payment_type_id = 1
GROUP BY vendor_id ORDER BY total_co2_grams DESC, vendor_id ASC NULLS LAST LIMIT 1""",
    "k2_kpi_tiles": """
SELECT round(SUM(fare_amount), 2) AS total_revenue, round(SUM(co2_emission_grams), 2) AS total_co2_grams,
    COUNT(*) AS trip_count
FROM fact_trips""",
    "k3_pickup_density": """
SELECT pickup_location_id, pickup_zone, pickup_borough, COUNT(*) AS pickups
FROM fact_trips GROUP BY pickup_location_id, pickup_zone, pickup_borough""",
    "k4_weather_impact": """
SELECT weather_category, pickup_borough, trips, hours, trips / hours AS trips_per_hour, revenue / trips AS avg_fare
FROM (
  SELECT weather_category, pickup_borough, CAST(SUM(total_trips) AS BIGINT) AS trips,
      COUNT(DISTINCT pickup_hour_truncated) AS hours, round(SUM(total_revenue), 2) AS revenue
  FROM agg_demand GROUP BY weather_category, pickup_borough)""",
    "k5_co2_by_vendor": """
SELECT vendor_id, trips, total_co2_grams, total_co2_grams / CAST(1000 AS DOUBLE) AS total_co2_kg, total_distance,
    total_co2_grams / NULLIF(total_distance, 0) AS co2_grams_per_mile
FROM (
  SELECT vendor_id, COUNT(*) AS trips, round(SUM(co2_emission_grams), 2) AS total_co2_grams,
      round(SUM(trip_distance), 2) AS total_distance
  FROM sustainability GROUP BY vendor_id)""",
    "k6_price_anomalies": """
SELECT trip_id, vendor_id, pickup_date_id, rate_code_id, payment_type_id, fare_amount, expected_fare, fare_variance
FROM financials WHERE is_price_anomaly""",
    "k7_filtered_kpis": """
SELECT round(SUM(fare_amount), 2) AS total_revenue, round(SUM(co2_emission_grams), 2) AS total_co2_grams,
    COUNT(*) AS trip_count
FROM fact_trips
WHERE pickup_datetime >= TIMESTAMP '2024-01-08 00:00:00' AND pickup_datetime < TIMESTAMP '2024-01-22 00:00:00'
  AND pickup_borough IN ('EUROPE', 'ASIA') AND weather_category IN ('Rain', 'Clear')""",
    "k8_payment_mix": """
SELECT period_start, payment_type_id, trips, trips / SUM(trips) OVER (PARTITION BY period_start) AS share
FROM (
  SELECT CAST(date_trunc('week', pickup_datetime) AS DATE) AS period_start, payment_type_id, COUNT(*) AS trips
  FROM fact_trips GROUP BY 1, 2)""",
    "k9_holiday_demand": """
SELECT is_holiday, trips, days, trips / days AS trips_per_day FROM (
  SELECT is_holiday, COUNT(*) AS trips, COUNT(DISTINCT pickup_date_id) AS days FROM fact_trips GROUP BY is_holiday)""",
    "k10_flat_rate_discovery": """
SELECT rate_code_id, fare_amount AS top_fare, n AS top_fare_trips, trips, n / trips AS top_fare_share FROM (
  SELECT rate_code_id, fare_amount, n, CAST(SUM(n) OVER (PARTITION BY rate_code_id) AS BIGINT) AS trips,
      ROW_NUMBER() OVER (PARTITION BY rate_code_id ORDER BY n DESC, fare_amount ASC) AS rn
  FROM (SELECT rate_code_id, fare_amount, COUNT(*) AS n FROM stg_trips GROUP BY rate_code_id, fare_amount))
WHERE rn = 1""",
    "k11_vendor_risk": """
SELECT vendor_id, COUNT(*) AS error_count, round(SUM(abs(fare_variance)), 2) AS total_abs_variance
FROM financials WHERE is_price_anomaly GROUP BY vendor_id""",
    "k12_short_trip_share": """
SELECT pickup_location_id, pickup_zone, trips, short_trips, short_trips / trips AS short_trip_share FROM (
  SELECT s.pickup_location_id, z.zone AS pickup_zone, COUNT(*) AS trips,
      CAST(SUM(CASE WHEN s.is_short_efficiency_risk THEN 1 ELSE 0 END) AS BIGINT) AS short_trips
  FROM sustainability s LEFT JOIN stg_zones z ON s.pickup_location_id = z.location_id
  GROUP BY s.pickup_location_id, z.zone)""",
    "k13_co2_correlation": """
SELECT COUNT(*) AS hours,
    round(corr(trips, co2_grams), 9) AS corr_trips_co2,
    round(corr(temperature_2m, trips), 9) AS corr_temperature_trips,
    round(corr(temperature_2m, co2_grams), 9) AS corr_temperature_co2,
    round(corr(CAST(precipitation AS DOUBLE), CAST(trips AS DOUBLE)), 9) AS corr_precipitation_trips
FROM (
  SELECT pickup_hour_truncated, COUNT(*) AS trips, round(SUM(co2_emission_grams), 2) AS co2_grams,
      MAX(temperature_2m) AS temperature_2m, MAX(CAST(is_precipitation AS INTEGER)) AS precipitation
  FROM fact_trips GROUP BY pickup_hour_truncated)""",
    # Fixture L (lineitem ⋈ orders, day grain)
    "g1_latest_lineitem": "SELECT * FROM l_latest",
    "d1_lineitem_time_ordered": "SELECT * FROM l_clean",
    "k9_holiday_demand_lineitem": f"""
SELECT is_holiday, trips, days, trips / days AS trips_per_day FROM (
  SELECT c.is_holiday, COUNT(*) AS trips, COUNT(DISTINCT {_datekey('l.l_shipdate')}) AS days
  FROM l_clean l LEFT JOIN l_calendar c ON {_datekey('l.l_shipdate')} = c.date_id
  GROUP BY c.is_holiday)""",
    "k5_co2_by_vendor_lineitem": """
SELECT vendor_id, trips, total_co2_grams, total_co2_grams / CAST(1000 AS DOUBLE) AS total_co2_kg, total_distance,
    total_co2_grams / NULLIF(total_distance, 0) AS co2_grams_per_mile
FROM (
  SELECT vendor_id, COUNT(*) AS trips, round(SUM(co2), 2) AS total_co2_grams, round(SUM(distance), 2) AS total_distance
  FROM (
    SELECT CAST(l_suppkey % 4 AS INTEGER) AS vendor_id, l_quantity AS distance,
        distance * (CASE vendor_id WHEN 1 THEN 400 WHEN 2 THEN 411 ELSE 406 END)::DOUBLE AS co2
    FROM l_clean)
  GROUP BY vendor_id)""",
}


def oracle_sql() -> dict[str, str]:
    # The same merge, whichever table it goes to.
    merged = {k: _Q["b5_upsert_resent"] for k in ("b5_upserted_partitions", "b6_upserted_versions")}
    # The same rows, read by name, through a view, or from gold that two runs have built.
    same = {
        "a6_named_silver_zones": "i3_stg_zone_lookup", "b4_zone_view": "i3_stg_zone_lookup", "i13_incremental_agg_demand": "i13_agg_demand_weather",
        "k4_incremental_weather_impact": "k4_weather_impact", "k9_incremental_holiday_demand": "k9_holiday_demand",
    }
    merged |= {k: _Q[v] for k, v in same.items()}
    return {k: _with(v) for k, v in (_Q | merged).items()}
