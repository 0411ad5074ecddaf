"""Silver models: cleaned trips, hourly weather, zones.

``stg_taxi_trips`` has exactly one shuffle: the latest-per-key aggregate on
(vendor, pickup time, pickup location). The emission-factor lookup is a broadcast
of the seed; every other step is a narrow projection or filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from citylake.config import Rules
from citylake.functions import columns as C
from citylake.operators.dedup import DESC_NULLS_FIRST, DESC_NULLS_LAST, latest_per_key
from citylake.operators.joins import lookup_join

TRIP_KEY = ("vendor_id", "pickup_datetime", "pickup_location_id")
STG_COLUMNS = (
    "trip_id", "vendor_id", "pickup_datetime", "dropoff_datetime", "passenger_count", "trip_distance",
    "pickup_location_id", "dropoff_location_id", "rate_code_id", "payment_type_id", "fare_amount", "source_file",
    "loaded_at", "row_num", "trip_duration_minutes", "pickup_hour", "pickup_day_of_week", "pickup_hour_truncated",
    "dbt_updated_at", "emission_factor", "co2_emission_grams", "is_distance_anomaly", "is_fare_anomaly",
)
# Latest copy first: newest LOADED_AT (a null one counts as newest), then source file;
# the remaining columns break any tie left (see operators.dedup).
TRIP_ORDER = (("loaded_at", DESC_NULLS_FIRST), ("source_file", DESC_NULLS_LAST))


def run_ts(rules: Rules) -> Column:
    if rules.run_ts is None:
        return F.localtimestamp()
    return F.expr(f"TIMESTAMP_NTZ '{rules.run_ts.isoformat(sep=' ')}'")


def cast_trips(raw: DataFrame, rules: Rules) -> DataFrame:
    """Typed trip columns from bronze rows."""
    t = {f.name: f.dataType for f in raw.schema.fields}
    th = rules.epoch_micros_threshold
    return raw.select(
        C.to_int("VENDORID").alias("vendor_id"),
        C.repair_epoch("TPEP_PICKUP_DATETIME", t["TPEP_PICKUP_DATETIME"], th).alias("pickup_datetime"),
        C.repair_epoch("TPEP_DROPOFF_DATETIME", t["TPEP_DROPOFF_DATETIME"], th).alias("dropoff_datetime"),
        C.to_int("PASSENGER_COUNT").alias("passenger_count"),
        C.cast_as("TRIP_DISTANCE", "DOUBLE").alias("trip_distance"),
        C.to_int("PULOCATIONID").alias("pickup_location_id"),
        C.to_int("DOLOCATIONID").alias("dropoff_location_id"),
        C.to_int("RATECODEID").alias("rate_code_id"),
        C.to_int("PAYMENT_TYPE").alias("payment_type_id"),
        C.cast_as("FARE_AMOUNT", "DOUBLE").alias("fare_amount"),
        C.cast_as("SOURCE_FILE", "STRING").alias("source_file"),
        C.cast_as("LOADED_AT", "TIMESTAMP_NTZ").alias("loaded_at"),
    )


def picked_up_between(raw: DataFrame, start: str, end: str, rules: Rules = Rules()) -> DataFrame:
    """Raw rows that can have a pickup in [start, end) after the epoch repair (C4).

    Plain comparisons on the raw column, so they reach the scan: the repair leaves a timestamp
    below the threshold as it is, and a row beyond it is kept for the repair to decide.
    """
    c = F.col("TPEP_PICKUP_DATETIME")
    last = F.lit(int(rules.epoch_micros_threshold)).cast("timestamp").cast("timestamp_ntz")
    first = F.lit(-int(rules.epoch_micros_threshold)).cast("timestamp").cast("timestamp_ntz")
    lo, hi = (F.lit(x).cast("timestamp_ntz") for x in (start, end))
    return raw.where(((c >= lo) & (c < hi)) | (c > last) | (c < first))


def latest_trips(raw: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Typed trips, one per (vendor, pickup, location): the latest copy (G1)."""
    return latest_per_key(cast_trips(raw, rules), TRIP_KEY, TRIP_ORDER, row_number_col="row_num")


def quality_filter(df: DataFrame, rules: Rules) -> DataFrame:
    """D1. Applied after deduplication: a trip whose newest copy is bad is dropped
    even if an older copy was good. Null comparisons drop the row."""
    return df.where(
        "fare_amount > 0 AND trip_distance > 0 AND passenger_count > 0 AND pickup_datetime < dropoff_datetime"
    ).where(C.minutes_crossed("pickup_datetime", "dropoff_datetime") <= F.lit(int(rules.max_duration_minutes)))


def stg_taxi_trips(raw: DataFrame, emission_factors: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Bronze trips -> cleaned, deduplicated, enriched trips (23 columns)."""
    kept = quality_filter(latest_trips(raw, rules), rules)
    p = "pickup_datetime"
    enriched = kept.select(
        C.trip_key("vendor_id", "pickup_datetime", "pickup_location_id").alias("trip_id"),
        "*",
        C.minutes_crossed(p, "dropoff_datetime").alias("trip_duration_minutes"),
        C.hour_of_day(p).alias("pickup_hour"),
        C.day_of_week0(p).alias("pickup_day_of_week"),
        C.truncate_hour(p).alias("pickup_hour_truncated"),
        run_ts(rules).alias("dbt_updated_at"),
    )
    j = lookup_join(
        enriched, emission_factors, ["vendor_id"], ["vendor_id"], ["emission_factor_g_mile"], drop_keys=False,
    )
    factor = C.emission_factor("emission_factor_g_mile", rules)
    return j.select(
        *STG_COLUMNS[:19],
        factor.alias("emission_factor"),
        (F.col("trip_distance") * factor).alias("co2_emission_grams"),
        C.flag_sql(f"{{0}} > {rules.max_distance_miles!r}", "trip_distance").alias("is_distance_anomaly"),
        C.flag_sql(f"{{0}} > {rules.max_fare!r}", "fare_amount").alias("is_fare_anomaly"),
    )


def stg_weather_hourly(raw_weather: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Typed hourly weather with category and precipitation flag (a view)."""
    return raw_weather.select(
        C.parse_ntz("TIME").alias("weather_time"),
        C.cast_as("TEMPERATURE_2M", "DOUBLE").alias("temperature_2m"),
        C.cast_as("PRECIPITATION", "DOUBLE").alias("precipitation"),
        C.cast_as("SNOWFALL", "DOUBLE").alias("snowfall"),
        C.cast_as("WINDSPEED_10M", "DOUBLE").alias("windspeed_10m"),
        C.to_int("WEATHERCODE").alias("weather_code"),
        C.cast_as("SOURCE_URL", "STRING").alias("source_url"),
        C.cast_as("LOADED_AT", "STRING").alias("loaded_at"),
    ).select(
        "*",
        C.weather_category("weather_code").alias("weather_category"),
        C.precipitation_flag("precipitation", "snowfall").alias("is_precipitation"),
        run_ts(rules).alias("dbt_updated_at"),
    )


def stg_zone_lookup(raw_zones: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Zones with 'Unknown' for missing names."""
    return raw_zones.select(
        C.to_int("LOCATIONID").alias("location_id"),
        C.unknown_if_null("BOROUGH").alias("borough"),
        C.unknown_if_null("ZONE").alias("zone"),
        C.unknown_if_null("SERVICE_ZONE").alias("service_zone"),
        C.cast_as("SOURCE_URL", "STRING").alias("source_file"),
        C.cast_as("LOADED_AT", "STRING").alias("loaded_at_bronze"),
        run_ts(rules).alias("dbt_updated_at"),
    )
