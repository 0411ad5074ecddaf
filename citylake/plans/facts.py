"""Facts and the demand aggregate.

``gold_fact_trips`` adds no shuffle: weather (one row per hour of the covered
period), zones and calendar days are size-checked broadcasts. The only shuffle in
``gold_agg_demand_weather`` is the group-by, with a partial aggregate before it
(about 730 trips collapse into one row per hour, borough and weather).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from citylake.config import Rules
from citylake.functions import columns as C
from citylake.operators.joins import lookup_join
from citylake.plans.silver import run_ts

FACT_TRIP_EXTRA = (
    "pickup_date_id",
    "temperature_2m",
    "is_precipitation",
    "weather_category",
    "pickup_borough",
    "pickup_zone",
    "is_holiday",
    "is_weekend",
    "holiday_name",
)


def gold_fact_trips(
    trips: DataFrame,
    weather: DataFrame,
    zones: DataFrame,
    calendar: DataFrame,
    rules: Rules = Rules(),
    with_weather_code: bool = False,
) -> DataFrame:
    """Trips LEFT JOIN weather (pickup hour) / zones (pickup location) / calendar
    (date key). Grain = one row per trip, provided each dimension is unique on its
    key (checked by J1 before the build)."""
    w_cols = ["temperature_2m", "is_precipitation", "weather_category"]
    if with_weather_code:
        w_cols.append("weather_code")
    z_cols = [F.col("borough").alias("pickup_borough"), F.col("zone").alias("pickup_zone")]
    c_cols = ["is_holiday", "is_weekend", "holiday_name"]
    t = trips.withColumn("pickup_date_id", C.date_key("pickup_datetime"))
    j = lookup_join(t, weather, ["pickup_hour_truncated"], ["weather_time"], w_cols, False)
    j = lookup_join(j, zones, ["pickup_location_id"], ["location_id"], z_cols, False)
    j = lookup_join(j, calendar, ["pickup_date_id"], ["date_id"], c_cols, False)
    out_cols = list(trips.columns) + list(FACT_TRIP_EXTRA)
    if with_weather_code:
        out_cols.append("weather_code")
    return j.select(*out_cols, run_ts(rules).alias("last_updated_at"))


def gold_fact_financials(trips: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Fare audit per trip. No anomaly filter; the calendar is not joined."""
    expected = C.expected_fare("rate_code_id", "fare_amount", rules)
    variance = F.col("fare_amount") - expected
    base = trips.select(
        "trip_id",
        "vendor_id",
        C.date_key("pickup_datetime").alias("pickup_date_id"),
        "rate_code_id",
        "payment_type_id",
        "fare_amount",
        expected.alias("expected_fare"),
        variance.alias("fare_variance"),
        C.flag(F.col("rate_code_id").isin(*rules.airport_rate_codes)).alias("is_airport_trip"),
    )
    anomaly = (F.col("rate_code_id") == rules.jfk_rate_code) & (F.abs("fare_variance") > rules.price_tolerance)
    return base.select("*", C.flag(anomaly).alias("is_price_anomaly"), run_ts(rules).alias("dbt_updated_at"))


def clean_trips(df: DataFrame) -> DataFrame:
    """Both anomaly flags false."""
    return df.where(~F.col("is_distance_anomaly") & ~F.col("is_fare_anomaly"))


def gold_fact_sustainability(trips: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Emissions per clean trip."""
    co2 = F.col("co2_emission_grams")
    return clean_trips(trips).select(
        "trip_id",
        "vendor_id",
        "pickup_location_id",
        "dropoff_location_id",
        "rate_code_id",
        "passenger_count",
        "trip_distance",
        C.date_key("pickup_datetime").alias("pickup_date_id"),
        "co2_emission_grams",
        (co2 / 1000.0).alias("co2_emission_kg"),
        C.co2_per_passenger_mile("co2_emission_grams", "trip_distance", "passenger_count").alias("co2_per_passenger_mile"),
        C.flag(F.col("trip_distance") < rules.short_trip_miles).alias("is_short_efficiency_risk"),
        run_ts(rules).alias("dbt_updated_at"),
    )


AGG_KEYS = ("pickup_hour_truncated", "pickup_day_of_week", "pickup_borough", "weather_category", "is_precipitation")


def gold_agg_demand_weather(fact_trips: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Demand by hour x borough x weather over clean trips. Null groups are kept.
    ``agg_id`` hashes hour, borough and category; day of week and the precipitation
    flag follow from the hour, so it is unique."""
    agg = clean_trips(fact_trips).groupBy(*AGG_KEYS).agg(
        F.count(F.lit(1)).alias("total_trips"),
        F.sum("passenger_count").alias("total_passengers"),
        C.stable_sum("fare_amount", rules).alias("total_revenue"),
        C.stable_sum("co2_emission_grams", rules).alias("total_co2_grams"),
        C.stable_avg("co2_emission_grams", rules).alias("avg_co2_grams_per_trip"),
        C.stable_avg("fare_amount", rules).alias("avg_fare_amount"),
        F.avg("trip_duration_minutes").alias("avg_trip_duration_minutes"),
        C.stable_avg("trip_distance", rules).alias("avg_trip_distance"),
    )
    key = C.null_safe_key(
        ["pickup_hour_truncated", "pickup_borough", "weather_category"], timestamps=["pickup_hour_truncated"]
    )
    return agg.select(key.alias("agg_id"), *agg.columns, run_ts(rules).alias("last_aggregated_at"))


def demand_days(agg_demand: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """K4's measures per day, weather category and borough, so reports add up days instead of hours.

    ``hours`` is a bitmap of the day's hours with trips: days and categories are merged by ``bit_or``, and
    the hours of different days are different, so the distinct hours of a period are the sum of the days' bits.
    """
    hour = F.call_function("shiftleft", F.lit(1), F.hour("pickup_hour_truncated"))
    return agg_demand.groupBy(C.date_key("pickup_hour_truncated").alias("demand_date_id"), "weather_category", "pickup_borough").agg(
        F.sum("total_trips").alias("trips"), C.stable_sum("total_revenue", rules).alias("revenue"), F.bit_or(hour).alias("hours")
    )


def trip_days(fact_trips: DataFrame) -> DataFrame:
    """K9's measure per day: trips, with the day's holiday flag."""
    return fact_trips.groupBy("pickup_date_id", "is_holiday").agg(F.count(F.lit(1)).alias("trips"))


def fact_trips_labeled(
    fact_trips: DataFrame,
    vendors: DataFrame,
    rate_codes: DataFrame,
    payment_types: DataFrame,
    zones: DataFrame,
    weather_lookup: DataFrame,
    rules: Rules = Rules(),
) -> DataFrame:
    """E5: the trip fact with the labels of its conformed dimensions. ``fact_trips``
    must carry ``weather_code`` (``gold_fact_trips(..., with_weather_code=True)``)."""
    j = lookup_join(fact_trips, vendors, ["vendor_id"], ["vendor_id"], ["vendor_name"])
    j = lookup_join(j, rate_codes, ["rate_code_id"], ["rate_code_id"], ["rate_code_name"])
    j = lookup_join(j, payment_types, ["payment_type_id"], ["payment_type_id"], ["payment_type_name"])
    pz = [F.col("is_airport").alias("pickup_is_airport"), F.col("borough_group").alias("pickup_borough_group")]
    j = lookup_join(j, zones, ["pickup_location_id"], ["location_id"], pz)
    dz = [F.col("borough").alias("dropoff_borough"), F.col("zone").alias("dropoff_zone")]
    j = lookup_join(j, zones, ["dropoff_location_id"], ["location_id"], dz)
    wl = [F.col("weather_category").alias("weather_code_category")]
    return lookup_join(j, weather_lookup, ["weather_code"], ["weather_code"], wl)
