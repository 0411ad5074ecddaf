"""Business reports over the gold tables.

Every report is a filter + group-by (partial aggregate, then one shuffle) on a fact
or on the pre-aggregated demand table; results are bounded by a dimension's size
(vendors, zones, rate codes, hours, weeks).
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylake.config import Rules
from citylake.functions import columns as C
from citylake.operators.joins import lookup_join


def _sum(c: str, rules: Rules) -> F.Column:
    return C.stable_sum(c, rules)


# ---------------------------------------------------------------- K7 shared filter set

def date_key_of(moment: str) -> int:
    """The yyyymmdd key of the day of an ISO date or timestamp."""
    return int(_dt.datetime.fromisoformat(moment).strftime("%Y%m%d"))


def apply_filters(
    df: DataFrame,
    start: str | None = None,
    end: str | None = None,
    boroughs: Sequence[str] | None = None,
    weather: Sequence[str] | None = None,
    time_col: str = "pickup_datetime",
) -> DataFrame:
    """K7: date range [start, end), boroughs and weather categories. Plain column
    predicates, so they reach the scan when pushable; the range is also put on the date
    key where the table has one, which prunes a gold table partitioned by it."""
    keyed = "pickup_date_id" in df.columns and time_col == "pickup_datetime"
    if start:
        df = df.where(F.col(time_col) >= F.lit(start).cast("timestamp_ntz"))
        if keyed:
            df = df.where(F.col("pickup_date_id") >= date_key_of(start))
    if end:
        df = df.where(F.col(time_col) < F.lit(end).cast("timestamp_ntz"))
        if keyed:
            df = df.where(F.col("pickup_date_id") <= date_key_of(end))
    if boroughs:
        df = df.where(F.col("pickup_borough").isin(list(boroughs)))
    if weather:
        df = df.where(F.col("weather_category").isin(list(weather)))
    return df


# ---------------------------------------------------------------- K1

def week_bounds(day: str | _dt.date) -> tuple[str, str]:
    """[Monday, next Monday) of the ISO week containing ``day``."""
    d = _dt.date.fromisoformat(day) if isinstance(day, str) else day
    monday = d - _dt.timedelta(days=d.weekday())
    return monday.isoformat(), (monday + _dt.timedelta(days=7)).isoformat()


def top_vendor_co2(
    fact_trips: DataFrame, week_of: str, borough: str, payment_type_id: int, rules: Rules = Rules()
) -> DataFrame:
    """K1: the vendor with the most CO2 in the ISO week of ``week_of`` for one
    borough and payment type (ties -> lower vendor id). "Christmas week" is
    ``week_of='YYYY-12-25'``."""
    lo, hi = week_bounds(week_of)
    f = apply_filters(fact_trips, lo, hi, [borough]).where(F.col("payment_type_id") == payment_type_id)
    by_vendor = f.groupBy("vendor_id").agg(
        _sum("co2_emission_grams", rules).alias("total_co2_grams"), F.count(F.lit(1)).alias("trips")
    )
    return by_vendor.orderBy(F.col("total_co2_grams").desc(), F.col("vendor_id").asc_nulls_last()).limit(1)


# ---------------------------------------------------------------- K2

def kpi_tiles(fact_trips: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """K2: total revenue, total CO2 and trip count (one row)."""
    return fact_trips.agg(
        _sum("fare_amount", rules).alias("total_revenue"),
        _sum("co2_emission_grams", rules).alias("total_co2_grams"),
        F.count(F.lit(1)).alias("trip_count"),
    )


# ---------------------------------------------------------------- K3

def pickup_density(fact_trips: DataFrame) -> DataFrame:
    """K3: pickups per zone (rank them with ``operators.profile.top_k``)."""
    return fact_trips.groupBy("pickup_location_id", "pickup_zone", "pickup_borough").agg(
        F.count(F.lit(1)).alias("pickups")
    )


# ---------------------------------------------------------------- K4

def weather_impact(agg_demand: DataFrame, by_borough: bool = True, rules: Rules = Rules()) -> DataFrame:
    """K4: trips per hour and average fare per weather category (and borough),
    from the pre-aggregated demand table: trips / distinct hours, revenue / trips."""
    keys = ["weather_category"] + (["pickup_borough"] if by_borough else [])
    g = agg_demand.groupBy(*keys).agg(
        F.sum("total_trips").alias("trips"),
        F.count_distinct("pickup_hour_truncated").alias("hours"),
        _sum("total_revenue", rules).alias("revenue"),
    )
    return g.select(
        *keys,
        "trips",
        "hours",
        (F.col("trips") / F.nullif(F.col("hours"), F.lit(0))).alias("trips_per_hour"),
        (F.col("revenue") / F.col("trips")).alias("avg_fare"),
    )


def weather_impact_of_days(demand_days: DataFrame, by_borough: bool = True, rules: Rules = Rules()) -> DataFrame:
    """K4 from the stored days (``facts.demand_days``): the same rows, without reading hours or trips."""
    keys = ["weather_category"] + (["pickup_borough"] if by_borough else [])
    days = demand_days.groupBy("demand_date_id", *keys).agg(
        F.sum("trips").alias("trips"), _sum("revenue", rules).alias("revenue"), F.bit_count(F.bit_or("hours")).alias("hours")
    )
    g = days.groupBy(*keys).agg(F.sum("trips").alias("trips"), F.sum("hours").alias("hours"), _sum("revenue", rules).alias("revenue"))
    return g.select(
        *keys,
        "trips",
        "hours",
        (F.col("trips") / F.nullif(F.col("hours"), F.lit(0))).alias("trips_per_hour"),
        (F.col("revenue") / F.col("trips")).alias("avg_fare"),
    )


# ---------------------------------------------------------------- K5

def co2_by_vendor(sustainability: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """K5: CO2 per vendor (grams, kg, per mile)."""
    g = sustainability.groupBy("vendor_id").agg(
        F.count(F.lit(1)).alias("trips"),
        _sum("co2_emission_grams", rules).alias("total_co2_grams"),
        _sum("trip_distance", rules).alias("total_distance"),
    )
    return g.select(
        "vendor_id",
        "trips",
        "total_co2_grams",
        (F.col("total_co2_grams") / 1000.0).alias("total_co2_kg"),
        "total_distance",
        (F.col("total_co2_grams") / F.nullif(F.col("total_distance"), F.lit(0.0))).alias("co2_grams_per_mile"),
    )


# ---------------------------------------------------------------- K6

def price_anomalies(financials: DataFrame) -> DataFrame:
    """K6: airport trips whose fare is off the flat rate."""
    return financials.where(F.col("is_price_anomaly")).select(
        "trip_id",
        "vendor_id",
        "pickup_date_id",
        "rate_code_id",
        "payment_type_id",
        "fare_amount",
        "expected_fare",
        "fare_variance",
    )


# ---------------------------------------------------------------- K8

def payment_mix(fact_trips: DataFrame, grain: str = "month") -> DataFrame:
    """K8: trips per payment type per period and the type's share of the period.
    The share window is partitioned by period over already-aggregated rows
    (at most periods x payment types)."""
    period = F.date_trunc(grain, F.col("pickup_datetime")).cast("date")
    g = fact_trips.groupBy(period.alias("period_start"), "payment_type_id").agg(F.count(F.lit(1)).alias("trips"))
    w = Window.partitionBy("period_start")
    return g.select("*", (F.col("trips") / F.sum("trips").over(w)).alias("share"))


# ---------------------------------------------------------------- K9

def holiday_demand(trips_with_calendar: DataFrame, day_col: str = "pickup_date_id") -> DataFrame:
    """K9: trips per day on holidays vs other days."""
    g = trips_with_calendar.groupBy("is_holiday").agg(
        F.count(F.lit(1)).alias("trips"), F.count_distinct(day_col).alias("days")
    )
    return g.select(
        "is_holiday", "trips", "days", (F.col("trips") / F.nullif(F.col("days"), F.lit(0))).alias("trips_per_day")
    )


def holiday_demand_of_days(trip_days: DataFrame) -> DataFrame:
    """K9 from the stored days (``facts.trip_days``): one row per day, so days are counted, not told apart."""
    g = trip_days.groupBy("is_holiday").agg(F.sum("trips").alias("trips"), F.count("pickup_date_id").alias("days"))
    return g.select(
        "is_holiday", "trips", "days", (F.col("trips") / F.nullif(F.col("days"), F.lit(0))).alias("trips_per_day")
    )


# ---------------------------------------------------------------- K10

def flat_rate_discovery(trips: DataFrame) -> DataFrame:
    """Per rate code, the most frequent fare (ties -> lower fare), its trips and
    its share of the rate code. Two aggregates, no window: the second picks the
    maximum of (count, -fare) per rate code."""
    counts = trips.groupBy("rate_code_id", "fare_amount").agg(F.count(F.lit(1)).alias("n"))
    best = counts.groupBy("rate_code_id").agg(
        F.max(F.struct(F.col("n"), (-F.col("fare_amount")).alias("neg_fare"))).alias("b"),
        F.sum("n").alias("trips"),
    )
    return best.select(
        "rate_code_id",
        (-F.col("b.neg_fare")).alias("top_fare"),
        F.col("b.n").alias("top_fare_trips"),
        "trips",
        (F.col("b.n") / F.col("trips")).alias("top_fare_share"),
    )


# ---------------------------------------------------------------- K11

def vendor_risk(financials: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Price-anomaly count and summed absolute variance per vendor."""
    return (
        financials.where(F.col("is_price_anomaly"))
        .withColumn("abs_variance", F.abs("fare_variance"))
        .groupBy("vendor_id")
        .agg(F.count(F.lit(1)).alias("error_count"), _sum("abs_variance", rules).alias("total_abs_variance"))
    )


# ---------------------------------------------------------------- K12

def short_trip_share(sustainability: DataFrame, zones: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Share of trips under the short-trip threshold per pickup zone."""
    j = lookup_join(
        sustainability, zones, ["pickup_location_id"], ["location_id"], [F.col("zone").alias("pickup_zone")],
    )
    g = j.groupBy("pickup_location_id", "pickup_zone").agg(
        F.count(F.lit(1)).alias("trips"),
        F.sum(F.when(F.col("is_short_efficiency_risk"), 1).otherwise(0)).cast("long").alias("short_trips"),
    )
    return g.select("*", (F.col("short_trips") / F.col("trips")).alias("short_trip_share"))


# ---------------------------------------------------------------- K13

def hourly_co2(fact_trips: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Per pickup hour: trips, CO2 and the hour's weather."""
    return fact_trips.groupBy("pickup_hour_truncated").agg(
        F.count(F.lit(1)).alias("trips"),
        _sum("co2_emission_grams", rules).alias("co2_grams"),
        F.max("temperature_2m").alias("temperature_2m"),
        F.max(F.col("is_precipitation").cast("int")).alias("precipitation"),
    )


def co2_correlation(fact_trips: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Correlation of hourly CO2 with demand, and of demand and CO2 with
    temperature and precipitation (one row). Rounded to 9 decimals only where the rules
    ask for sums that do not depend on the order of addition (``sum_scale``)."""
    digits = 9 if rules.sum_scale is not None else None
    h = hourly_co2(fact_trips, rules)

    def r(c):
        return F.round(c, digits) if digits is not None else c

    return h.agg(
        F.count(F.lit(1)).alias("hours"),
        r(pearson("trips", "co2_grams")).alias("corr_trips_co2"),
        r(pearson("temperature_2m", "trips")).alias("corr_temperature_trips"),
        r(pearson("temperature_2m", "co2_grams")).alias("corr_temperature_co2"),
        r(pearson("precipitation", "trips")).alias("corr_precipitation_trips"),
    )


def pearson(x: str, y: str) -> F.Column:
    """Pearson correlation over the rows where both values are present, as
    covar_pop / (stddev_pop * stddev_pop); null when either side is constant. (The
    built-in ``corr`` raises DIVIDE_BY_ZERO under ANSI mode for a constant column,
    e.g. a period without any precipitation.)"""
    both = F.col(x).isNotNull() & F.col(y).isNotNull()
    cx = F.when(both, F.col(x).cast("double"))
    cy = F.when(both, F.col(y).cast("double"))
    return F.covar_pop(cx, cy) / F.nullif(F.stddev_pop(cx) * F.stddev_pop(cy), F.lit(0.0))
