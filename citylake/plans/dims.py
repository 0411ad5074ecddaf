"""Dimensions."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from citylake.config import Rules
from citylake.functions import columns as C
from citylake.operators.joins import bounded
from citylake.plans.silver import run_ts
from citylake.sources.seeds import seed


def date_spine(spark: SparkSession, start: str, n_days: int) -> DataFrame:
    """``n_days`` consecutive dates from ``start`` (A5). No input is read."""
    df = spark.range(n_days).select(F.date_add(F.lit(start).cast("date"), F.col("id").cast("int")).alias("date_day"))
    return bounded(df, n_days)


def dim_calendar(spark: SparkSession, rules: Rules = Rules(), start: str | None = None, n_days: int | None = None) -> DataFrame:
    """I4: one row per day with keys, names, ISO week, weekend and holiday flags."""
    n = n_days if n_days is not None else rules.calendar_days
    d = "date_day"
    spine = date_spine(spark, start or rules.calendar_start, n)
    base = spine.select(
        C.date_key(d).alias("date_id"),
        d,
        F.expr("year(date_day)").alias("year"),
        F.expr("month(date_day)").alias("month"),
        C.month_abbr(d).alias("month_name"),
        F.expr("dayofmonth(date_day)").alias("day_of_month"),
        C.day_of_week0(d).alias("day_of_week"),
        C.day_abbr(d).alias("day_name"),
        F.expr("quarter(date_day)").alias("quarter"),
        F.expr("weekofyear(date_day)").alias("week_of_year"),
    )
    out = base.select(
        "*",
        C.weekend_flag("day_of_week").alias("is_weekend"),
        C.holiday_name("month", "day_of_month").alias("holiday_name"),
    ).select("*", C.flag_sql("{0} IS NOT NULL", "holiday_name").alias("is_holiday"), run_ts(rules).alias("dbt_updated_at"))
    return bounded(out, n)


def dim_zones(stg_zones: DataFrame, rules: Rules = Rules()) -> DataFrame:
    """Zones with airport flag and borough group."""
    return stg_zones.select(
        "location_id",
        "borough",
        "zone",
        "service_zone",
        C.airport_flag("zone").alias("is_airport"),
        C.borough_group("borough", rules.core_borough).alias("borough_group"),
        run_ts(rules).alias("dbt_updated_at"),
    )


def _seed_dim(spark: SparkSession, name: str, id_col: str, label: str, rules: Rules, path: str | None) -> DataFrame:
    s = seed(spark, name, path)
    out = s.select(F.col(id_col).cast("int").alias(id_col), F.col(label), run_ts(rules).alias("dbt_updated_at"))
    if path is None:
        from citylake.sources.seeds import SEED_ROWS

        out = bounded(out, len(SEED_ROWS[name]))
    return out


def dim_vendors(spark: SparkSession, rules: Rules = Rules(), path: str | None = None) -> DataFrame:
    """I6."""
    return _seed_dim(spark, "seed_vendor_lookup", "vendor_id", "vendor_name", rules, path)


def dim_rate_codes(spark: SparkSession, rules: Rules = Rules(), path: str | None = None) -> DataFrame:
    """I7."""
    return _seed_dim(spark, "seed_rate_codes", "rate_code_id", "rate_code_name", rules, path)


def dim_payment_types(spark: SparkSession, rules: Rules = Rules(), path: str | None = None) -> DataFrame:
    """I8."""
    return _seed_dim(spark, "seed_payment_types", "payment_type_id", "payment_type_name", rules, path)


def dim_weather_lookup(stg_weather: DataFrame) -> DataFrame:
    """Distinct weather codes with their category (F2 + C18)."""
    return stg_weather.select("weather_code").distinct().select(
        "weather_code", C.weather_category("weather_code").alias("weather_category")
    )
