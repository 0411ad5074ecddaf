"""Profiling operators. Each returns a DataFrame."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def _count_if(cond) -> F.Column:
    return F.sum(F.when(cond, 1).otherwise(0)).cast("long")


def trip_profile(raw: DataFrame) -> DataFrame:
    """one row of counts, null counts, noise counts and the pickup range of the
    bronze trips. One aggregate pass (partial aggregates per task)."""
    fare, dist, pas = F.col("FARE_AMOUNT"), F.col("TRIP_DISTANCE"), F.col("PASSENGER_COUNT")
    pickup = F.col("TPEP_PICKUP_DATETIME")
    return raw.agg(
        F.count(F.lit(1)).alias("total_rows"),
        (F.count(F.lit(1)) - F.count("VENDORID")).alias("null_vendors"),
        (F.count(F.lit(1)) - F.count(pickup)).alias("null_pickups"),
        (F.count(F.lit(1)) - F.count("PULOCATIONID")).alias("null_pickup_locations"),
        _count_if(fare <= 0).alias("zero_or_neg_fare"),
        _count_if(dist <= 0).alias("zero_or_neg_distance"),
        _count_if(pas <= 0).alias("zero_passengers"),
        F.min(pickup).alias("min_date"),
        F.max(pickup).alias("max_date"),
    )


def duplicate_candidates(raw: DataFrame, keys: Sequence[str], form: str = "tuple") -> DataFrame:
    """COUNT(*) - COUNT(DISTINCT key). A key with a null part is not counted as
    distinct. ``form="tuple"`` compares the parts as a tuple; ``form="concat"``
    reproduces the reference's concatenated text key exactly, including its
    '1'||'23' = '12'||'3' collisions (timestamps rendered with milliseconds)."""
    if form == "tuple":
        distinct = F.count_distinct(*[F.col(k) for k in keys])
    elif form == "concat":
        types = {f.name: f.dataType for f in raw.schema.fields}
        parts = [
            F.date_format(k, "yyyy-MM-dd HH:mm:ss.SSS")
            if isinstance(types[k], (T.TimestampType, T.TimestampNTZType))
            else F.col(k).cast("string")
            for k in keys
        ]
        distinct = F.count_distinct(F.concat(*parts))
    else:
        raise ValueError(f"unknown form {form!r}")
    return raw.agg((F.count(F.lit(1)) - distinct).alias("duplicate_candidate_count"))


def duplicate_keys(df: DataFrame, keys: Sequence[str], count_col: str = "copies") -> DataFrame:
    """keys present more than once, with their number of copies."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col)).where(F.col(count_col) > 1)


def value_histogram(df: DataFrame, col: str, alias: str | None = None, count_col: str = "rows") -> DataFrame:
    """rows per value."""
    out = df.groupBy(col).agg(F.count(F.lit(1)).alias(count_col))
    return out.withColumnRenamed(col, alias) if alias else out


def row_count(df: DataFrame, alias: str = "row_count") -> DataFrame:
    """the row count as a one-row DataFrame."""
    return df.agg(F.count(F.lit(1)).alias(alias))


def rows_with_nulls(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """D3: rows where any of ``cols`` is null."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    return df.where(cond)


def distinct_sample(df: DataFrame, cols: Sequence[str], n: int) -> DataFrame:
    """H1: the first ``n`` distinct values in order (a stable sample).

    One combined aggregate (a task sends each of its values once) and a top-n of each
    task's values; nothing runs while the plan is built.
    """
    order = [F.col(c).asc_nulls_last() for c in cols]
    return df.select(*cols).distinct().orderBy(*order).limit(n)


def preview(df: DataFrame, order_by: Sequence[str], n: int) -> DataFrame:
    """H2: first ``n`` rows in a stated order (top-n sort, no full sort)."""
    return df.orderBy(*[F.col(c).asc_nulls_last() for c in order_by]).limit(n)


def top_k(df: DataFrame, measure: str, k: int, tie_break: Sequence[str]) -> DataFrame:
    """H3: the ``k`` largest rows by ``measure``; ties by ``tie_break`` ascending."""
    return df.orderBy(F.col(measure).desc(), *[F.col(c).asc_nulls_last() for c in tie_break]).limit(k)
