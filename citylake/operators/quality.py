"""Data-quality checks. Every check returns a DataFrame of failures,
so checks are distributed jobs and an empty result means "passed"."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

#: Day numbers of 0001-01-01 to 9999-12-31 (end exclusive): every day a timestamp can have.
_ALL_DAYS = (-719162, 2932897)


class QualityGateError(RuntimeError):
    """Raised by :func:`gate` when a check has failures."""

    def __init__(self, failures: Mapping[str, int]):
        self.failures = dict(failures)
        detail = ", ".join(f"{k}: {v}" for k, v in self.failures.items())
        super().__init__(f"quality gate failed ({detail})")


def unique(df: DataFrame, col: str) -> DataFrame:
    """Values of ``col`` present more than once (nulls ignored)."""
    return (
        df.where(F.col(col).isNotNull())
        .groupBy(col)
        .agg(F.count(F.lit(1)).alias("copies"))
        .where(F.col("copies") > 1)
    )


def not_null(df: DataFrame, cols: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """Rows where any of ``cols`` is null; output ``keep`` + one flag per column."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else cond | F.col(c).isNull()
    flags = [F.col(c).isNull().alias(f"{c}_is_null") for c in cols]
    return df.where(cond).select(*[F.col(k) for k in keep], *flags)


def accepted_values(df: DataFrame, col: str, values: Iterable, keep: Sequence[str] = ()) -> DataFrame:
    """Rows whose ``col`` is not in ``values`` (nulls pass, as in the declarative test)."""
    return df.where(~F.col(col).isin(list(values))).select(*[F.col(k) for k in keep] or ["*"])


def grain_preserved(before: DataFrame, after: DataFrame) -> DataFrame:
    """One row (expected_rows, actual_rows) when the counts differ, else empty.
    Both counts are single-row aggregates combined by a union, not a join."""
    counts = before.agg(F.count(F.lit(1)).alias("n")).select(F.lit("expected").alias("side"), "n").unionByName(
        after.agg(F.count(F.lit(1)).alias("n")).select(F.lit("actual").alias("side"), "n")
    )
    both = counts.agg(
        F.max(F.when(F.col("side") == "expected", F.col("n"))).alias("expected_rows"),
        F.max(F.when(F.col("side") == "actual", F.col("n"))).alias("actual_rows"),
    )
    return both.where(F.col("expected_rows") != F.col("actual_rows"))


def hourly_gaps(df: DataFrame, time_col: str, start: str | None = None, end: str | None = None) -> DataFrame:
    """Hours between ``start`` and ``end`` (default: the data's first and last
    hour) with no row.

    The hours of a day are one bitmap (``bit_or``, combined before the shuffle); a generated range of days, split
    over tasks, meets the days' bitmaps, and the bits that are not set are the missing hours.
    """
    t = F.date_trunc("hour", F.col(time_col)).cast("timestamp_ntz")
    days = df.where(F.col(time_col).isNotNull()).groupBy(F.to_date(t).alias("day")).agg(
        F.bit_or(F.call_function("shiftleft", F.lit(1), F.hour(t))).alias("hours"), F.min(t).alias("lo"), F.max(t).alias("hi")
    )
    bounds = days.agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"))
    lo = F.lit(start).cast("timestamp_ntz") if start else bounds.select("lo").scalar()
    hi = F.lit(end).cast("timestamp_ntz") if end else bounds.select("hi").scalar()
    # All days of the calendar are a range of 3.65 million numbers; the bounds prune it before the join.
    every = df.sparkSession.range(*_ALL_DAYS).select(F.date_add(F.lit("1970-01-01").cast("date"), F.col("id").cast("int")).alias("day"))
    every = every.where((F.col("day") >= F.to_date(lo)) & (F.col("day") <= F.to_date(hi)))
    bits = F.coalesce("hours", F.lit(0))
    missing = F.filter(F.sequence(F.lit(0), F.lit(23)), lambda h: F.call_function("bit_get", bits, h) == 0)
    found = every.join(days.select("day", "hours"), "day", "left").select("day", F.explode(missing).alias("hour"))
    hour = F.timestamp_add("HOUR", F.col("hour"), F.col("day").cast("timestamp_ntz"))
    return found.select(hour.alias("missing_hour")).where((F.col("missing_hour") >= lo) & (F.col("missing_hour") <= hi))


class RowChecks:
    """J2, J3 as metrics of a write: the rows that fail are counted while they are written.

    ``checks`` maps a name to the condition of a failing row. :meth:`observe` goes around the rows to write;
    after the write, :meth:`failures` has the counts without a scan. Each observation is used once.
    """

    def __init__(self, checks: Mapping[str, F.Column]):
        self.checks, self.seen = dict(checks), Observation()

    def observe(self, df: DataFrame) -> DataFrame:
        counts = [F.sum(F.when(c, 1).otherwise(0)).alias(f"check_{k}") for k, c in enumerate(self.checks.values())]
        return df.observe(self.seen, F.count(F.lit(1)).alias("rows"), *counts)

    def failures(self, written: DataFrame) -> dict[str, int]:
        """Failing rows by check, none left out. Where Spark planned the write without the metrics (it does so
        when it finds at run time that there are no rows), ``written`` is counted instead."""
        try:
            found = self.seen.get
        except Py4JJavaError:
            found = {}
        if "rows" not in found:
            counts = [F.sum(F.when(c, 1).otherwise(0)).alias(f"check_{k}") for k, c in enumerate(self.checks.values())]
            found = written.agg(F.count(F.lit(1)).alias("rows"), *counts).first().asDict()
        counts = {name: found.get(f"check_{k}") or 0 for k, name in enumerate(self.checks)}
        return {name: n for name, n in counts.items() if n}


def any_null(cols: Sequence[str]) -> F.Column:
    """The failing rows of J2, for :class:`RowChecks`."""
    return reduce(lambda a, b: a | b, (F.col(c).isNull() for c in cols))


def not_accepted(col: str, values: Iterable) -> F.Column:
    """The failing rows of J3, for :class:`RowChecks` (nulls pass)."""
    return F.col(col).isNotNull() & ~F.col(col).isin(list(values))


def unique_each(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """J1 of several columns in one scan: column, value and copies of values present more than once (nulls ignored)."""
    pairs = F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in cols))
    counted = df.select(F.inline(pairs)).where("value IS NOT NULL").groupBy("column", "value").agg(F.count(F.lit(1)).alias("copies"))
    return counted.where("copies > 1")


def gate(checks: Mapping[str, DataFrame], parallelism: int = 8, counted: Mapping[str, int] | None = None) -> dict[str, int]:
    """Run every check; raise :class:`QualityGateError` if any returned rows.

    Each check's failures are counted by a distributed count (one partial count
    per task; no failing row is collected), and independent checks are submitted
    from several driver threads so the scheduler can run them side by side. ``counted``
    are failures already known, such as those of :class:`RowChecks`.
    """
    from concurrent.futures import ThreadPoolExecutor

    names = list(checks)
    with ThreadPoolExecutor(max_workers=max(1, min(parallelism, len(names)))) as pool:
        counts = list(pool.map(lambda n: checks[n].count(), names))
    failures = {n: c for n, c in (counted or {}).items() if c} | {n: c for n, c in zip(names, counts) if c}
    if failures:
        raise QualityGateError(failures)
    return failures
