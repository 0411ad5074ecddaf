"""Lookup joins of a fact to small dimensions.

All lookups are LEFT OUTER equi-joins of the trip fact to a dimension. A broadcast is
asked for only where the dimension's size is known when the plan is built: literal seed
rows and the generated calendar (:func:`bounded`). Every other side carries no hint, so
Spark's byte threshold and AQE choose between a broadcast and a shuffle join with
skewed partitions split. No job runs while a plan is built.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

_BOUND_ATTR = "_citylake_row_bound"


def bounded(df: DataFrame, max_rows: int) -> DataFrame:
    """Record that ``df`` has at most ``max_rows`` rows by construction."""
    setattr(df, _BOUND_ATTR, int(max_rows))
    return df


def known_bound(df: DataFrame) -> int | None:
    return getattr(df, _BOUND_ATTR, None)


def lookup_join(
    fact: DataFrame,
    dim: DataFrame,
    fact_keys: Sequence[str],
    dim_keys: Sequence[str],
    columns: Sequence | None = None,
    drop_keys: bool = True,
) -> DataFrame:
    """fact LEFT JOIN dim ON fact_keys = dim_keys, keeping every fact row.

    ``columns`` (names or aliased Columns) are the dimension columns to bring along.
    ``dim_keys`` are dropped from the output (the fact's keys stay). Grain is preserved
    only if the dimension is unique on its key; check that with
    :func:`citylake.operators.quality.unique` before joining (J1).
    """
    tmp = [f"__lk{i}_{k}" for i, k in enumerate(dim_keys)]
    cols = list(columns) if columns is not None else [c for c in dim.columns if c not in dim_keys]
    d = dim.select(*[F.col(k).alias(t) for k, t in zip(dim_keys, tmp)], *cols)
    if known_bound(dim) is not None:
        d = F.broadcast(d)
    cond = None
    for fk, t in zip(fact_keys, tmp):
        c = fact[fk] == d[t]
        cond = c if cond is None else cond & c
    joined = fact.join(d, cond, "left")
    # Callers that project explicit columns next pass drop_keys=False and save a
    # plan step (each DataFrame step is analysed eagerly on the driver).
    return joined.drop(*tmp) if drop_keys else joined
