"""Latest row per key.

``ROW_NUMBER() OVER (PARTITION BY key ORDER BY ...) = 1`` on built-in windows. Spark plans a
partial group limit below the shuffle: every map task keeps the first row of each of its
keys, so a key that holds a third of all rows (the null key, say) sends one row per task.
The ordering ends with all other columns as tie-breakers, so reruns give the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from citylake.functions.columns import q

DESC_NULLS_FIRST = "desc_nulls_first"
DESC_NULLS_LAST = "desc"
ASC_NULLS_LAST = "asc"
ASC_NULLS_FIRST = "asc_nulls_first"

_HOW = {
    DESC_NULLS_FIRST: "desc_nulls_first",
    DESC_NULLS_LAST: "desc_nulls_last",
    ASC_NULLS_LAST: "asc_nulls_last",
    ASC_NULLS_FIRST: "asc_nulls_first",
}


def latest_per_key(
    df: DataFrame,
    keys: Sequence[str],
    order: Sequence[tuple[str, str]],
    row_number_col: str | None = None,
) -> DataFrame:
    """Keep one row per ``keys``: the first under ``order``, then the remaining
    columns in frame order (descending, nulls last) as tie-breakers.

    ``order`` items are ``(column, how)`` with ``how`` one of ``desc_nulls_first``,
    ``desc``, ``asc``, ``asc_nulls_first``. Null keys form one group, as in
    ``PARTITION BY``. If ``row_number_col`` is given it is added with value 1.
    """
    unknown = [how for _, how in order if how not in _HOW]
    if unknown:
        raise ValueError(f"unknown ordering {unknown[0]!r}")
    used = set(keys) | {c for c, _ in order}
    by = [getattr(F.col(q(c)), _HOW[how])() for c, how in order]
    by += [F.col(q(c)).desc_nulls_last() for c in df.columns if c not in used]
    number = row_number_col or "__row_number"
    ranked = df.withColumn(number, F.row_number().over(Window.partitionBy(*[q(k) for k in keys]).orderBy(*by)))
    first = ranked.where(F.col(number) == 1)
    return first if row_number_col else first.drop(number)


def tie_break_sql(df_columns: Sequence[str], keys: Sequence[str], order: Sequence[tuple[str, str]]) -> str:
    """The ORDER BY list of the equivalent ROW_NUMBER() query (for oracles and docs)."""
    sql_of = {
        DESC_NULLS_FIRST: "DESC NULLS FIRST",
        DESC_NULLS_LAST: "DESC NULLS LAST",
        ASC_NULLS_LAST: "ASC NULLS LAST",
        ASC_NULLS_FIRST: "ASC NULLS FIRST",
    }
    parts = [f"{c} {sql_of[h]}" for c, h in order]
    used = set(keys) | {c for c, _ in order}
    parts += [f"{c} DESC NULLS LAST" for c in df_columns if c not in used]
    return ", ".join(parts)
