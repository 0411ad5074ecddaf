"""Reference seeds as typed DataFrames, from literal rows or from CSV."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from citylake.operators.joins import bounded

# Fixed values of the reference's seed files.
EMISSION_FACTORS = [(1, 400.0), (2, 411.0)]
VENDORS = [(1, "Creative Mobile Technologies"), (2, "VeriFone Inc.")]
RATE_CODES = [
    (1, "Standard"),
    (2, "JFK"),
    (3, "Newark"),
    (4, "Nassau or Westchester"),
    (5, "Negotiated"),
    (6, "Group ride"),
]
PAYMENT_TYPES = [
    (1, "Credit Card"),
    (2, "Cash"),
    (3, "No charge"),
    (4, "Dispute"),
    (5, "Unknown"),
    (6, "Voided trip"),
]

SEED_SCHEMAS: dict[str, T.StructType] = {
    "seed_emission_factors": T.StructType(
        [T.StructField("vendor_id", T.IntegerType()), T.StructField("emission_factor_g_mile", T.DoubleType())]
    ),
    "seed_vendor_lookup": T.StructType(
        [T.StructField("vendor_id", T.IntegerType()), T.StructField("vendor_name", T.StringType())]
    ),
    "seed_rate_codes": T.StructType(
        [T.StructField("rate_code_id", T.IntegerType()), T.StructField("rate_code_name", T.StringType())]
    ),
    "seed_payment_types": T.StructType(
        [T.StructField("payment_type_id", T.IntegerType()), T.StructField("payment_type_name", T.StringType())]
    ),
}

SEED_ROWS = {
    "seed_emission_factors": EMISSION_FACTORS,
    "seed_vendor_lookup": VENDORS,
    "seed_rate_codes": RATE_CODES,
    "seed_payment_types": PAYMENT_TYPES,
}


def seed(spark: SparkSession, name: str, path: str | None = None) -> DataFrame:
    """A seed table: from ``path`` (CSV with header) when given, else the built-in rows.

    Built-in seeds carry their row bound, so joins broadcast them without a check.
    """
    schema = SEED_SCHEMAS[name]
    if path is not None:
        return spark.read.schema(schema).option("header", True).option("mode", "FAILFAST").csv(path)
    rows = SEED_ROWS[name]
    # A literal VALUES relation is a local relation in the plan: no job, no Python
    # workers, and its exact size is known to the planner.
    values = ", ".join("(" + ", ".join(_sql_literal(v, f.dataType) for v, f in zip(r, schema.fields)) + ")" for r in rows)
    names = ", ".join(f.name for f in schema.fields)
    return bounded(spark.sql(f"SELECT * FROM VALUES {values} AS t({names})"), len(rows))


def _sql_literal(v, dt: T.DataType) -> str:
    if v is None:
        return f"CAST(NULL AS {dt.simpleString()})"
    if isinstance(dt, T.StringType):
        return "'" + str(v).replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"CAST({v!r} AS {dt.simpleString()})"
