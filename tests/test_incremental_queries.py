"""Incremental queries: trips in one millisecond, tables that change at their path, scratch folders that are cleared."""

import datetime as dt
import os

from pyspark.sql import functions as F
from test_incremental_gold import RULES, trips, weather, zones
from test_sources_sinks import tlc_row

import __spark_entry__ as entry
from citylake import sinks
from citylake.plans import materialize as M
from citylake.plans.loads import read_silver

def tables(spark, folder, n):
    """Events that come in twos within a millisecond, of the same user."""
    ids = spark.range(n).select(F.col("id").alias("event_id"), F.floor(F.col("id") / 2).alias("k"))
    ids.select(
        "event_id", F.expr("timestampadd(MICROSECOND, event_id % 2, timestampadd(MINUTE, CAST(k * 50 AS INT), TIMESTAMP_NTZ '2024-01-01 00:10:00'))").alias("ts"),
        (F.col("k") * 5).alias("user_id"), F.lit("x").alias("event_type"), F.lit(2.5).alias("value"), F.lit("{}").alias("props"),
    ).coalesce(1).write.mode("overwrite").parquet(f"{folder}/events.parquet")
    spark.sql("SELECT CAST(id AS INT) AS n_nationkey, concat('N', id) AS n_name, CAST(id % 2 AS INT) AS n_regionkey FROM range(25)").write.mode("overwrite").parquet(f"{folder}/nation.parquet")
    spark.sql("SELECT CAST(id AS INT) AS r_regionkey, element_at(array('AMERICA', 'ASIA'), CAST(id + 1 AS INT)) AS r_name FROM range(2)").write.mode("overwrite").parquet(f"{folder}/region.parquet")


def rows_of(df):
    return sorted(map(str, df.collect()))


def test_trips_in_one_millisecond_stay_apart(spark, tmp_root):
    q = entry.queries()
    tables(spark, tmp_root, 40)
    assert q["j1_unique_trip_id"](spark, tmp_root).count() > 5  # two trips to an id
    assert rows_of(q["i13_incremental_agg_demand"](spark, tmp_root)) == rows_of(q["i13_agg_demand_weather"](spark, tmp_root))


def test_other_tables_at_the_path_and_a_cleared_scratch_folder(spark, tmp_root):
    q = entry.queries()
    tables(spark, tmp_root, 10)
    before = q["k9_incremental_holiday_demand"](spark, tmp_root)
    old = rows_of(before)
    sinks.remove(spark, before.inputFiles()[0].split("/gold/")[0])
    tables(spark, tmp_root, 40)
    now = rows_of(q["k9_incremental_holiday_demand"](spark, tmp_root))
    assert now != old and now == rows_of(q["k9_holiday_demand"](spark, tmp_root))


def test_a_corrected_trip_leaves_the_other_one_of_its_millisecond(spark, tmp_root):
    one, w, z = tlc_row(0), weather(spark, tmp_root), zones(spark, tmp_root)
    other = dict(one, tpep_pickup_datetime=one["tpep_pickup_datetime"] + dt.timedelta(microseconds=1))
    for layout in ("by_pickup_date", "versioned"):
        root = os.path.join(tmp_root, layout)
        for run, rows in (("r1", [one, other]), ("r2", [dict(one, fare_amount=33.0)])):
            M.build_warehouse(spark, trips(spark, tmp_root, f"{layout}-{run}", rows, f"2024-02-0{run[1]} 00:00:00"), w, z, root, RULES, run_id=run, silver_layout=layout)
        path = os.path.join(root, "silver", "stg_taxi_trips")
        silver = read_silver(spark, path) if layout == "by_pickup_date" else sinks.read_current(spark, path)
        assert sorted(r.fare_amount for r in silver.collect()) == sorted([one["fare_amount"], 33.0]), layout
