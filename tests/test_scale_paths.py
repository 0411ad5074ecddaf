"""Plans beyond the broadcast bound and under key skew give the same answers."""

from pyspark.sql import functions as F

from citylake.operators.dedup import DESC_NULLS_FIRST, latest_per_key
from citylake.plans.warehouse import Warehouse

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_dimension_over_bound_falls_back_to_shuffle_join(spark):
    prev = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        wh = Warehouse.from_testdata(spark, SF)
        p = plan(wh.fact_trips)
        assert "SortMergeJoin" in p  # weather and zones have no proven bound: no hint
        assert p.count("BroadcastHashJoin") == 2  # seeds and calendar have one
        cols = ["trip_id", "weather_category", "pickup_borough", "is_holiday"]
        a = sorted(map(tuple, wh.fact_trips.select(cols).collect()), key=repr)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)
        b = sorted(map(tuple, Warehouse.from_testdata(spark, SF).fact_trips.select(cols).collect()), key=repr)
        assert a == b
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", prev)


def test_hot_null_key_third_of_rows(spark):
    n = 30000
    df = spark.range(n).select(
        F.when(F.col("id") % 3 == 0, F.lit(None)).otherwise(F.col("id")).cast("long").alias("k"),
        F.col("id").alias("v"),
        F.when(F.col("id") == 3, F.lit(None)).otherwise(F.timestamp_seconds(F.col("id"))).cast("timestamp_ntz").alias("loaded_at"),
    )
    out = latest_per_key(df, ["k"], [("loaded_at", DESC_NULLS_FIRST)])
    assert out.count() == n - n // 3 + 1
    hot = out.where(F.col("k").isNull()).first()
    assert hot.v == 3  # the null loaded_at counts as newest
    p = plan(out)
    assert p.count("WindowGroupLimit") == 2 and p.count("Exchange hashpartitioning") == 1


def test_hot_key_sends_one_row_per_task(spark):
    hot = spark.range(0, 100_000, numPartitions=4).select(F.lit(None).cast("long").alias("k"), F.col("id").alias("v"))
    cold = spark.range(0, 200, numPartitions=1).select(F.col("id").alias("k"), F.col("id").alias("v"))
    out = latest_per_key(hot.union(cold), ["k"], [("v", DESC_NULLS_FIRST)])
    out.collect()
    metrics = {}
    stack = [out._jdf.queryExecution().executedPlan()]
    while stack:
        node = stack.pop()
        name = node.nodeName()
        if name == "Exchange":
            metrics["sent"] = node.metrics().apply("shuffleRecordsWritten").value()
        children = [node.executedPlan()] if name == "AdaptiveSparkPlan" else [node.plan()] if "QueryStage" in name else []
        kids = node.children()
        stack += children + [kids.apply(i) for i in range(kids.size())]
    assert metrics["sent"] == 204
