"""latest_per_key (G1) against ROW_NUMBER() semantics."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from citylake.operators.dedup import (ASC_NULLS_FIRST, ASC_NULLS_LAST, DESC_NULLS_FIRST, DESC_NULLS_LAST, latest_per_key,
                                      tie_break_sql)


def test_null_loaded_at_ranks_first_and_null_keys_group(spark):
    t1, t2 = dt.datetime(2024, 1, 1), dt.datetime(2024, 1, 2)
    df = spark.createDataFrame(
        [(1, "a", t1, 10), (1, "b", t2, 20), (1, "c", None, 30),  # null loaded_at wins
         (None, "d", t1, 40), (None, "e", t2, 50),                # null keys form one group
         (2, "f", t1, 60)],
        "k int, src string, loaded_at timestamp_ntz, v int",
    )
    out = latest_per_key(df, ["k"], [("loaded_at", DESC_NULLS_FIRST)], row_number_col="row_num")
    got = sorted((r.k if r.k is not None else -1, r.v, r.row_num) for r in out.collect())
    assert got == [(-1, 50, 1), (1, 30, 1), (2, 60, 1)]
    assert out.columns == ["k", "src", "loaded_at", "v", "row_num"]


def test_matches_row_number_on_random_rows(spark):
    rnd = random.Random(7)
    base = dt.datetime(2024, 1, 1)
    data = [
        (rnd.randint(0, 30), rnd.choice([None, base + dt.timedelta(hours=rnd.randint(0, 3))]),
         rnd.choice(["f1", "f2", None]), rnd.randint(0, 5), rnd.choice([None, 1.5, 2.5, 3.5]))
        for _ in range(2000)
    ]
    df = spark.createDataFrame(data, "k int, loaded_at timestamp_ntz, src string, a int, b double")
    order = [("loaded_at", DESC_NULLS_FIRST), ("src", DESC_NULLS_LAST), ("a", ASC_NULLS_LAST)]
    got = latest_per_key(df, ["k"], order)
    df.createOrReplaceTempView("t")
    ob = tie_break_sql(df.columns, ["k"], order)
    want = spark.sql(f"SELECT k, loaded_at, src, a, b FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY {ob}) rn FROM t) WHERE rn = 1")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)


def test_matches_row_number_with_nullable_composite_keys(spark):
    rnd = random.Random(3)
    data = [(rnd.choice([None, 1, 2]), rnd.choice([None, "x", "y"]), rnd.choice([None, 1, 2, 3]), rnd.randint(0, 9))
            for _ in range(1500)]
    df = spark.createDataFrame(data, "k1 int, k2 string, o int, v int")
    order = [("o", DESC_NULLS_FIRST)]
    got = latest_per_key(df, ["k1", "k2"], order)
    df.createOrReplaceTempView("t2")
    ob = tie_break_sql(df.columns, ["k1", "k2"], order)
    want = spark.sql(f"SELECT k1, k2, o, v FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k1, k2 ORDER BY {ob}) rn FROM t2) WHERE rn = 1")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
    assert got.count() == 9


def test_plan_limits_groups_before_single_shuffle(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), F.col("id").alias("v"))
    out = latest_per_key(df, ["k"], [("v", DESC_NULLS_LAST)])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1
    assert plan.count("WindowGroupLimit") == 2


@pytest.mark.parametrize("how", [DESC_NULLS_FIRST, DESC_NULLS_LAST, ASC_NULLS_LAST, ASC_NULLS_FIRST])
def test_every_ordering_mode_matches_row_number(spark, how):
    rnd = random.Random(hash(how) % 1000)
    base = dt.datetime(2024, 1, 1)
    data = [(rnd.randint(0, 40), rnd.choice([None, base + dt.timedelta(minutes=rnd.randint(0, 5))]),
             rnd.choice([None, 1.0, 2.0, 3.0]), rnd.randint(0, 3)) for _ in range(1200)]
    df = spark.createDataFrame(data, "k int, t timestamp_ntz, x double, v int")
    order = [("t", how), ("x", how)]
    got = latest_per_key(df, ["k"], order)
    view = f"t_{how}"
    df.createOrReplaceTempView(view)
    ob = tie_break_sql(df.columns, ["k"], order)
    want = spark.sql(f"SELECT k, t, x, v FROM (SELECT *, ROW_NUMBER() OVER (PARTITION BY k ORDER BY {ob}) rn FROM {view}) WHERE rn = 1")
    assert sorted(map(tuple, got.collect()), key=repr) == sorted(map(tuple, want.collect()), key=repr)
