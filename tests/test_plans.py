"""Physical plan shape of the gold layer: shuffles only where the model needs one,
broadcasts for dimensions, filters pushed to the scan."""

import pytest

from citylake.plans.warehouse import Warehouse
from citylake.plans import reports

SF = "/root/testdata/sf0.001"


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def wh(spark):
    return Warehouse.from_testdata(spark, SF)


def test_fact_trips_only_shuffles_for_dedup(wh):
    p = plan(wh.fact_trips)
    # the dedup shuffle, plus the weather spine's one-row min/max aggregate
    assert p.count("Exchange hashpartitioning(vendor_id") == 1
    assert "SortMergeJoin" not in p
    assert p.count("BroadcastHashJoin") >= 4  # emission factors, weather, zones, calendar


def test_agg_has_partial_aggregate(wh):
    p = plan(wh.agg_demand_weather)
    assert "partial_count" in p and "partial_sum" in p


def test_filters_and_pruning_reach_scan(spark):
    df = spark.read.parquet(f"{SF}/events.parquet")
    f = reports.apply_filters(df.withColumnRenamed("ts", "pickup_datetime"), "2024-01-08", "2024-01-22")
    p = plan(f.select("event_id"))
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in p
    assert "ReadSchema: struct<event_id:bigint,ts:timestamp_ntz>" in p


@pytest.mark.parametrize("name", ["i1_stg_taxi_trips", "i10_fact_trips", "i13_agg_demand_weather",
                                  "e5_fact_trips_labeled", "g1_latest_lineitem", "k10_flat_rate_discovery"])
def test_headline_plans_have_no_python(spark, name):
    import __spark_entry__ as E

    p = plan(E.queries()[name](spark, SF))
    for op in ("BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas"):
        assert op not in p


@pytest.mark.parametrize("name", ["g1_latest_per_trip", "i1_stg_taxi_trips", "g1_latest_lineitem"])
def test_dedup_limits_groups_on_both_sides_of_its_shuffle(spark, name):
    import __spark_entry__ as E

    p = plan(E.queries()[name](spark, SF))
    final, partial = p.index(", 1, Final"), p.index(", 1, Partial")
    assert final < p.index("Exchange hashpartitioning", final) < partial


@pytest.mark.parametrize("name", ["k1_top_vendor_co2_week", "k7_filtered_kpis"])
def test_period_reports_push_the_range_to_the_raw_scan(spark, name):
    import __spark_entry__ as E

    p = E.queries()[name](spark, SF)._jdf.queryExecution().toString()
    assert "GreaterThanOrEqual(ts," in p.split("PushedFilters", 1)[1]


def test_period_filter_prunes_gold_partitions(spark, tmp_path, wh):
    path = str(tmp_path / "fact")
    wh.fact_trips.write.partitionBy("pickup_date_id").parquet(path)
    gold = spark.read.parquet(path)
    f = reports.apply_filters(gold, "2024-01-08", "2024-01-10")
    p = plan(f)
    assert "pickup_date_id" in p.split("PartitionFilters: [", 1)[1].split("]")[0]
    assert f.count() == reports.apply_filters(wh.fact_trips, "2024-01-08", "2024-01-10").count()


def test_no_job_runs_while_a_query_is_built(spark):
    import __spark_entry__ as E

    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "building")
    try:
        for name, query in E.queries().items():
            if name == "pipeline" or name.startswith(("op", "a1_read", "a2_read", "a3_read", "a6_", "b1_", "b5_upserted", "b6_", "b7_", "b9_", "j6_")) or "_incremental_" in name:
                continue  # these write files or tables on their way
            query(spark, SF)
        assert list(tracker.getJobIdsForGroup("building")) == []
    finally:
        spark.sparkContext.setJobGroup("", "")
