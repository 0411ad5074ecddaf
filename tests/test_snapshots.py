"""Snapshot tables: one state at any time, whatever step a run stops at; refresh, ledger and bronze layout."""

import os

import pytest
from test_sources_sinks import tlc_row, write_tlc

from citylake import sinks
from citylake.plans import loads
from citylake.sinks import ledger, snapshots
from citylake.sources import files

SCHEMA = "k string, v int, d string"
STEPS = ["updates staged", "partitions written", "checked", "manifest written", "committed"]


def table(spark, *rows):
    return spark.createDataFrame(list(rows), SCHEMA)


def state(spark, path):
    return sorted(map(tuple, snapshots.read(spark, path).collect()))


def stop_at(monkeypatch, step):
    def reached(at):
        if at == step:
            raise RuntimeError(step)

    monkeypatch.setattr(snapshots, "_reached", reached)


def test_upsert_rewrites_only_touched_partitions(spark, tmp_root):
    path = os.path.join(tmp_root, "t")
    first, _ = snapshots.upsert(spark, path, table(spark, ("a", 1, "x"), ("b", 2, "x"), ("c", 3, "y")), "k", "d", "r1")
    second, changed = snapshots.upsert(spark, path, table(spark, ("b", 20, "x"), ("e", 5, "x")), "k", "d", "r2")
    want = [("a", 1, "x"), ("b", 20, "x"), ("c", 3, "y"), ("e", 5, "x")]
    assert state(spark, path) == want and changed == ["d=x"] == snapshots.changed(first, second)
    assert first.parts["d=y"] == second.parts["d=y"]  # the folder of the other partition is the same
    snapshots.upsert(spark, path, table(spark, ("b", 20, "x"), ("e", 5, "x")), "k", "d", "r2")
    assert state(spark, path) == want  # a rerun changes no row
    assert not os.path.exists(os.path.join(path, "_staging")) or os.listdir(os.path.join(path, "_staging")) == []


@pytest.mark.parametrize("step", STEPS)
def test_readers_see_one_state_whatever_step_a_run_stops_at(spark, tmp_root, monkeypatch, step):
    """Two partitions change; a reader sees both changes or none, and a rerun completes."""
    path = os.path.join(tmp_root, "t")
    snapshots.upsert(spark, path, table(spark, ("a", 1, "x"), ("b", 2, "y")), "k", "d", "r1")
    old, new = [("a", 1, "x"), ("b", 2, "y")], [("a", 10, "x"), ("b", 20, "y"), ("c", 3, "z")]
    updates = table(spark, ("a", 10, "x"), ("b", 20, "y"), ("c", 3, "z"))
    opened = snapshots.read(spark, path)  # a reader that resolved its folders before the run
    stop_at(monkeypatch, step)
    with pytest.raises(RuntimeError):
        snapshots.upsert(spark, path, updates, "k", "d", "r2")
    assert state(spark, path) == (new if step == "committed" else old)
    assert sorted(map(tuple, opened.collect())) == old
    monkeypatch.undo()
    snapshots.upsert(spark, path, updates, "k", "d", "r2")
    assert state(spark, path) == new and sorted(map(tuple, opened.collect())) == old


def test_failing_check_and_refresh_leave_the_former_rows(spark, tmp_root):
    path = os.path.join(tmp_root, "t")
    snapshots.upsert(spark, path, table(spark, ("a", 1, "x"), ("b", 2, "y")), "k", "d", "r1")

    def stop(rows):
        raise ValueError(rows.count())

    for refresh in (False, True):
        with pytest.raises(ValueError):
            snapshots.upsert(spark, path, table(spark, ("a", 9, "x")), "k", "d", "r2", full_refresh=refresh, check=stop)
        assert state(spark, path) == [("a", 1, "x"), ("b", 2, "y")]
    # corrected input under the same run id is merged, not what was staged before
    snapshots.upsert(spark, path, table(spark, ("a", 7, "x")), "k", "d", "r2")
    assert state(spark, path) == [("a", 7, "x"), ("b", 2, "y")]
    _, changed = snapshots.upsert(spark, path, table(spark, ("a", 5, "x")), "k", "d", "r3", full_refresh=True)
    assert state(spark, path) == [("a", 5, "x")] and changed == ["d=x", "d=y"]


def test_drift_empty_updates_and_expiry(spark, tmp_root):
    path = os.path.join(tmp_root, "t")
    snapshots.upsert(spark, path, table(spark), "k", "d", "r0")
    assert state(spark, path) == []
    for k in range(4):
        snapshots.upsert(spark, path, table(spark, ("a", k, "x"), *([("b", 1, "y")] if k == 0 else [])), "k", "d", f"r{k}")
    with pytest.raises(sinks.SchemaDriftError):
        snapshots.upsert(spark, path, table(spark).withColumnRenamed("v", "w"), "k", "d", "bad")
    assert snapshots.expire(spark, path, keep=1) == [1, 3, 4]  # version 2 still holds partition y
    assert state(spark, path) == [("a", 3, "x"), ("b", 1, "y")]
    assert snapshots.folders(spark, os.path.join(path, "data", "snapshot_version=0000000002")) == ["d=y"]
    snapshots.upsert(spark, path, table(spark, (None, 1, None)), "k", "d", "null")
    assert (None, 1, None) in [tuple(r) for r in snapshots.read(spark, path).collect()]


def test_ledger_recognises_files(spark, tmp_root):
    bronze, landing = os.path.join(tmp_root, "bronze"), os.path.join(tmp_root, "landing")
    os.makedirs(landing)
    write_tlc(os.path.join(landing, "a.parquet"), [tlc_row(0)])
    landed = files.landed_files(spark, os.path.join(landing, "*.parquet"))
    assert [f.path.rsplit("/", 1)[1] for f in landed] == ["a.parquet"] and landed[0].length > 0
    assert ledger.sorted_out(spark, bronze, landed, "r1") == {"new": landed, "resent": [], "loaded": []}
    ledger.record(spark, bronze, "r1", landed, "build")
    ledger.record(spark, bronze, "r1", landed, "build")  # recorded twice counts once
    assert ledger.recorded(spark, bronze).count() == 1 and ledger.loads(spark, bronze) == ["r1"]
    assert ledger.sorted_out(spark, bronze, landed, "r2")["loaded"] == landed
    assert ledger.sorted_out(spark, bronze, landed, "r1")["new"] == landed  # a replay of its own load
    write_tlc(os.path.join(landing, "a.parquet"), [tlc_row(0), tlc_row(1)])
    again = files.landed_files(spark, landing)
    assert ledger.sorted_out(spark, bronze, again, "r2")["resent"] == again


def test_a_load_reads_only_the_buckets_it_touches(spark, tmp_root):
    """One trip of one day: the scan of bronze has partition filters, and reads one folder of each load."""
    from citylake.config import Rules

    bronze = os.path.join(tmp_root, "bronze")
    p = os.path.join(tmp_root, "f.parquet")
    write_tlc(p, [tlc_row(60 * 24 * day + minute) for day in range(3) for minute in range(20)])
    for load in ("first", "second"):
        loads.write_bronze(files.read_trips(spark, p, "2024-02-01 00:00:00"), bronze, load, Rules())
        ledger.record(spark, bronze, load, [], "test")
    write_tlc(p, [tlc_row(60 * 24)])
    loads.write_bronze(files.read_trips(spark, p, "2024-03-01 00:00:00"), bronze, "third", Rules())
    rows = loads.touched_trips(loads.read_bronze(spark, bronze, ["third"]), "third", Rules())
    got = rows.collect()
    assert len(got) == 3 and len({r["TPEP_PICKUP_DATETIME"] for r in got}) == 1
    plan = rows._jdf.queryExecution().executedPlan().toString()
    scan = next(x for x in plan.splitlines() if "PartitionFilters" in x and "trip_bucket" in x.split("PartitionFilters")[1])
    assert "pickup_day" in scan.split("PartitionFilters")[1]
    from pyspark.sql import functions as F

    pair = loads.read_bronze(spark, bronze, ["third"]).where("load = 'third'").first()
    near = loads.read_bronze(spark, bronze, ["third"]).where(loads._touched([(pair["pickup_day"], pair["trip_bucket"])], loads.TRIP_BUCKETS))
    folders = {r[0].rsplit("/", 1)[0] for r in near.select(F.input_file_name()).collect()}
    assert len(folders) == 3 and near.count() < 20  # one day and bucket in each of three loads
    # rows of a load that was never completed are not read
    assert loads.read_bronze(spark, bronze).where("load = 'third'").count() == 0


def test_footers_take_the_same_jobs_for_any_number_of_files(spark, tmp_root):
    def jobs(n):
        folder = os.path.join(tmp_root, f"n{n}")
        os.makedirs(folder)
        for k in range(n):
            write_tlc(os.path.join(folder, f"m{k}.parquet"), [tlc_row(k)])
        group = f"footers-{n}"
        spark.sparkContext.setJobGroup(group, group)
        try:
            rows = files.read_trips(spark, os.path.join(folder, "*.parquet"))
            count = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        finally:
            spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert rows.count() == n
        return count

    assert jobs(2) == jobs(9)


def test_mixed_types_and_files_that_are_no_parquet(spark, tmp_root):
    import pandas as pd

    a, b = os.path.join(tmp_root, "a.parquet"), os.path.join(tmp_root, "b.parquet")
    write_tlc(a, [tlc_row(0)])
    pd.read_parquet(a).assign(passenger_count=pd.Series([3], dtype="int64")).to_parquet(b, index=False, coerce_timestamps="us")
    index = {(r["path"].rsplit("/", 1)[1], r["column"]): r["type"] for r in files.footer_index(spark, [a, b]).collect()}
    assert index["a.parquet", "passenger_count"] == "double" and index["b.parquet", "passenger_count"] == "bigint"
    assert sorted(r["PASSENGER_COUNT"] for r in files.read_trips(spark, [a, b]).collect()) == [1.0, 3.0]
    bad = os.path.join(tmp_root, "c.parquet")
    open(bad, "w").write("not parquet")
    assert [tuple(r)[1:] for r in files.footer_index(spark, [bad]).collect()] == [(None, None)]
