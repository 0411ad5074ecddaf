"""Sources (A1-A6) and sinks (B1-B10) on files in a temporary folder."""

import datetime as dt
import json
import os

import pandas as pd
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from citylake import sinks
from citylake.operators import quality as Q
from citylake.plans import dims, silver
from citylake.sources import files, seeds


def write_tlc(path, rows):
    """A landed TLC-style parquet file with source column names."""
    cols = {
        "VendorID": pa.int32(), "tpep_pickup_datetime": pa.timestamp("us"), "tpep_dropoff_datetime": pa.timestamp("us"),
        "passenger_count": pa.float64(), "trip_distance": pa.float64(), "RatecodeID": pa.float64(),
        "store_and_fwd_flag": pa.string(), "PULocationID": pa.int32(), "DOLocationID": pa.int32(),
        "payment_type": pa.int64(), "fare_amount": pa.float64(), "extra": pa.float64(), "mta_tax": pa.float64(),
        "tip_amount": pa.float64(), "tolls_amount": pa.float64(), "improvement_surcharge": pa.float64(),
        "total_amount": pa.float64(), "congestion_surcharge": pa.float64(), "airport_fee": pa.float64(),
    }
    data = {c: [r.get(c) for r in rows] for c in cols}
    pq.write_table(pa.table(data, schema=pa.schema(list(cols.items()))), path)


def tlc_row(i, fare=10.0, minutes=10):
    p = dt.datetime(2023, 1, 1, 0, 0) + dt.timedelta(minutes=i)
    return {"VendorID": 1 + i % 2, "tpep_pickup_datetime": p, "tpep_dropoff_datetime": p + dt.timedelta(minutes=minutes),
            "passenger_count": 1.0, "trip_distance": 1.0 + i, "RatecodeID": 1.0, "PULocationID": 100 + i % 3,
            "DOLocationID": 7, "payment_type": 1, "fare_amount": fare, "airport_fee": 0.0}


def test_read_trips_maps_names_and_adds_audit(spark, tmp_root):
    p = os.path.join(tmp_root, "yellow_tripdata_2023-01.parquet")
    write_tlc(p, [tlc_row(i) for i in range(5)])
    df = files.read_trips(spark, p, loaded_at="2024-02-01 00:00:00")
    assert df.columns[:2] == ["VENDORID", "TPEP_PICKUP_DATETIME"] and "AIRPORT_FEE" in df.columns
    r = df.orderBy("TPEP_PICKUP_DATETIME").first()
    assert r.SOURCE_FILE == "yellow_tripdata_2023-01.parquet" and r.LOADED_AT == dt.datetime(2024, 2, 1)
    assert df.count() == 5


def test_read_weather_json(spark, tmp_root):
    good = os.path.join(tmp_root, "w1.json")
    with open(good, "w") as f:
        json.dump({"hourly": {"time": ["2023-01-01T00:00", "2023-01-01T01:00"], "temperature_2m": [1.5, 2.0],
                              "precipitation": [0.0, 0.4], "snowfall": [0.0, 0.0], "windspeed_10m": [3.0, 4.0],
                              "weathercode": [0, 61]}}, f)
    empty = os.path.join(tmp_root, "w2.json")
    with open(empty, "w") as f:
        json.dump({"error": "none"}, f)
    w = files.read_weather(spark, good, "http://x", "2024-01-01 00:00:00")
    out = silver.stg_weather_hourly(w).orderBy("weather_time").collect()
    assert [(r.weather_code, r.weather_category, r.is_precipitation) for r in out] == [(0, "Clear", False), (61, "Rain", True)]
    assert files.read_weather(spark, empty).count() == 0


def test_read_zones_na_tokens(spark, tmp_root):
    p = os.path.join(tmp_root, "zones.csv")
    with open(p, "w") as f:
        f.write('"LocationID","Borough","Zone","service_zone"\n1,"EWR","Newark Airport","EWR"\n'
                '264,"Unknown","N/A","N/A"\n265,"N/A",,"N/A"\n')
    z = silver.stg_zone_lookup(files.read_zones(spark, p, "http://z"))
    d = dims.dim_zones(z).orderBy("location_id").collect()
    assert [(r.borough, r.zone, r.is_airport, r.borough_group) for r in d] == [
        ("EWR", "Newark Airport", True, "Outer Boroughs"), ("Unknown", "Unknown", False, "Unknown"),
        ("Unknown", "Unknown", False, "Unknown")]


def test_seed_from_csv_matches_builtin(spark, tmp_root):
    p = os.path.join(tmp_root, "seed_rate_codes.csv")
    pd.DataFrame(seeds.RATE_CODES, columns=["rate_code_id", "rate_code_name"]).to_csv(p, index=False)
    a = sorted(map(tuple, seeds.seed(spark, "seed_rate_codes", p).collect()))
    b = sorted(map(tuple, seeds.seed(spark, "seed_rate_codes").collect()))
    assert a == b == seeds.RATE_CODES


def test_calendar(spark):
    cal = dims.dim_calendar(spark)
    assert cal.count() == 3650
    last = cal.orderBy(F.col("date_day").desc()).first()
    assert last.date_day == dt.date(2032, 12, 28)
    xmas = cal.where("date_id = 20231225").first()
    assert xmas.is_holiday and xmas.holiday_name == "Christmas Day" and xmas.day_name == "Mon"
    assert Q.unique(cal, "date_id").count() == 0


def test_append_twice_duplicates_then_dedup(spark, tmp_root):
    p = os.path.join(tmp_root, "f.parquet")
    write_tlc(p, [tlc_row(i) for i in range(4)])
    bronze = os.path.join(tmp_root, "bronze")
    for at in ("2024-02-01 00:00:00", "2024-02-02 00:00:00"):
        sinks.append(files.read_trips(spark, p, loaded_at=at), bronze)
    b = spark.read.parquet(bronze)
    assert b.count() == 8
    stg = silver.stg_taxi_trips(b, seeds.seed(spark, "seed_emission_factors"))
    assert stg.count() == 4 and Q.unique(stg, "trip_id").count() == 0


def test_versioned_upsert_and_schema_drift(spark, tmp_root):
    root = os.path.join(tmp_root, "silver")
    v1 = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    assert sinks.incremental_upsert(spark, root, v1, "k")[0] == 1
    v2 = spark.createDataFrame([("b", 20), ("c", 3)], "k string, v int")
    ver, _ = sinks.incremental_upsert(spark, root, v2, "k")
    assert ver == 2
    cur = sorted(map(tuple, sinks.read_current(spark, root).collect()))
    assert cur == [("a", 1), ("b", 20), ("c", 3)]
    with pytest.raises(sinks.SchemaDriftError):
        sinks.incremental_upsert(spark, root, spark.createDataFrame([("d", 4.0)], "k string, v double"), "k")
    ver, _ = sinks.incremental_upsert(spark, root, v2, "k", full_refresh=True)
    assert sorted(map(tuple, sinks.read_current(spark, root).collect())) == [("b", 20), ("c", 3)]
    # rerunning an explicit version rewrites it instead of adding rows
    sinks.write_version(spark, v1, root, version=ver)
    assert sinks.read_current(spark, root).count() == 2


def test_load_observes_rows(spark, tmp_root):
    r = sinks.load(spark.range(123), os.path.join(tmp_root, "obs"))
    assert r.rows == 123 and r.seconds >= 0


def test_quality_gate_raises(spark):
    df = spark.createDataFrame([(1,), (1,), (None,)], "k int")
    with pytest.raises(Q.QualityGateError) as e:
        Q.gate({"unique_k": Q.unique(df, "k"), "not_null_k": Q.not_null(df, ["k"])})
    assert e.value.failures == {"unique_k": 1, "not_null_k": 1}
    assert Q.gate({"ok": Q.unique(spark.range(3), "id")}) == {}


def test_weather_gaps_and_duplicates(spark):
    hrs = [dt.datetime(2023, 1, 1, h) for h in (0, 1, 1, 4)]
    df = spark.createDataFrame([(h,) for h in hrs], "weather_time timestamp_ntz")
    gaps = sorted(r.missing_hour.hour for r in Q.hourly_gaps(df, "weather_time").collect())
    assert gaps == [2, 3]
    assert Q.unique(df, "weather_time").first().copies == 2


def test_raw_trips_table_ddl(spark, tmp_root):
    sinks.create_raw_trips_table(spark, "raw_taxi_trips_t", os.path.join(tmp_root, "rt"))
    assert len(spark.table("raw_taxi_trips_t").columns) == 21


def test_table_lookup_by_layer_and_view(spark, tmp_root):
    root = os.path.join(tmp_root, "lake")
    sinks.write_version(spark, spark.range(5), f"{root}/silver/stg_zone_lookup")
    assert files.table(spark, "silver", "stg_zone_lookup", root=root).count() == 5
    with pytest.raises(ValueError):
        files.table(spark, "platinum", "x", root=root)
    sinks.as_view(spark.range(3), "v_three")
    assert spark.table("v_three").count() == 3


def test_run_ingest_composes_and_propagates_errors(spark, tmp_root):
    out = os.path.join(tmp_root, "ingest")
    r = sinks.run_ingest(lambda: spark.range(10), lambda df: df.where("id % 2 = 0"), lambda df: sinks.load(df, out))
    assert r.rows == 5

    def boom():
        raise RuntimeError("source down")

    with pytest.raises(RuntimeError):
        sinks.run_ingest(boom, lambda df: df, lambda df: sinks.load(df, out))


def test_build_job_from_landed_files(spark, tmp_root):
    """The spark-submit entry point on landed trip, weather and zone files."""
    from citylake.__main__ import main

    land = os.path.join(tmp_root, "landing")
    os.makedirs(land)
    write_tlc(os.path.join(land, "yellow_tripdata_2023-01.parquet"), [tlc_row(i) for i in range(8)])
    with open(os.path.join(land, "weather.json"), "w") as f:
        hours = [f"2023-01-01T{h:02d}:00" for h in range(3)]
        json.dump({"hourly": {"time": hours, "temperature_2m": [1.0] * 3, "precipitation": [0.0] * 3,
                              "snowfall": [0.0] * 3, "windspeed_10m": [2.0] * 3, "weathercode": [0, 61, 71]}}, f)
    with open(os.path.join(land, "zones.csv"), "w") as f:
        f.write("LocationID,Borough,Zone,service_zone\n100,Manhattan,Midtown,Yellow Zone\n101,Queens,JFK Airport,Airports\n")
    out = os.path.join(tmp_root, "wh")
    assert main(["build", "--trips", os.path.join(land, "yellow_tripdata_2023-01.parquet"),
                 "--weather", os.path.join(land, "weather.json"), "--zones", os.path.join(land, "zones.csv"),
                 "--out", out]) == 0
    from citylake.plans.materialize import read_gold

    fact = read_gold(spark, out, "gold_fact_trips")
    assert fact.count() == 8
    assert fact.where("pickup_borough = 'Manhattan'").count() == 3
    assert fact.where("weather_category = 'Clear'").count() == 8


def test_text_time_functions(spark):
    from citylake.functions import columns as C

    df = spark.createDataFrame([("2023-01-01T05:30",)], "t string")
    r = df.select(C.parse_ntz("t").alias("ts")).select("ts", C.iso_text("ts").alias("txt")).first()
    assert r.ts == dt.datetime(2023, 1, 1, 5, 30) and r.txt == "2023-01-01 05:30:00"


def test_read_trips_mixed_integer_widths_and_missing_column(spark, tmp_root):
    a = os.path.join(tmp_root, "m1.parquet")
    write_tlc(a, [tlc_row(i) for i in range(3)])  # VendorID int32, payment_type int64
    b = os.path.join(tmp_root, "m2.parquet")
    pdf = pd.DataFrame({"VendorID": pd.Series([2], dtype="int64"),
                        "tpep_pickup_datetime": [pd.Timestamp("2023-02-01 10:00")],
                        "tpep_dropoff_datetime": [pd.Timestamp("2023-02-01 10:05")],
                        "passenger_count": [1.0], "trip_distance": [3.0], "RatecodeID": [1.0],
                        "PULocationID": pd.Series([7], dtype="int64"), "DOLocationID": pd.Series([8], dtype="int64"),
                        "payment_type": pd.Series([2], dtype="int32"), "fare_amount": [9.0]})  # no airport fee
    pdf.to_parquet(b, index=False, coerce_timestamps="us")
    df = files.read_trips(spark, [a, b], loaded_at="2024-02-01 00:00:00")
    assert df.count() == 4
    r = df.where("SOURCE_FILE = 'm2.parquet'").first()
    assert r.VENDORID == 2 and r.PAYMENT_TYPE == 2 and r.AIRPORT_FEE is None


def test_monthly_paths_and_empty_load(spark, tmp_root):
    ps = files.monthly_trip_paths("s3://b/trips", "2022-11", "2023-02")
    assert [p.rsplit("/", 1)[1] for p in ps] == [
        "yellow_tripdata_2022-11.parquet", "yellow_tripdata_2022-12.parquet",
        "yellow_tripdata_2023-01.parquet", "yellow_tripdata_2023-02.parquet"]
    out = os.path.join(tmp_root, "empty")
    r = sinks.load(spark.range(0), out)
    assert r.rows == 0 and not os.path.exists(out)


def test_duplicate_candidates_concat_collisions(spark):
    from citylake.operators.profile import duplicate_candidates

    df = spark.createDataFrame([("1", "23"), ("12", "3"), ("1", "23"), (None, "x")], "a string, b string")
    assert duplicate_candidates(df, ["a", "b"]).first()[0] == 2            # 3 distinct tuples, null skipped
    assert duplicate_candidates(df, ["a", "b"], "concat").first()[0] == 3  # '123' collides


@pytest.mark.parametrize("layout", ["partitioned", "versioned"])
def test_upsert_evaluates_its_updates_once(spark, tmp_root, layout):
    path = os.path.join(tmp_root, layout)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    from citylake.sinks import snapshots

    schema = "k long, v long, d string"
    rows = spark.range(1000).selectExpr("id AS k", "id AS v", "CAST(id % 3 AS STRING) AS d")
    for run in ("r1", "r2"):
        seen.value = 0
        updates = rows.mapInPandas(count, schema)
        if layout == "partitioned":
            snapshots.upsert(spark, path, updates, "k", "d", run)
        else:
            sinks.incremental_upsert(spark, path, updates, "k")
        assert seen.value == 1000


def test_expired_versions_leave_the_newest(spark, tmp_root):
    path = os.path.join(tmp_root, "versions")
    for k in range(4):
        sinks.write_version(spark, spark.range(k), path)
    assert sinks.expire_versions(spark, path, keep=2) == [1, 2]
    assert sinks.expire_versions(spark, path, keep=2) == []
    assert sinks.read_current(spark, path).count() == 3


def test_months_with_different_count_types_read_together(spark, tmp_root):
    from pyspark.sql import functions as F

    from citylake.sources import files

    base = spark.range(3).select(
        F.col("id").cast("int").alias("VendorID"), F.lit("2024-01-01 10:00:00").cast("timestamp_ntz").alias("tpep_pickup_datetime"),
        F.col("id").alias("n"),
    )
    for month, kind in (("01", "double"), ("02", "long"), ("03", "int"), ("04", "double")):
        base.select("VendorID", "tpep_pickup_datetime", F.col("n").cast(kind).alias("passenger_count"), F.col("n").cast(kind).alias("RatecodeID")) \
            .coalesce(1).write.parquet(os.path.join(tmp_root, f"yellow_tripdata_2024-{month}.parquet"))
    got = files.read_trips(spark, os.path.join(tmp_root, "yellow_tripdata_*.parquet"))
    assert got.count() == 12
    assert sorted(r.PASSENGER_COUNT for r in got.collect()) == sorted([0.0, 1.0, 2.0] * 4)
    assert got.select("RATECODEID").distinct().count() == 3


def test_epoch_repair_at_both_edges(spark):
    from pyspark.sql import types as T

    from citylake.functions import columns as C

    rows = spark.createDataFrame([(k,) for k in (10**11, 10**11 + 1, 10**14, 10**14 + 1)], "e long")
    got = [str(r[0]) for r in rows.select(C.repair_epoch("e", T.LongType()).cast("string")).collect()]
    assert got[0].lstrip("+").startswith("5138") and got[1].startswith("1973-03-03")
    assert got[2].lstrip("+").startswith("5138") and got[3].startswith("1973-03-03")


def test_distinct_sample_matches_full_distinct(spark):
    from pyspark.sql import functions as F

    from citylake.operators.profile import distinct_sample

    df = spark.range(0, 40_000, numPartitions=7).select((F.col("id") % 1000).alias("v"))
    want = [r.v for r in df.select("v").distinct().orderBy("v").limit(300).collect()]
    assert [r.v for r in distinct_sample(df, ["v"], 300).collect()] == want
    small = spark.range(5).select(F.col("id").alias("v"))
    assert [r.v for r in distinct_sample(small, ["v"], 300).collect()] == [0, 1, 2, 3, 4]
