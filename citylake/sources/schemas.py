"""Explicit schemas for the bronze inputs."""

from __future__ import annotations

from pyspark.sql import types as T

_D, _I, _S, _TS = T.DoubleType(), T.IntegerType(), T.StringType(), T.TimestampNTZType()

# Bronze trip table contract: the 19 TLC columns plus two audit columns.
RAW_TRIPS_SCHEMA = T.StructType(
    [
        T.StructField("VENDORID", _I),
        T.StructField("TPEP_PICKUP_DATETIME", _TS),
        T.StructField("TPEP_DROPOFF_DATETIME", _TS),
        T.StructField("PASSENGER_COUNT", _D),
        T.StructField("TRIP_DISTANCE", _D),
        T.StructField("RATECODEID", _D),
        T.StructField("STORE_AND_FWD_FLAG", _S),
        T.StructField("PULOCATIONID", _I),
        T.StructField("DOLOCATIONID", _I),
        T.StructField("PAYMENT_TYPE", _I),
        T.StructField("FARE_AMOUNT", _D),
        T.StructField("EXTRA", _D),
        T.StructField("MTA_TAX", _D),
        T.StructField("TIP_AMOUNT", _D),
        T.StructField("TOLLS_AMOUNT", _D),
        T.StructField("IMPROVEMENT_SURCHARGE", _D),
        T.StructField("TOTAL_AMOUNT", _D),
        T.StructField("CONGESTION_SURCHARGE", _D),
        T.StructField("AIRPORT_FEE", _D),
        T.StructField("SOURCE_FILE", _S),
        T.StructField("LOADED_AT", _TS),
    ]
)

# Landed TLC file columns (audit columns are added on load). Integer ids are read
# as BIGINT, the widest type the monthly files use (INT32 columns widen on read), so
# months written with different integer widths scan together; parquet column names
# are matched case-insensitively (VendorID, Airport_fee, airport_fee).
TLC_FILE_SCHEMA = T.StructType(
    [
        T.StructField(f.name, T.LongType() if isinstance(f.dataType, T.IntegerType) else f.dataType)
        for f in RAW_TRIPS_SCHEMA.fields
        if f.name not in ("SOURCE_FILE", "LOADED_AT")
    ]
)

# TLC file names map to the bronze names by upper-casing (VendorID -> VENDORID,
# Airport_fee / airport_fee -> AIRPORT_FEE), so no explicit rename table is needed.
TRIP_SOURCE_COLUMNS: dict[str, str] = {}

WEATHER_JSON_SCHEMA = T.StructType(
    [
        T.StructField(
            "hourly",
            T.StructType(
                [
                    T.StructField("time", T.ArrayType(_S)),
                    T.StructField("temperature_2m", T.ArrayType(_D)),
                    T.StructField("precipitation", T.ArrayType(_D)),
                    T.StructField("snowfall", T.ArrayType(_D)),
                    T.StructField("windspeed_10m", T.ArrayType(_D)),
                    T.StructField("weathercode", T.ArrayType(T.LongType())),
                ]
            ),
        )
    ]
)

RAW_WEATHER_SCHEMA = T.StructType(
    [
        T.StructField("TIME", _S),
        T.StructField("TEMPERATURE_2M", _D),
        T.StructField("PRECIPITATION", _D),
        T.StructField("SNOWFALL", _D),
        T.StructField("WINDSPEED_10M", _D),
        T.StructField("WEATHERCODE", T.LongType()),
        T.StructField("SOURCE_URL", _S),
        T.StructField("LOADED_AT", _S),
    ]
)

ZONE_CSV_SCHEMA = T.StructType(
    [
        T.StructField("LocationID", _I),
        T.StructField("Borough", _S),
        T.StructField("Zone", _S),
        T.StructField("service_zone", _S),
    ]
)
