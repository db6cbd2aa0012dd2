"""Taxi trips: raw files -> typed and checked trips -> one row per day."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.functions.text import whole_number
from tidemark.operators.common import col
from tidemark.operators.quality import expect_or_drop

# The trip file's column types, the output names that differ, and the row rules.
SCHEMA_HINTS = "tpep_pickup_datetime TIMESTAMP, tpep_dropoff_datetime TIMESTAMP"
TRIP_COLUMNS = (
    ("VendorID", "vendor_id", "int"),
    ("RatecodeID", "rate_code_id", "int"),
    ("store_and_fwd_flag", "store_and_fwd_flag", None),
    ("PULocationID", "pu_location_id", "int"),
    ("DOLocationID", "do_location_id", "int"),
    ("payment_type", "payment_type", "int"),
    ("tpep_pickup_datetime", "tpep_pickup_datetime", "timestamp"),
    ("tpep_dropoff_datetime", "tpep_dropoff_datetime", "timestamp"),
    ("passenger_count", "passenger_count", "int"),
    ("trip_distance", "trip_distance", "double"),
    ("fare_amount", "fare_amount", "double"),
    ("extra", "extra", "double"),
    ("mta_tax", "mta_tax", "double"),
    ("tip_amount", "tip_amount", "double"),
    ("tolls_amount", "tolls_amount", "double"),
    ("improvement_surcharge", "improvement_surcharge", "double"),
    ("total_amount", "total_amount", "double"),
    ("congestion_surcharge", "congestion_surcharge", "double"),
)
TRIP_RULES = {
    "valid_pickup_datetime": "tpep_pickup_datetime IS NOT NULL",
    "valid_dropoff_datetime": "tpep_dropoff_datetime IS NOT NULL",
    "positive_fare_amount": "fare_amount > 0",
    "positive_passenger_count": "passenger_count > 0",
    "non_negative_trip_distance": "trip_distance >= 0",
    "valid_vendor_id": "vendor_id IS NOT NULL",
}


def raw_trips(files: DataFrame) -> DataFrame:
    """Bronze: the file columns as they are, stamped with the load time."""
    return files.withColumn("_ingested_at", F.current_timestamp())


def _typed(name: str, dtype: str | None, have: str) -> Column:
    if dtype is None:
        return col(name)
    if dtype == "int":
        return whole_number(col(name))
    if dtype == "timestamp" and have == "timestamp_ntz":
        return col(name)
    return col(name).try_cast(dtype)


def conform_trips(raw: DataFrame) -> DataFrame:
    """Snake-case names and fixed types. A value that does not convert becomes NULL for the rules to
    judge; it does not stop the stream."""
    have = dict(raw.dtypes)
    carried = [col(c) for c in ("_ingested_at",) if c in have]
    return raw.select(*[_typed(name, dtype, have[name]).alias(out) for name, out, dtype in TRIP_COLUMNS], *carried)


def clean_trips(raw: DataFrame) -> DataFrame:
    """Silver: conformed trips that pass every rule, stamped with the processing time."""
    return expect_or_drop(conform_trips(raw), TRIP_RULES).withColumn("_processed_at", F.current_timestamp())


def rounded_average(name: str, digits: int) -> Column:
    """Rounded mean of every value there is.

    Values are summed in decimals of six places - far finer than the result - so that the last digit does not
    change with the order of addition. A group with a value that no such decimal holds (NaN, infinity, 1e22 and
    more) has the plain mean; no value is left out of either.
    """
    value = col(name).cast("double")
    exact = value.try_cast("decimal(28,6)")
    all_exact = F.count(exact) == F.count(value)
    mean = F.round((F.sum(exact).cast("double") / F.count(exact)).try_cast("decimal(28,6)"), digits).cast("double")
    return F.when(all_exact, mean).otherwise(F.round(F.avg(value), digits))


def daily_summary(trips: DataFrame) -> DataFrame:
    """Gold: trips per pickup day with average fare, distance and passengers."""
    return trips.groupBy(F.to_date("tpep_pickup_datetime").alias("trip_date")).agg(
        F.count(F.lit(1)).alias("trip_count"),
        rounded_average("fare_amount", 2).alias("avg_fare_amount"),
        rounded_average("trip_distance", 3).alias("avg_trip_distance"),
        rounded_average("passenger_count", 2).alias("avg_passenger_count"),
    )
