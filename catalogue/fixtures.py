"""Inputs derived from the given tables, once as DataFrames and once as SQL with the same meaning."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame, SparkSession, functions as F


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


# ------------------------------------------------------------------------------------- change feed


def feed(spark: SparkSession, folder: str) -> DataFrame:
    """`events` as a change feed of users, with planted defects: some ids and operations are NULL."""
    operation = (
        F.when(F.col("event_id") % 101 == 0, F.lit(None))
        .when(F.col("event_type") == "signup", "APPEND")
        .when(F.col("event_type") == "error", "DELETE")
        .otherwise("UPDATE")
    )
    return table(spark, folder, "events").select(
        F.when(F.col("event_id") % 50 != 0, F.col("user_id")).alias("id"),
        operation.alias("operation"),
        F.col("ts").alias("operation_date"),
        "event_type",
        "value",
        "props",
    )


def sparse_feed(spark: SparkSession, folder: str) -> DataFrame:
    """The feed with NULLs for "unchanged": no value on clicks, no properties on views."""
    return feed(spark, folder).select(
        "id",
        "operation",
        "operation_date",
        "event_type",
        F.when(F.col("event_type") != "click", F.col("value")).alias("value"),
        F.when(F.col("event_type") != "view", F.col("props")).alias("props"),
    )


# ------------------------------------------------------------------------------------------- trips


def trips(spark: SparkSession, folder: str, parts: int | None = None) -> DataFrame:
    """`lineitem` as raw trips: numbers and times arrive as text, and some do not convert.

    With `parts`, rows are dealt evenly to so many partitions, as the table has them: texts are made behind the shuffle.
    """
    text = lambda c: F.col(c).cast("string")
    odd = F.when(F.col("l_returnflag") == "R", F.lit("n/a"))
    rows = table(spark, folder, "lineitem")
    return (rows.repartition(parts) if parts else rows).select(
        F.coalesce(F.when(F.col("l_linenumber") == 7, F.lit("unknown")), text("l_suppkey")).alias("VendorID"),
        text("l_linenumber").alias("RatecodeID"),
        F.col("l_linestatus").alias("store_and_fwd_flag"),
        text("l_partkey").alias("PULocationID"),
        text("l_suppkey").alias("DOLocationID"),
        F.coalesce(odd, text("l_linenumber")).alias("payment_type"),
        F.col("l_shipdate").alias("tpep_pickup_datetime"),
        F.when(F.col("l_tax") > 0, F.col("l_shipdate")).alias("tpep_dropoff_datetime"),
        text("l_quantity").alias("passenger_count"),
        text("l_discount").alias("trip_distance"),
        (F.col("l_extendedprice") - 5000).alias("fare_amount"),
        F.col("l_tax").alias("extra"),
        F.col("l_tax").alias("mta_tax"),
        F.col("l_discount").alias("tip_amount"),
        F.col("l_discount").alias("tolls_amount"),
        F.col("l_tax").alias("improvement_surcharge"),
        F.col("l_extendedprice").alias("total_amount"),
        F.col("l_discount").alias("congestion_surcharge"),
    )


# --------------------------------------------------------------------------------------- customers


def customer_records(spark: SparkSession, folder: str) -> DataFrame:
    """The customer's record as of each order, in untidy text; `changed_at` orders the records."""
    orders = table(spark, folder, "orders")
    customer = table(spark, folder, "customer")
    nation = table(spark, folder, "nation")
    region = table(spark, folder, "region")
    key = F.col("c_custkey").cast("string")
    wide = (
        orders.join(customer, F.col("o_custkey") == F.col("c_custkey"))
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
    )
    return wide.select(
        F.when(F.col("o_orderstatus") != "P", F.col("c_custkey")).alias("customerID"),
        F.concat(F.lit("  First"), key, F.lit(" ")).alias("first_name"),
        F.when(F.col("c_mktsegment") != "MACHINERY", F.concat(F.lit(" Last"), key)).alias("last_name"),
        F.concat(F.lit(" User"), key, F.lit("@Mail.Example.COM ")).alias("email_address"),
        F.concat(F.lit("555-123-"), F.lpad(key, 4, "0")).alias("phone_number"),
        F.concat(key, F.lit(" Main Street ")).alias("address"),
        F.concat(F.lit(" old "), F.col("o_orderpriority"), F.lit(" TOWN ")).alias("city"),
        F.concat(F.lower("c_mktsegment"), F.lit(" ")).alias("state"),
        F.concat(F.lit(" "), F.col("n_name")).alias("country"),
        F.col("r_name").alias("continent"),
        (F.col("c_custkey") + 10000).alias("postal_zip_code"),
        F.when(F.col("c_acctbal") > 0, F.lit(" F ")).otherwise("m").alias("gender"),
        F.col("o_orderdate").alias("changed_at"),
    )


# --------------------------------------------------------------------------------------- snapshots


def yearly_snapshots(spark: SparkSession, folder: str) -> DataFrame:
    """One snapshot per year of the customers who ordered in it: the state of their last order."""
    last = F.max(F.struct("o_orderdate", "o_orderkey", "o_orderstatus", "o_orderpriority", "o_totalprice"))
    return (
        table(spark, folder, "orders")
        .groupBy(F.col("o_custkey").alias("customer_id"), F.year("o_orderdate").alias("snapshot_year"))
        .agg(last.alias("o"))
        .select(
            "customer_id",
            "snapshot_year",
            F.col("o.o_orderstatus").alias("status"),
            F.col("o.o_orderpriority").alias("priority"),
            F.col("o.o_totalprice").alias("last_price"),
        )
    )


def period_states(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """(before, after): the state of each customer's orders up to 1997, and from 1998 on."""
    orders = table(spark, folder, "orders")
    early = F.year("o_orderdate") <= 1997

    def state(part: DataFrame) -> DataFrame:
        return part.groupBy(F.col("o_custkey").alias("customer_id"), F.col("o_orderpriority").alias("priority")).agg(
            F.max("o_orderstatus").alias("status"), F.count(F.lit(1)).alias("orders")
        )

    return state(orders.where(early)), state(orders.where(~early))


def contact_masks() -> dict[str, str]:
    return {
        "email_address": "mask_email",
        "phone_number": "mask_phone",
        "full_name": "mask_name",
        "address": "mask_address",
        "postal_zip_code": "mask_postal_code",
    }


def contacts(spark: SparkSession, folder: str) -> DataFrame:
    """Contact fields per customer, with the shapes that masks treat differently."""
    key = F.col("c_custkey").cast("string")
    segment = F.col("c_mktsegment")
    email = (
        F.when(segment == "MACHINERY", F.concat(F.lit("user"), key))
        .when(segment == "FURNITURE", F.concat(F.lit("a@b@"), key))
        .when(segment == "BUILDING", F.lit(None))
        .otherwise(F.concat(F.lit("user"), key, F.lit("@example.com")))
    )
    return (
        table(spark, folder, "customer")
        .join(table(spark, folder, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))
        .select(
            F.col("c_custkey").alias("customer_id"),
            email.alias("email_address"),
            F.when(segment == "HOUSEHOLD", F.right(key, F.lit(3))).otherwise(F.concat(F.lit("555-"), key)).alias(
                "phone_number"
            ),
            F.when(segment == "BUILDING", F.lit("")).otherwise(F.col("c_name")).alias("full_name"),
            F.when(segment != "HOUSEHOLD", F.concat(key, F.lit(" Main Street"))).alias("address"),
            key.alias("postal_zip_code"),
            F.col("n_name").alias("country"),
        )
    )


# --------------------------------------------------------------------------------------- SQL views

VIEWS = {
    "feed": """
        SELECT CASE WHEN event_id % 50 <> 0 THEN user_id END AS id,
               CASE WHEN event_id % 101 = 0 THEN NULL WHEN event_type = 'signup' THEN 'APPEND'
                    WHEN event_type = 'error' THEN 'DELETE' ELSE 'UPDATE' END AS operation,
               ts AS operation_date, event_type, value, props
        FROM events""",
    "clean": "SELECT * FROM {feed} WHERE id IS NOT NULL AND operation IN ('APPEND', 'DELETE', 'UPDATE')",
    "sparse": """
        SELECT id, operation, operation_date, event_type,
               CASE WHEN event_type <> 'click' THEN value END AS value,
               CASE WHEN event_type <> 'view' THEN props END AS props
        FROM {clean}""",
    "sparse_filled": """
        SELECT id, operation_date, operation = 'DELETE' AS gone,
               last_value(event_type IGNORE NULLS) OVER w AS event_type,
               last_value(value IGNORE NULLS) OVER w AS value,
               last_value(props IGNORE NULLS) OVER w AS props
        FROM (SELECT id, operation, operation_date, deletes,
                     CASE WHEN operation <> 'DELETE' THEN event_type END AS event_type,
                     CASE WHEN operation <> 'DELETE' THEN value END AS value,
                     CASE WHEN operation <> 'DELETE' THEN props END AS props
              FROM (SELECT *, sum(CASE WHEN operation = 'DELETE' THEN 1 ELSE 0 END)
                              OVER (PARTITION BY id ORDER BY operation_date) AS deletes FROM {sparse}))
        WINDOW w AS (PARTITION BY id, deletes ORDER BY operation_date
                     ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "trips": """
        SELECT CASE WHEN l_linenumber <> 7 THEN l_suppkey END AS vendor_id, l_linenumber AS rate_code_id,
               l_linestatus AS store_and_fwd_flag, l_partkey AS pu_location_id, l_suppkey AS do_location_id,
               CASE WHEN l_returnflag <> 'R' THEN l_linenumber END AS payment_type,
               l_shipdate AS tpep_pickup_datetime,
               CASE WHEN l_tax > 0 THEN l_shipdate END AS tpep_dropoff_datetime,
               l_quantity AS passenger_count, l_discount AS trip_distance, l_extendedprice - 5000 AS fare_amount,
               l_tax AS extra, l_tax AS mta_tax, l_discount AS tip_amount, l_discount AS tolls_amount,
               l_tax AS improvement_surcharge, l_extendedprice AS total_amount,
               l_discount AS congestion_surcharge
        FROM lineitem""",
    "clean_trips": """
        SELECT * FROM {trips}
        WHERE tpep_pickup_datetime IS NOT NULL AND tpep_dropoff_datetime IS NOT NULL AND fare_amount > 0
          AND passenger_count > 0 AND trip_distance >= 0 AND vendor_id IS NOT NULL""",
    "records": """
        SELECT CASE WHEN o_orderstatus <> 'P' THEN c_custkey END AS customer_id,
               'First' || c_custkey AS first_name,
               CASE WHEN c_mktsegment <> 'MACHINERY' THEN 'Last' || c_custkey END AS last_name,
               'user' || c_custkey || '@mail.example.com' AS email_address,
               '555-123-' || lpad(CAST(c_custkey AS VARCHAR), 4, '0') AS phone_number,
               c_custkey || ' Main Street' AS address,
               array_to_string(list_transform(string_split('old ' || lower(o_orderpriority) || ' town', ' '),
                               lambda w: upper(w[1]) || w[2:]), ' ') AS city,
               upper(c_mktsegment) AS state, n_name AS country, r_name AS continent,
               CAST(c_custkey + 10000 AS VARCHAR) AS postal_zip_code,
               CASE WHEN c_acctbal > 0 THEN 'f' ELSE 'm' END AS gender, o_orderdate AS changed_at
        FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey
        JOIN region ON n_regionkey = r_regionkey""",
    "normalized": """
        SELECT customer_id, first_name, last_name, email_address, phone_number, address, city, state, country,
               continent, postal_zip_code, gender, changed_at,
               concat_ws(' ', first_name, last_name) AS full_name,
               sha256(concat_ws('||', CAST(customer_id AS VARCHAR), first_name, coalesce(last_name, ''),
                      concat_ws(' ', first_name, last_name), email_address, phone_number, address, city, state,
                      country, continent, postal_zip_code, gender)) AS record_hash
        FROM {records} WHERE customer_id IS NOT NULL""",
    "customer_events": """
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY customer_id, changed_at ORDER BY city DESC) AS rn
                       FROM {normalized}) WHERE rn = 1""",
    "customer_islands": """
        SELECT *, sum(opens) OVER (PARTITION BY customer_id ORDER BY changed_at) AS island
        FROM (SELECT *, CASE WHEN lag(record_hash) OVER w IS NOT DISTINCT FROM record_hash THEN 0 ELSE 1 END AS opens
              FROM {customer_events} WINDOW w AS (PARTITION BY customer_id ORDER BY changed_at))""",
    "customer_history": """
        SELECT *, lead(started) OVER (PARTITION BY customer_id ORDER BY started) AS ended
        FROM (SELECT customer_id, first_name, last_name, full_name, email_address, phone_number, address, city, state,
                     country, continent, postal_zip_code, gender, record_hash, min(changed_at) AS started
              FROM {customer_islands} GROUP BY ALL_BUT_ISLAND)""",
    "yearly": """
        SELECT o_custkey AS customer_id, year(o_orderdate) AS snapshot_year, o_orderstatus AS status,
               o_orderpriority AS priority, o_totalprice AS last_price
        FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey, year(o_orderdate)
                                           ORDER BY o_orderdate DESC, o_orderkey DESC) AS rn FROM orders)
        WHERE rn = 1""",
    "yearly_history": """
        SELECT customer_id, last(status ORDER BY snapshot_year) AS status,
               last(priority ORDER BY snapshot_year) AS priority,
               last(last_price ORDER BY snapshot_year) AS last_price,
               CAST(min(snapshot_year) AS INTEGER) AS "__START_AT",
               CAST(CASE WHEN max(snapshot_year) < (SELECT max(snapshot_year) FROM {yearly})
                         THEN max(snapshot_year) + 1 END AS INTEGER) AS "__END_AT"
        FROM (SELECT *, sum(opens) OVER (PARTITION BY customer_id ORDER BY snapshot_year) AS island
              FROM (SELECT *, CASE WHEN lag(snapshot_year) OVER w = snapshot_year - 1 AND lag(status) OVER w = status
                                   THEN 0 ELSE 1 END AS opens
                    FROM {yearly} WINDOW w AS (PARTITION BY customer_id ORDER BY snapshot_year)))
        GROUP BY customer_id, island""",
    "before": """
        SELECT o_custkey AS customer_id, o_orderpriority AS priority, max(o_orderstatus) AS status, count(*) AS orders
        FROM orders WHERE year(o_orderdate) <= 1997 GROUP BY 1, 2""",
    "after": """
        SELECT o_custkey AS customer_id, o_orderpriority AS priority, max(o_orderstatus) AS status, count(*) AS orders
        FROM orders WHERE year(o_orderdate) > 1997 GROUP BY 1, 2""",
    "contacts": """
        SELECT c_custkey AS customer_id,
               CASE c_mktsegment WHEN 'MACHINERY' THEN 'user' || c_custkey WHEN 'FURNITURE' THEN 'a@b@' || c_custkey
                    WHEN 'BUILDING' THEN NULL ELSE 'user' || c_custkey || '@example.com' END AS email_address,
               CASE WHEN c_mktsegment = 'HOUSEHOLD' THEN right(CAST(c_custkey AS VARCHAR), 3)
                    ELSE '555-' || c_custkey END AS phone_number,
               CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_name END AS full_name,
               CASE WHEN c_mktsegment <> 'HOUSEHOLD' THEN c_custkey || ' Main Street' END AS address,
               CAST(c_custkey AS VARCHAR) AS postal_zip_code, n_name AS country
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    "masked": """
        SELECT customer_id,
               CASE WHEN email_address IS NULL THEN NULL
                    WHEN len(string_split(email_address, '@')) = 2 THEN '****@' || split_part(email_address, '@', 2)
                    ELSE '****' END AS email_address,
               CASE WHEN phone_number IS NULL THEN NULL WHEN length(phone_number) >= 4
                    THEN 'XXX-XXX-' || right(phone_number, 4) ELSE 'XXX-XXX-XXXX' END AS phone_number,
               CASE WHEN full_name IS NULL THEN NULL WHEN length(full_name) > 0 THEN left(full_name, 1) || '****'
                    ELSE '****' END AS full_name,
               CASE WHEN address IS NOT NULL THEN '****' END AS address,
               CASE WHEN postal_zip_code IS NULL THEN NULL WHEN length(postal_zip_code) > 3
                    THEN left(postal_zip_code, 3) || '***' ELSE '****' END AS postal_zip_code,
               country
        FROM {contacts}""",
}
_COLUMNS = (
    "customer_id, first_name, last_name, full_name, email_address, phone_number, address, city, state, country, "
    "continent, postal_zip_code, gender, record_hash, island"
)


def expand(text: str) -> str:
    """Put the views in place of their {names}."""
    while match := re.search(r"\{(\w+)\}", text):
        text = text.replace(match.group(0), f"({VIEWS[match.group(1)]})")
    return text.replace("ALL_BUT_ISLAND", _COLUMNS).strip()
