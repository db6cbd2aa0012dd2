"""One function per registered query."""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from catalogue import fixtures as fx
from tidemark.functions.masks import register_masks
from tidemark.operators import protection
from tidemark.operators.common import END_AT, START_AT
from tidemark.operators.latest import dedupe_by_key
from tidemark.operators.pairing import change_feed as change_feed_of
from tidemark.operators.pairing import reconcile as reconcile_of
from tidemark.operators.pairing import reconcile_summary as reconcile_summary_of
from tidemark.operators.position import zip_rows as zip_rows_of
from tidemark.operators.quality import expect_or_drop, expectation_metrics, rejected_rows
from tidemark.operators.scd import current_dimension, fold_scd1, fold_scd2
from tidemark.operators.snapshots import fold_snapshots_scd2
from tidemark.plans import changes as feed_plan
from tidemark.plans import customers as customer_plan
from tidemark.plans import trips as trip_plan
from tidemark.session import new_work_folder
from tidemark.sinks.layout import DatasetSpec, write_dataset, write_json
from tidemark.sinks.paths import replace_file
from tidemark.sinks.snapshot_table import SnapshotTable
from tidemark.sources import synthetic
from tidemark.sources.files import files_written_for, ingest_json, read_csv, read_json, stream_table
from tidemark.sources.landing import append_csv, list_files
from tidemark.sources.schema_store import SchemaStore
from tidemark.sources.schemas import RESCUED, infer_schema, merge_schema_hints
from tidemark.streaming.append import run_append
from tidemark.streaming.change_tables import Scd1Table, Scd2Table, run_changes
from tidemark.streaming.family import TableSpec, run_cdc_family
from tidemark.streaming.family import family_metrics as family_metrics_of

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

FEED_KEYS = dict(
    keys=["id"],
    sequence_by="operation_date",
    delete_when=feed_plan.IS_DELETE,
    except_columns=["operation", "operation_date"],
)
ENVIRONMENT, SOURCE_NAME = "test", "orders"


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def _files(spark: SparkSession) -> int:
    """Landing files to write: enough to keep every core busy in each of two micro-batches."""
    return 2 * spark.sparkContext.defaultParallelism


def _clean(spark: SparkSession, folder: str) -> DataFrame:
    return feed_plan.clean_changes(fx.feed(spark, folder), rescued=False)


def _clean_sparse(spark: SparkSession, folder: str) -> DataFrame:
    return feed_plan.clean_changes(fx.sparse_feed(spark, folder), rescued=False)


# ----------------------------------------------------------------------------------- quality rules


@query
def expect_drop(spark, folder):
    return expect_or_drop(fx.feed(spark, folder), feed_plan.FEED_RULES)


@query
def expect_metrics(spark, folder):
    return expectation_metrics(fx.feed(spark, folder), feed_plan.FEED_RULES)


@query
def expect_rejected(spark, folder):
    failed = rejected_rows(fx.feed(spark, folder), feed_plan.FEED_RULES)
    return failed.withColumn("failed_rules", F.array_join("failed_rules", ","))


# ------------------------------------------------------------------------------------------- trips


@query
def trip_conform(spark, folder):
    return trip_plan.conform_trips(fx.trips(spark, folder))


@query
def trip_clean(spark, folder):
    return trip_plan.clean_trips(fx.trips(spark, folder)).drop("_processed_at")


@query
def trip_daily_summary(spark, folder):
    return trip_plan.daily_summary(trip_plan.clean_trips(fx.trips(spark, folder)))


@query
def trip_stream_medallion(spark, folder):
    """CSV files -> streamed bronze -> streamed silver -> batch gold."""
    work = new_work_folder(spark, "trips")
    raw = fx.trips(spark, folder, parts=_files(spark))
    gzip = {"compression": "gzip", "zlib.compress.level": "BEST_SPEED"}
    raw.write.options(header="true", **gzip).csv(f"{work}/landing")
    schema = merge_schema_hints(
        T.StructType([T.StructField(name, T.StringType()) for name, _, _ in trip_plan.TRIP_COLUMNS]),
        "tpep_pickup_datetime TIMESTAMP_NTZ, tpep_dropoff_datetime TIMESTAMP_NTZ, trip_distance DOUBLE, "
        "fare_amount DOUBLE, total_amount DOUBLE",
    )
    schema = T.StructType([schema[name] for name in raw.columns])
    append_csv(
        spark, f"{work}/landing", f"{work}/bronze", f"{work}/checkpoints/bronze", schema,
        glob="*.csv.gz", max_files_per_trigger=_files(spark) // 2, transform=trip_plan.raw_trips,
    )
    silver = trip_plan.clean_trips(stream_table(spark, f"{work}/bronze"))
    run_append(silver, f"{work}/silver", f"{work}/checkpoints/silver")
    return trip_plan.daily_summary(spark.read.parquet(f"{work}/silver"))


# --------------------------------------------------------------------------------- change capture


@query
def scd1(spark, folder):
    return fold_scd1(_clean(spark, folder), **FEED_KEYS)


def _mapped(spark: SparkSession, folder: str) -> DataFrame:
    """The feed with its fields as the entries of one MAP, in an order that changes from event to event."""
    feed = _clean(spark, folder)
    one, two = (F.lit("kind"), F.col("event_type")), (F.lit("props"), F.col("props"))
    ordered = F.when(F.col("event_type") == "click", F.create_map(*two, *one)).otherwise(F.create_map(*one, *two))
    return feed.select("id", "operation", "operation_date", ordered.alias("fields"))


@query
def scd1_map_payload(spark, folder):
    """Type 1 fold of events whose payload is a MAP."""
    rows = fold_scd1(_mapped(spark, folder), **FEED_KEYS)
    return rows.select("id", F.col("fields")["kind"].alias("event_type"), F.col("fields")["props"].alias("props"))


@query
def scd2_map_payload(spark, folder):
    """Type 2 fold of events whose payload is a MAP: a version for every event."""
    rows = fold_scd2(_mapped(spark, folder), **FEED_KEYS)
    fields = [F.col("fields")["kind"].alias("event_type"), F.col("fields")["props"].alias("props")]
    return rows.select("id", *fields, START_AT, END_AT)


@query
def scd1_ignore_nulls(spark, folder):
    return fold_scd1(_clean_sparse(spark, folder), ignore_null_updates=True, **FEED_KEYS)


@query
def scd2_events(spark, folder):
    return fold_scd2(_clean(spark, folder), **FEED_KEYS)


@query
def scd2_track_except(spark, folder):
    return fold_scd2(_clean(spark, folder), track_history_except=["value", "props"], **FEED_KEYS)


@query
def scd2_coalesced(spark, folder):
    """No tracking list, unchanged events merged all the same."""
    events = _clean(spark, folder).drop("value", "props")
    return fold_scd2(events, coalesce_unchanged=True, **FEED_KEYS)


@query
def scd2_ignore_nulls(spark, folder):
    return fold_scd2(_clean_sparse(spark, folder), ignore_null_updates=True, **FEED_KEYS)


@query
def scd2_ties(spark, folder):
    """Orders of a customer on one day share a sequence: the greatest (status, price, priority) counts."""
    orders = fx.table(spark, folder, "orders").drop("o_orderkey")
    return fold_scd2(
        orders.select("o_custkey", "o_orderstatus", "o_totalprice", "o_orderpriority", "o_orderdate"),
        ["o_custkey"],
        "o_orderdate",
        delete_when="o_orderpriority = '5-LOW'",
        except_columns=["o_orderdate"],
        track_history=["o_orderstatus"],
    )


@query
def scd2_current(spark, folder):
    return current_dimension(fold_scd2(_clean(spark, folder), track_history=["event_type"], **FEED_KEYS))


@query
def scd2_snapshot(spark, folder):
    """Snapshots applied one after another, as a pipeline run per snapshot would."""
    snapshots = fx.yearly_snapshots(spark, folder)
    years = sorted(row[0] for row in snapshots.select("snapshot_year").distinct().collect())
    one = {year: snapshots.where(F.col("snapshot_year") == year).drop("snapshot_year") for year in years}
    history = SnapshotTable(spark, new_work_folder(spark, "snapshots"), ["customer_id"], track_history=["status"])
    for step, year in enumerate(years):
        history.apply(one[year], F.lit(year), step)
    return history.read()


@query
def scd2_snapshot_history(spark, folder):
    """The same history from all the snapshots in one pass."""
    snapshots = fx.yearly_snapshots(spark, folder)
    return fold_snapshots_scd2(snapshots, ["customer_id"], "snapshot_year", track_history=["status"])


@query
def change_feed(spark, folder):
    return change_feed_of(*fx.period_states(spark, folder), ["customer_id", "priority"])


# -------------------------------------------------------------------------------------- customers


def _bronze(spark: SparkSession, folder: str) -> DataFrame:
    records = fx.customer_records(spark, folder)
    return customer_plan.bronze_customers(records, ENVIRONMENT, SOURCE_NAME, extra=["changed_at"])


def _normalized(spark: SparkSession, folder: str) -> DataFrame:
    return customer_plan.normalize_customers(_bronze(spark, folder), extra=["changed_at"])


def _history(spark: SparkSession, folder: str) -> DataFrame:
    return customer_plan.customer_history(
        _normalized(spark, folder), sequence_by="changed_at", except_columns=["changed_at"]
    )


@query
def normalize_customers(spark, folder):
    return _normalized(spark, folder).drop("ingestion_ts")


@query
def record_hash(spark, folder):
    return _normalized(spark, folder).select("customer_id", "changed_at", "record_hash").distinct()


@query
def customer_history(spark, folder):
    return _history(spark, folder).drop("ingestion_ts")


@query
def current_customers(spark, folder):
    return customer_plan.current_customers(_history(spark, folder))


@query
def geo_summary(spark, folder):
    return customer_plan.geography_summary(customer_plan.current_customers(_history(spark, folder)))


@query
def snapshot_customers(spark, folder):
    """Snapshot silver: one row per customer, the same on every run."""
    single = customer_plan.snapshot_customers(_bronze(spark, folder), ENVIRONMENT, SOURCE_NAME)
    return single.drop("snapshot_ts")


@query
def dedupe_orders(spark, folder):
    return dedupe_by_key(fx.table(spark, folder, "orders"), ["o_custkey"], ["o_orderdate", "o_orderkey"])


# ------------------------------------------------------------------------------------- protection


@query
def mask_columns(spark, folder):
    return protection.apply_column_masks(fx.contacts(spark, folder), fx.contact_masks(), groups=["analysts"])


@query
def mask_sql_functions(spark, folder):
    """The masks called from SQL text."""
    register_masks(spark)
    calls = ", ".join(f"{mask}({name}) AS {name}" for name, mask in fx.contact_masks().items())
    masked = spark.sql(f"SELECT customer_id, {calls}, country FROM {{c}}", c=fx.contacts(spark, folder))
    for name in set(fx.contact_masks().values()):  # the plan is analysed, so the session gets its names back
        spark.sql(f"DROP TEMPORARY FUNCTION IF EXISTS {name}")
    return masked


@query
def secured_view(spark, folder):
    masked = [protection.MaskedColumn(name, mask, ("analysts",)) for name, mask in fx.contact_masks().items()]
    return protection.secured_view(fx.contacts(spark, folder), masked, groups=["analysts"])


@query
def secured_view_admin(spark, folder):
    masked = [protection.MaskedColumn(name, mask, ("analysts",)) for name, mask in fx.contact_masks().items()]
    return protection.secured_view(fx.contacts(spark, folder), masked, groups=["admins"])


@query
def row_filter(spark, folder):
    """Grants come from a table: suppliers in debt name the countries the caller may see."""
    nation = fx.table(spark, folder, "nation")
    grants = (
        fx.table(spark, folder, "supplier")
        .where(F.col("s_acctbal") < 0)
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .select("n_name")
    )
    return protection.apply_row_filter(fx.contacts(spark, folder), "country", grants)


@query
def policy_masks(spark, folder):
    tags = {c: t for c, t in customer_plan.COLUMN_TAGS.items() if c not in ("first_name", "last_name", "state", "continent")}
    return protection.apply_policies(
        fx.contacts(spark, folder),
        customer_plan.TABLE_TAGS,
        tags,
        customer_plan.POLICIES,
        groups=["us_analysts"],
        allowed_values=["NATION_1", "NATION_2", "NATION_3"],
        governed_tags=customer_plan.GOVERNED_TAGS,
    )


@query
def policy_scope(spark, folder):
    """One policy holds for a whole catalog, one for a schema in it: of two tables with the same tags only one meets both."""
    policies = [
        protection.Policy("phones", "mask", ("pii_type", "phone"), "mask_phone", scope="main"),
        protection.Policy("emails", "mask", ("pii_type", "email"), "mask_email", scope="main.gold"),
        protection.Policy("names", "mask", ("pii_type", "name"), "mask_name", scope="other"),
    ]
    contacts = fx.contacts(spark, folder).select("customer_id", "email_address", "phone_number", "full_name")
    tags = {c: customer_plan.COLUMN_TAGS[c] for c in contacts.columns if c in customer_plan.COLUMN_TAGS}

    def seen(table: str) -> DataFrame:
        rows = protection.apply_policies(contacts, customer_plan.TABLE_TAGS, tags, policies, ["analysts"], table=table)
        return rows.withColumn("place", F.lit(table))

    return seen("main.gold.contacts").unionByName(seen("main.silver.contacts"))


def _audit(spark: SparkSession, folder: str) -> DataFrame:
    controls = [
        protection.Control("column_mask", name, f"MASK {name} WITH {mask}", mask=mask)
        for name, mask in fx.contact_masks().items()
    ]
    region = "country IN ('NATION_1', 'NATION_2', 'NATION_3')"
    controls.append(protection.Control("row_filter", "country", f"KEEP {region}", keep=region))
    return protection.protection_audit(fx.contacts(spark, folder), controls, "contacts")


@query
def protection_audit(spark, folder):
    return _audit(spark, folder).drop("execution_timestamp")


@query
def audit_summary(spark, folder):
    return protection.audit_summary(_audit(spark, folder))


# ------------------------------------------------------------------------- reconciliation, position


@query
def reconcile(spark, folder):
    before, after = fx.period_states(spark, folder)
    return reconcile_of(before, after, ["customer_id", "priority"])


@query
def reconcile_repeated_keys(spark, folder):
    """Rows are compared per customer as a multiset, although customers repeat on both sides."""
    before, after = fx.period_states(spark, folder)
    return reconcile_of(before, after, ["customer_id"], ["priority", "status"])


@query
def reconcile_summary(spark, folder):
    before, after = fx.period_states(spark, folder)
    return reconcile_summary_of(reconcile_of(before, after, ["customer_id", "priority"]))


@query
def zip_rows(spark, folder):
    part = fx.table(spark, folder, "part").select("p_name", "p_partkey")
    orders = fx.table(spark, folder, "orders").select("o_orderdate", "o_orderkey", "o_totalprice")
    return zip_rows_of(part, orders, ["p_name", "p_partkey"], ["o_orderdate", "o_orderkey"])


@query
def named_parameters(spark, folder):
    return spark.sql(
        "SELECT :catalog || '.' || :schema || '.' || o_orderpriority AS path, count(*) AS orders "
        "FROM {orders} GROUP BY o_orderpriority",
        args={"catalog": "main", "schema": "landing"},
        orders=fx.table(spark, folder, "orders"),
    )


# --------------------------------------------------------------------------- files and streams


def _write_feed(spark: SparkSession, folder: str, path: str, files: int) -> T.StructType:
    """The feed as JSON files, with event times as text as its producer writes them."""
    written = fx.feed(spark, folder).withColumn(
        "operation_date", F.date_format("operation_date", f"{synthetic.EVENT_TIME_FORMAT}.SSSSSS")
    )
    write_json(written, path, files)
    return written.schema


def _feed_time():
    parsed = F.try_to_timestamp(F.col("operation_date"), F.lit(f"{synthetic.EVENT_TIME_FORMAT}.SSSSSS"))
    return parsed.cast("timestamp_ntz")


def _stream_into(spark: SparkSession, folder: str, make: Callable[[str, dict], Scd1Table | Scd2Table], part="read"):
    """The feed streamed into a change table in several micro-batches."""
    work = new_work_folder(spark, "changes")
    schema = _write_feed(spark, folder, f"{work}/landing", 6)
    stream = ingest_json(spark, f"{work}/landing", schema, max_files_per_trigger=2)
    settings = dict(
        keys=["id"],
        sequence_by=_feed_time(),
        delete_when=feed_plan.IS_DELETE,
        except_columns=list(feed_plan.DROPPED_COLUMNS),
        buckets=8,
    )
    changes = make(f"{work}/table", settings)
    run_changes(feed_plan.clean_changes(stream), [changes], f"{work}/checkpoint")
    return getattr(changes, part)()


@query
def stream_scd1(spark, folder):
    return _stream_into(spark, folder, lambda root, settings: Scd1Table(spark, root, **settings))


@query
def stream_scd2(spark, folder):
    return _stream_into(
        spark, folder, lambda root, settings: Scd2Table(spark, root, track_history=["event_type"], **settings)
    )


@query
def stream_current(spark, folder):
    """The current rows of the streamed history, without reading the history."""
    return _stream_into(
        spark, folder, lambda root, settings: Scd2Table(spark, root, track_history=["event_type"], **settings), "current"
    )


@query
def cdc_family(spark, folder):
    """Two landing folders, each kept as a raw, a type 1 and a type 2 table."""
    work = new_work_folder(spark, "family")
    users = _write_feed(spark, folder, f"{work}/landing/users", 4)
    orders = fx.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"),
        F.when(F.col("o_orderpriority") == "1-URGENT", "DELETE").otherwise("UPDATE").alias("operation"),
        F.date_format("o_orderdate", f"{synthetic.EVENT_TIME_FORMAT}.SSSSSS").alias("operation_date"),
        "o_orderstatus",
    )
    write_json(orders, f"{work}/landing/orders", 3)
    rules = {**feed_plan.FEED_RULES, **feed_plan.RESCUE_RULE}
    options = dict(sequence_by=_feed_time(), rules=rules, table_options={"buckets": 4})
    specs = [
        TableSpec("users", schema=users, track_history_except=["value", "props"], **options),
        TableSpec("orders", schema_hints="id BIGINT", track_history_except=[], **options),
    ]
    applied = run_cdc_family(spark, f"{work}/landing", f"{work}/tables", specs, max_files_per_trigger=2)

    def lines(name: str, kind: str, start, end) -> DataFrame:
        rows = applied[name][kind].read()
        return rows.select(F.lit(f"{name}.{kind}").alias("target"), "id", start.alias("valid_from"), end.alias("valid_to"))

    none = F.lit(None).cast("timestamp_ntz")
    result = None
    for name in ("users", "orders"):
        both = lines(name, "scd1", none, none).unionByName(lines(name, "scd2", F.col(START_AT), F.col(END_AT)))
        result = both if result is None else result.unionByName(both)
    return result


@query
def family_metrics(spark, folder):
    """Rules counted over all batches of every table found under the landing root; one appears before the second run."""
    work = new_work_folder(spark, "metrics")
    _write_feed(spark, folder, f"{work}/landing/users", 3)
    orders = fx.table(spark, folder, "orders").select(
        F.col("o_custkey").alias("id"), F.lit("UPDATE").alias("operation"),
        F.date_format("o_orderdate", f"{synthetic.EVENT_TIME_FORMAT}.SSSSSS").alias("operation_date"),
    )
    default = TableSpec(
        "", sequence_by=_feed_time(), rules=feed_plan.FEED_RULES, schema_hints="id BIGINT", history=False, table_options={"buckets": 2}
    )
    for name in ("orders", "late"):
        write_json(orders, f"{work}/landing/{name}", 2)
        run_cdc_family(spark, f"{work}/landing", f"{work}/tables", default=default, max_files_per_trigger=2)
    found = family_metrics_of(spark, f"{work}/tables")
    return found.groupBy("name", "rule").agg(F.sum("passed").alias("passed"), F.sum("failed").alias("failed"))


@query
def customer_stream_history(spark, folder):
    """Incremental customer variant: appended source -> streamed bronze -> streamed silver -> type 2."""
    work = new_work_folder(spark, "customers")
    fx.customer_records(spark, folder).repartition(4).write.parquet(f"{work}/source")
    source = stream_table(spark, f"{work}/source", max_files_per_trigger=2)
    bronze = customer_plan.bronze_customers(source, ENVIRONMENT, SOURCE_NAME, extra=["changed_at"])
    run_append(bronze, f"{work}/bronze", f"{work}/checkpoints/bronze")
    files = files_written_for(spark, f"{work}/bronze", f"{work}/source", 4)
    silver = customer_plan.normalize_customers(
        stream_table(spark, f"{work}/bronze", max_files_per_trigger=files), extra=["changed_at"]
    )
    history = Scd2Table(
        spark,
        f"{work}/history",
        keys=["customer_id"],
        sequence_by="changed_at",
        except_columns=["changed_at"],
        track_history_except=list(customer_plan.STREAM_HISTORY_EXCEPT),
        buckets=8,
    )
    run_changes(silver, [history], f"{work}/checkpoints/history")
    return history.read().drop("ingestion_ts")


@query
def json_ingest_rescue(spark, folder):
    """Records that do not parse, or do not fit their type, are kept aside instead of stopping the run."""
    work = new_work_folder(spark, "rescue")
    events = fx.table(spark, folder, "events")
    rest = ["event_type", "value"]
    good = F.to_json(F.struct("event_id", "user_id", *rest))
    misfit = F.to_json(F.struct("event_id", F.concat(F.lit("u"), F.col("user_id")).alias("user_id"), *rest))
    broken = (
        F.when(F.col("event_type") == "view", F.substring(good, 1, 12))
        .when(F.col("event_type") == "error", misfit)
        .otherwise(good)
    )
    events.select(broken.alias("value")).write.text(f"{work}/landing")
    schema = T.StructType.fromDDL("event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE")
    parsed = read_json(spark, f"{work}/landing", schema)
    return parsed.withColumn("rescued", F.substring_index(RESCUED, ',"event_type"', 1)).drop(RESCUED)


@query
def csv_ingest(spark, folder):
    """Inferred types with hints; compressed files chosen by name; streamed to a table."""
    work = new_work_folder(spark, "csv")
    lineitem = fx.table(spark, folder, "lineitem")
    lineitem.repartition(_files(spark)).write.option("header", "true").option("compression", "gzip").csv(f"{work}/landing")
    inferred = infer_schema(spark, f"{work}/landing", "csv", pathGlobFilter="*.csv.gz")
    hints = "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_shipdate TIMESTAMP_NTZ"
    append_csv(
        spark, f"{work}/landing", f"{work}/table", f"{work}/checkpoint", merge_schema_hints(inferred, hints),
        glob="*.csv.gz", max_files_per_trigger=_files(spark) // 2,
    )
    return spark.read.parquet(f"{work}/table").drop("batch")


EVENT_FIELDS = "event_id BIGINT, user_id BIGINT, event_type STRING, value DOUBLE"


def _deliveries(spark, folder, landing: str) -> None:
    """The events as CSV whose headers differ: in order, in another order and case, with a column more, with one less."""
    events = fx.table(spark, folder, "events").withColumn("mark", F.col("event_id") % 7)
    kind = F.col("event_type")
    parts = [
        (~kind.isin("click", "view", "error"), ["event_id", "user_id", "event_type", "value"]),
        (kind == "click", [F.col("value").alias("VALUE"), "event_type", "event_id", "user_id"]),
        (kind == "view", ["event_id", "mark", "user_id", "event_type", "value"]),
        (kind == "error", ["user_id", "event_type", "event_id"]),
    ]
    for which, columns in parts:
        events.where(which).select(*columns).write.mode("append").option("header", "true").csv(landing)


@query
def csv_by_name(spark, folder):
    """Files with reordered, added and missing columns, in one batch."""
    work = new_work_folder(spark, "by-name")
    _deliveries(spark, folder, f"{work}/landing")
    return read_csv(spark, f"{work}/landing", T.StructType.fromDDL(EVENT_FIELDS))


@query
def csv_by_name_stream(spark, folder):
    """The same files as they arrive, with inferred types; columns no header has at first come to be inferred too."""
    work = new_work_folder(spark, "by-name-stream")
    _deliveries(spark, folder, f"{work}/landing")
    found = infer_schema(spark, f"{work}/landing", "csv")
    schema = merge_schema_hints(found, "event_id BIGINT, user_id BIGINT, mark BIGINT")
    append_csv(spark, f"{work}/landing", f"{work}/table", f"{work}/checkpoint", schema, max_files_per_trigger=_files(spark))
    return spark.read.parquet(f"{work}/table").select("event_id", "user_id", "event_type", "value", "mark", RESCUED)


@query
def file_ledger(spark, folder):
    """Files taken in once: one that is rewritten later is reported, and its rows are not read again."""
    work = new_work_folder(spark, "ledger")
    customers = fx.table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    for part in range(5):
        rows = customers.where(F.col("c_custkey") % 5 == part).coalesce(1)
        rows.write.option("header", "true").csv(f"{work}/landing/d{part}")
    taken = (spark, f"{work}/landing", f"{work}/table", f"{work}/checkpoint", customers.schema)
    append_csv(*taken, glob="*.csv")
    again = customers.where("c_custkey % 5 = 3").withColumn("c_acctbal", F.col("c_acctbal") + 1000000).coalesce(1)
    again.write.option("header", "true").csv(f"{work}/again")
    new, old = (list_files(spark, f"{work}/{name}", "*.csv").first().path for name in ("again", "landing/d3"))
    replace_file(spark, new, old)
    ledger = append_csv(*taken, glob="*.csv")
    files = ledger.compare(list_files(spark, f"{work}/landing", "*.csv"))
    files = files.select(F.regexp_extract("path", r"/d(\d)/", 1).cast("long").alias("delivery"), "status")
    table = spark.read.parquet(f"{work}/table").groupBy((F.col("c_custkey") % 5).alias("delivery"))
    return files.join(table.agg(F.count("*").alias("customers"), F.max("c_acctbal").alias("most")), "delivery")


@query
def json_nested_rescue(spark, folder):
    """Fields the schema has no place for, inside structs and inside lists of structs, in lines and in multi-line files."""
    work = new_work_folder(spark, "nested")
    events = fx.table(spark, folder, "events")
    line = F.struct(
        F.struct(F.col("event_id").alias("x"), F.col("user_id").alias("y")).alias("a"),
        F.array(
            F.struct(F.col("event_type").alias("k"), F.lit(None).cast("long").alias("z")),
            F.struct(F.col("event_type").alias("k"), (F.col("event_id") % 5).alias("z")),
        ).alias("items"),
    )
    listed = F.col("event_type") == "view"
    events.where(~listed).select(F.to_json(line).alias("value")).write.text(f"{work}/lines")
    groups = events.where(listed).groupBy((F.col("event_id") % 16).alias("g")).agg(F.collect_list(line).alias("all"))
    whole = groups.select("g", F.to_json("all", {"pretty": "true"}).alias("value"))
    whole.repartition("g").write.partitionBy("g").text(f"{work}/lists")
    schema = T.StructType.fromDDL("a STRUCT<x: BIGINT>, items ARRAY<STRUCT<k: STRING>>")
    both = read_json(spark, f"{work}/lines", schema).unionByName(read_json(spark, f"{work}/lists", schema, multiLine="true"))
    return both.select(
        F.col("a.x").alias("event_id"), F.size("items").alias("items"), F.col("items")[1]["k"].alias("kind"), F.col(RESCUED).alias("rescued")
    )


@query
def late_columns(spark, folder):
    """A column that arrives after the schema was inferred stays, as text, in the rescued column."""
    work = new_work_folder(spark, "late")
    events = fx.table(spark, folder, "events").select("event_id", "user_id", "event_type")
    later = F.col("event_type").isin("click", "view")
    events.where(~later).drop("event_type").write.json(f"{work}/landing")
    schema = infer_schema(spark, f"{work}/landing", "json")
    events.where(later).write.mode("append").json(f"{work}/landing")
    run_append(ingest_json(spark, f"{work}/landing", schema), f"{work}/table", f"{work}/checkpoint")
    return spark.read.parquet(f"{work}/table")


@query
def schema_evolution(spark, folder):
    """A later delivery brings a new column, found in its files alone; the stream goes on with the grown schema, and
    earlier records read as NULL in it."""
    work = new_work_folder(spark, "evolution")
    events = fx.table(spark, folder, "events").select("event_id", "user_id", "event_type", "value", "props")
    later = F.col("event_type").isin("click", "view")

    store = SchemaStore(spark, f"{work}/schema", "json")

    def deliver(rows: DataFrame) -> None:
        rows.write.mode("append").json(f"{work}/landing")
        store.grow(f"{work}/landing")
        run_append(ingest_json(spark, f"{work}/landing", store.schema(), rescue=False), f"{work}/table", f"{work}/checkpoint")

    deliver(events.where(~later).drop("props"))
    deliver(events.where(later))
    return spark.read.schema(store.schema()).parquet(f"{work}/table")


@query
def batch_csv(spark, folder):
    """A table written as CSV with a header and loaded in one batch by a given schema."""
    work = new_work_folder(spark, "batch-csv")
    supplier = fx.table(spark, folder, "supplier")
    supplier.write.option("header", "true").csv(f"{work}/files")
    return read_csv(spark, f"{work}/files", supplier.schema)


@query
def range_source(spark, folder):
    """As many generated row numbers as there are orders."""
    return synthetic.row_numbers(spark, fx.table(spark, folder, "orders").count())


@query
def local_rows(spark, folder):
    """A few local rows as a table, joined to a large one."""
    names = spark.createDataFrame([("1-URGENT", "now"), ("2-HIGH", "soon"), ("5-LOW", "later")], "code string, label string")
    orders = fx.table(spark, folder, "orders")
    # rows from Python have no size that Spark knows: unhinted, it would shuffle the large table by its few codes
    labelled = orders.join(F.broadcast(names), orders["o_orderpriority"] == names["code"])
    return labelled.groupBy("label").agg(F.count("*").alias("orders"))


@query
def top_orders(spark, folder):
    """The 25 dearest orders: a sort with a limit keeps 25 rows per task, not a sorted table."""
    orders = fx.table(spark, folder, "orders").select("o_orderkey", "o_totalprice")
    return orders.orderBy(F.col("o_totalprice").desc(), "o_orderkey").limit(25)


@query
def load_stamp(spark, folder):
    """Every raw trip carries a load time, one for the whole batch."""
    raw = trip_plan.raw_trips(fx.table(spark, folder, "lineitem"))
    stamp = F.col("_ingested_at")
    return raw.agg(F.count("*").alias("trips"), F.count(stamp).alias("stamped"), F.count_distinct(stamp).alias("stamps"))


@query
def clustered_write(spark, folder):
    work = new_work_folder(spark, "clustered")
    spec = DatasetSpec(name="", layer="gold", path=f"{work}/lineitem", cluster_by=["l_returnflag", "l_shipdate"])
    write_dataset(fx.table(spark, folder, "lineitem"), spec)
    return spark.read.parquet(f"{work}/lineitem")


@query
def dataset_properties(spark, folder):
    """A table written with a layer, a comment and properties, which are read back from the catalog."""
    name = f"priorities_{uuid.uuid4().hex}"
    orders = fx.table(spark, folder, "orders").groupBy("o_orderpriority").agg(F.count("*").alias("orders"))
    spec = DatasetSpec(name, "gold", "Orders by priority; it's counted", f"{new_work_folder(spark, 'spec')}", properties={"owner.team": "sales"})
    write_dataset(orders, spec)
    told = {row.key: row.value for row in spark.sql(f"SHOW TBLPROPERTIES `{name}`").collect()}
    rows = spark.table(name).select("o_orderpriority", "orders")
    comment = next(row.data_type for row in spark.sql(f"DESCRIBE TABLE EXTENDED `{name}`").collect() if row.col_name == "Comment")
    values = {"quality": told["quality"], "owner": told["owner.team"], "comment": comment}
    return rows.withColumns({column: F.lit(value) for column, value in values.items()})


@query
def generate_customer_changes(spark, folder):
    """Synthetic change events, one per event of the table, three to a customer."""
    numbers = fx.table(spark, folder, "events").select(F.col("event_id").alias("number"))
    return synthetic.customer_changes(numbers, changes_per_customer=3)


@query
def generate_transaction_changes(spark, folder):
    """Synthetic transactions, one per order, linked to synthetic customers."""
    numbers = fx.table(spark, folder, "orders").select(F.col("o_orderkey").alias("number"))
    return synthetic.transaction_changes(numbers, synthetic.customer_changes(numbers))


@query
def generated_feed_scd2(spark, folder):
    """The synthetic feed through the whole chain: rules, event time, type 2 history."""
    raw = generate_customer_changes(spark, folder).drop("number")
    timed = feed_plan.clean_changes(raw, rescued=False)
    timed = timed.withColumn("operation_date", feed_plan.event_time().cast("timestamp_ntz"))
    timed = expect_or_drop(timed, feed_plan.SEQUENCE_RULE)
    return fold_scd2(timed, ["id"], "operation_date", feed_plan.IS_DELETE, ["operation", "operation_date"])
