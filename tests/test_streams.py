"""Streamed tables equal the batch fold, for any split, order, replay and schedule of rewrites."""

import random
import re

import pytest
from helpers import COLUMNS, COMMON, random_events, rows
from pyspark.sql import functions as F, types as T

from tidemark.operators.quality import expect_or_drop, observe_expectations
from tidemark.operators.scd import fold_scd1, fold_scd2
from tidemark.sinks.batch_folders import bucket_of
from tidemark.sinks.layout import write_json
from tidemark.sinks.paths import child_files
from tidemark.sources.files import ingest_json, read_json, stream_table
from tidemark.sources.landing import append_csv
from tidemark.sources.schemas import RESCUED, with_rescue
from tidemark.streaming import change_tables
from tidemark.streaming.append import run_append
from tidemark.streaming.change_tables import Scd1Table, Scd2Table, limits_of, run_changes
from tidemark.streaming.family import TableSpec, list_tables, run_cdc_family


def batches_of(events, seed, in_order):
    draw = random.Random(seed)
    events = sorted(events, key=lambda e: e[4]) if in_order else list(events)
    cuts = sorted(draw.sample(range(1, len(events)), 2))
    return [events[a:b] for a, b in zip([0, *cuts], [*cuts, len(events)])]


def fill(spark, table, batches):
    for number, batch in enumerate(batches):
        df = spark.createDataFrame(batch, COLUMNS)
        table.apply(df, number)
        table.apply(df, number)  # a replay of a published batch changes nothing
    return table


@pytest.mark.parametrize("ignore_nulls", [False, True])
def test_scd1_table(spark, tmp_path, ignore_nulls):
    events = random_events(3, count=200)
    table = Scd1Table(
        spark, f"{tmp_path}/t", buckets=3, compact_every=2, ignore_null_updates=ignore_nulls, **COMMON
    )
    fill(spark, table, batches_of(events, 1, in_order=False))
    assert len(table.store.folders()["state"]) < 3
    expected = fold_scd1(spark.createDataFrame(events, COLUMNS), ignore_null_updates=ignore_nulls, **COMMON)
    assert rows(table.read()) == rows(expected)


@pytest.mark.parametrize(
    "in_order,tracked,ignore_nulls,hot_rows",
    [
        (False, ["name"], False, 10),
        (False, None, False, 1_000_000),
        (True, ["name", "note"], False, 1_000_000),
        (False, ["name"], True, 10),
    ],
)
def test_scd2_table(spark, tmp_path, in_order, tracked, ignore_nulls, hot_rows):
    events = random_events(5, count=240, hot_share=0.6)
    table = Scd2Table(
        spark,
        f"{tmp_path}/t",
        buckets=3,
        compact_every=2,
        track_history=tracked,
        ignore_null_updates=ignore_nulls,
        hot_rows=hot_rows,
        **COMMON,
    )
    seen = []
    for number, batch in enumerate(batches_of(events, 2, in_order)):
        seen += batch
        table.apply(spark.createDataFrame(batch, COLUMNS), number)
    expected = fold_scd2(
        spark.createDataFrame(seen, COLUMNS), track_history=tracked, ignore_null_updates=ignore_nulls, **COMMON
    )
    assert rows(table.read()) == rows(expected)


def test_unpublished_step_is_redone_and_strange_checkpoint_refused(spark, tmp_path):
    first, second = batches_of(random_events(9, count=60, copies=0), 3, True)[:2]
    table = Scd2Table(spark, f"{tmp_path}/t", buckets=2, track_history=["name"], **COMMON)
    table.apply(spark.createDataFrame(first, COLUMNS), 0)
    # a crash after writing, before publishing, leaves folders that no pointer names
    stray = spark.createDataFrame([(1, "stray", "s", "APPEND", 5)], COLUMNS)
    publish, table.store.publish = table.store.publish, lambda *a: None
    table.apply(stray, 1)
    table.store.publish = publish
    expected = fold_scd2(spark.createDataFrame(first, COLUMNS), track_history=["name"], **COMMON)
    assert rows(table.read()) == rows(expected)
    table.apply(spark.createDataFrame(second, COLUMNS), 1)
    both = fold_scd2(spark.createDataFrame(first + second, COLUMNS), track_history=["name"], **COMMON)
    assert rows(table.read()) == rows(both)
    with pytest.raises(ValueError, match="checkpoint"):
        table.apply(stray, 0)


def test_new_columns_and_empty_batches(spark, tmp_path):
    table = Scd2Table(spark, f"{tmp_path}/t", buckets=2, **COMMON)
    table.apply(spark.createDataFrame([(1, "a", "x", "APPEND", 1)], COLUMNS), 0)
    table.apply(spark.createDataFrame([], COLUMNS), 1)
    table.apply(spark.createDataFrame([(9, "a", "x", "DELETE", 1)], COLUMNS), 2)
    wider = spark.createDataFrame([(1, "a", "x", "UPDATE", 2, 7)], COLUMNS + ", extra int")
    table.apply(wider, 3)
    got = table.read().select("id", "name", "extra", "__START_AT", "__END_AT")
    assert rows(got) == [(1, "a", 7, 2, None), (1, "a", None, 1, 2)]
    one = Scd1Table(spark, f"{tmp_path}/one", buckets=2, **COMMON)
    one.apply(spark.createDataFrame([(1, "a", "x", "APPEND", 1), (2, "b", "y", "APPEND", 1)], COLUMNS), 0)
    one.apply(wider, 1)
    assert rows(one.read()) == [(1, "a", "x", 7), (2, "b", "y", None)]


def test_in_order_batches_do_not_read_the_log(spark, tmp_path):
    """Late keys alone go back to the event log and the stored versions."""
    table = Scd2Table(spark, f"{tmp_path}/t", buckets=2, track_history=["name"], **COMMON)
    read, seen = table.store.read, []

    def watched(part, folders, buckets=None):
        seen.append((part, len(folders)))
        return read(part, folders, buckets)

    table.store.read = watched
    table.apply(spark.createDataFrame([(k, "a", "x", "APPEND", 1) for k in range(5)], COLUMNS), 0)
    table.apply(spark.createDataFrame([(k, "a", "y", "UPDATE", 5) for k in range(5)], COLUMNS), 1)
    table.apply(spark.createDataFrame([(1, None, None, "DELETE", 6), (7, "n", "n", "DELETE", 9)], COLUMNS), 2)
    assert {count for part, count in seen if part in ("events", "versions")} == {1}
    seen.clear()
    late = [(2, "b", "z", "UPDATE", 3), (7, "n", "n", "APPEND", 8), (1, "c", "w", "APPEND", 7)]
    table.apply(spark.createDataFrame(late, COLUMNS), 3)
    assert ("events", 4) in seen and ("versions", 3) in seen
    table.store.read = read
    assert rows(table.read()) == sorted(
        [
            (0, "a", "y", 1, None),
            (1, "a", "y", 1, 6),
            (1, "c", "w", 7, None),
            (2, "a", "x", 1, 3),
            (2, "b", "z", 3, 5),
            (2, "a", "y", 5, None),
            (3, "a", "y", 1, None),
            (4, "a", "y", 1, None),
            (7, "n", "n", 8, 9),
        ],
        key=repr,
    )


def scans_of(df):
    """Partition filters and pushed filters of the parquet scans of a plan."""
    df.sparkSession.conf.set("spark.sql.maxMetadataStringLength", "10000")
    plan = df._jdf.queryExecution().executedPlan().toString()
    df.sparkSession.conf.unset("spark.sql.maxMetadataStringLength")
    return re.findall(r"PartitionFilters: \[(.*?)\], PushedFilters: \[(.*?)\]", plan)


def test_late_events_read_their_buckets_and_limits_only(spark, tmp_path):
    table = Scd2Table(spark, f"{tmp_path}/t", buckets=8, **COMMON)
    for step in range(4):
        events = [(k, f"n{step}", "x", "UPDATE", 100 * step + k) for k in range(40)]
        table.apply(spark.createDataFrame(events, COLUMNS), step)
    read, seen = table.store.read, []

    def watched(part, folders, buckets=None):
        seen.append((part, len(folders), buckets))
        return read(part, folders, buckets)

    table.store.read = watched
    batch = [(k, "last", "y", "UPDATE", 1000 + k) for k in range(40) if k != 7] + [(7, "late", "z", "UPDATE", 150)]
    table.apply(spark.createDataFrame(batch, COLUMNS), 4)
    own = spark.createDataFrame([(7,)], "id int").select(bucket_of(["id"], 8)).first()[0]
    assert [b for part, n, b in seen if part in ("events", "versions") and n > 1] == [[own], [own]]
    late = spark.createDataFrame([(7, 107, 207)], "id int, _low int, _high int")
    table.store.read = read
    limits = limits_of(late, {"id": "id", "_seq": "_low"}, {"id": "id", "_seq": "_high"})
    stretch = table.store.read("events", table.store.folders()["events"], [own]).where(limits)
    (partitions, pushed), *_ = scans_of(stretch)
    assert "_bucket" in partitions
    assert all(f in pushed for f in ("GreaterThanOrEqual(id,7)", "LessThanOrEqual(id,7)", "GreaterThanOrEqual(_seq,107)", "LessThanOrEqual(_seq,207)"))
    assert sorted(r._seq for r in stretch.collect()) == [107, 150, 207]
    kept = [(r.name, r["__START_AT"], r["__END_AT"]) for r in table.read().where("id = 7").orderBy("__START_AT").collect()]
    assert kept == [("n0", 7, 107), ("n1", 107, 150), ("late", 150, 207), ("n2", 207, 307), ("n3", 307, None)]


def test_limits_leave_out_nulls_and_odd_types(spark):
    rows = spark.createDataFrame([(1, None, 2.5, "a"), (3, 4, 1.5, "b")], "k int, n int, d double, s string")
    table = spark.createDataFrame([(i, i, float(i), chr(96 + i)) for i in range(1, 6)], rows.schema)
    every = {name: name for name in rows.columns}
    assert [r.k for r in table.where(limits_of(rows, every, {})).orderBy("k").collect()] == [1, 2, 3, 4, 5]
    assert [r.k for r in table.where(limits_of(rows, every, every)).orderBy("k").collect()] == [1, 2]
    assert table.where(limits_of(rows.limit(0), every, every)).count() == 5


@pytest.mark.parametrize("ignore_nulls", [False, True])
def test_rewrites_change_nothing_and_old_folders_go(spark, tmp_path, ignore_nulls):
    events = random_events(17, count=150)
    batches = batches_of(events, 4, in_order=False)
    table = Scd2Table(spark, f"{tmp_path}/t", buckets=2, ignore_null_updates=ignore_nulls, **COMMON)
    for number, batch in enumerate(batches[:2]):
        table.apply(spark.createDataFrame(batch, COLUMNS), number)
    before, current = rows(table.read()), rows(table.current())
    table.compact()
    assert {part: len(f) for part, f in table.store.folders().items()} == {"events": 1, "versions": 1, "heads": 1}
    assert rows(table.read()) == before and rows(table.current()) == current and table.store.last_step() == 1
    table.compact()  # nothing left to rewrite
    assert rows(table.read()) == before
    table.apply(spark.createDataFrame(batches[2], COLUMNS), 2)
    assert rows(table.read()) == rows(fold_scd2(spark.createDataFrame(events, COLUMNS), ignore_null_updates=ignore_nulls, **COMMON))
    assert table.store.remove_unused(3600) == []
    after = rows(table.read())
    # both pointers name the rewritten folders now; the six of the first two batches are named by none
    assert len(table.store.remove_unused(-60)) == 6
    assert rows(table.read()) == after and len(child_files(spark, f"{tmp_path}/t/pointer")) == 2


def test_history_streamed_from_files(spark, tmp_path):
    """Landing files -> ingest -> rules -> both tables; a second run handles only what is new."""
    events = random_events(8, count=120)
    df = spark.createDataFrame(events, COLUMNS)
    half = len(events) // 2
    write_json(spark.createDataFrame(events[:half], COLUMNS), f"{tmp_path}/landing/one", 3)
    tables = [
        Scd1Table(spark, f"{tmp_path}/scd1", buckets=2, **{**COMMON, "except_columns": ["operation", "seq", RESCUED]}),
        Scd2Table(
            spark,
            f"{tmp_path}/scd2",
            buckets=2,
            track_history=["name"],
            **{**COMMON, "except_columns": ["operation", "seq", RESCUED]},
        ),
    ]

    def run():
        stream = ingest_json(
            spark, f"{tmp_path}/landing", df.schema, max_files_per_trigger=2, recursiveFileLookup="true"
        )
        run_changes(expect_or_drop(stream, {"valid_id": "id IS NOT NULL"}), tables, f"{tmp_path}/checkpoint")

    run()
    steps = tables[0].store.last_step()
    run()
    assert tables[0].store.last_step() == steps
    write_json(spark.createDataFrame(events[half:], COLUMNS), f"{tmp_path}/landing/two", 2)
    run()
    assert tables[0].store.last_step() > steps
    assert rows(tables[0].read()) == rows(fold_scd1(df, **COMMON))
    assert rows(tables[1].read()) == rows(fold_scd2(df, track_history=["name"], **COMMON))


def test_append_stream_and_observed_rules(spark, tmp_path):
    schema = spark.range(1).selectExpr("id", "'x' AS word").schema
    source = spark.range(0, 100).selectExpr("CASE WHEN id % 4 = 0 THEN NULL ELSE id END AS id", "'w' AS word")
    source.write.option("header", "true").option("compression", "gzip").csv(f"{tmp_path}/in")
    spark.range(5).selectExpr("id", "'other' AS word").write.option("header", "true").csv(f"{tmp_path}/in/other")
    append_csv(spark, f"{tmp_path}/in", f"{tmp_path}/raw", f"{tmp_path}/cp1", schema, glob="*.csv.gz", max_files_per_trigger=1)
    assert spark.read.parquet(f"{tmp_path}/raw").count() == 100

    rules = {"valid_id": "id IS NOT NULL"}
    watched = observe_expectations(stream_table(spark, f"{tmp_path}/raw"), rules, "quality")
    query = (
        expect_or_drop(watched, rules)
        .writeStream.format("parquet")
        .option("path", f"{tmp_path}/clean")
        .option("checkpointLocation", f"{tmp_path}/cp2")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    metrics = [p["observedMetrics"]["quality"] for p in query.recentProgress if p["observedMetrics"]]
    assert sum(m["rows"] for m in metrics) == 100 and sum(m["valid_id"] for m in metrics) == 25
    assert spark.read.parquet(f"{tmp_path}/clean").count() == 75


def test_family_of_tables(spark, tmp_path):
    events = [e for e in random_events(21, count=80, copies=0)]
    df = spark.createDataFrame(events, COLUMNS)
    for name in ("first", "second"):
        write_json(df.withColumn("id", F.col("id") + (0 if name == "first" else 100)), f"{tmp_path}/in/{name}", 2)
    assert list_tables(spark, f"{tmp_path}/in") == ["first", "second"]
    specs = [
        TableSpec(
            name,
            sequence_by="seq",
            except_columns=("operation", "seq", RESCUED),
            rules={"valid_id": "id IS NOT NULL", "valid_json_schema": f"{RESCUED} IS NULL"},
            schema=df.schema if name == "first" else None,
            schema_hints="id INT, seq INT",
            table_options={"buckets": 2},
            history=name == "first",
        )
        for name in list_tables(spark, f"{tmp_path}/in")
    ]
    done = run_cdc_family(spark, f"{tmp_path}/in", f"{tmp_path}/out", specs)
    columns = ["id", "name", "note"]
    assert rows(done["first"]["scd1"].read().select(columns)) == rows(fold_scd1(df, **COMMON))
    assert rows(done["first"]["scd2"].read().select(*columns, "__START_AT", "__END_AT")) == rows(
        fold_scd2(df, **COMMON)
    )
    assert "scd2" not in done["second"]
    shifted = fold_scd1(df, **COMMON).withColumn("id", F.col("id") + 100)
    assert rows(done["second"]["scd1"].read().select(columns)) == rows(shifted)
    assert with_rescue(df.schema).fieldNames()[-1] == RESCUED


def test_filters_on_rescued_records_parse_each_text_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('{"id": 1, "v": "x"}\n{"id": 2, "v": "y", "w": 3}\nnot json\n[1]\n')
    schema = T.StructType.fromDDL("id long, v string")
    rows = read_json(spark, str(tmp_path), schema).where("id IS NOT NULL AND v IN ('x', 'y')")
    assert sorted(map(tuple, rows.collect())) == [(1, "x", None), (2, "y", '{"w":"3"}')]
    passed = rows.where("_rescued_data IS NULL")
    assert [tuple(r) for r in passed.collect()] == [(1, "x", None)]
    assert passed._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 2


def test_kept_results_have_as_many_partitions_as_their_size_asks_for(spark):
    before = spark.conf.get(change_tables.SIZED_CACHE, None)
    kept = change_tables.persisted(spark.range(100).groupBy((F.col("id") % 10).alias("k")).count())
    try:
        assert kept.count() == 10
        assert kept.select(F.spark_partition_id()).distinct().count() == 1
        assert spark.conf.get(change_tables.SIZED_CACHE, None) == before
    finally:
        kept.unpersist()
