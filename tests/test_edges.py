"""Values and records at the edges: nothing is lost or changed unseen."""

import datetime
import json
import math

import pytest
from pyspark.sql import functions as F, types as T

from catalogue import fixtures as fx, runs
from helpers import COMMON, rows
from tidemark.operators.protection import apply_row_filter
from tidemark.operators.ranges import range_cuts, range_index
from tidemark.operators.scd import fold_scd2
from tidemark.plans.trips import rounded_average
from tidemark.sinks.batch_folders import BatchFolders
from tidemark.sources.files import ingest_json, read_json
from tidemark.streaming.append import run_append
from tidemark.streaming.change_tables import Scd1Table, Scd2Table

EVENTS = "id int, name string, note string, operation string, seq int"


def test_trips_are_dealt_before_their_texts_are_made(spark, tmp_path):
    kinds = (
        "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double,"
        " l_discount double, l_tax double, l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    )
    day = datetime.datetime(2024, 1, 2, 3, 4, 5)
    lines = [(i, i % 3, i % 5, i % 8, i / 2, 1.5 * i, 0.25, i % 2 / 4, "RN"[i % 2], "O", day) for i in range(120)]
    lines += [(None,) * 11, lines[0], lines[0]]
    spark.createDataFrame(lines, kinds).write.parquet(f"{tmp_path}/lineitem.parquet")
    plain, dealt = fx.trips(spark, str(tmp_path)), fx.trips(spark, str(tmp_path), parts=6)
    assert sorted(map(str, dealt.collect())) == sorted(map(str, plain.collect())) and dealt.columns == plain.columns
    sizes = [r["count"] for r in dealt.groupBy(F.spark_partition_id()).count().collect()]
    assert len(sizes) == 6 and max(sizes) - min(sizes) <= 8
    above, below = dealt._jdf.queryExecution().optimizedPlan().toString().split("Repartition 6")
    assert "cast(" in above and "cast(" not in below


def test_average_sees_every_value(spark):
    cases = {"plain": [1.005, 1.015], "nan": [1.0, float("nan")], "huge": [1.0, 1e30], "infinite": [math.inf, 1.0], "fine": [1e-9, 3e-9], "none": [None, None]}
    table = spark.createDataFrame([(k, v) for k, values in cases.items() for v in values], "k string, v double")
    found = {r.k: r.a for r in table.groupBy("k").agg(rounded_average("v", 2).alias("a")).collect()}
    assert found["plain"] == 1.01 and math.isnan(found["nan"]) and found["huge"] == 5e29
    assert found["infinite"] == math.inf and found["fine"] == 0.0 and found["none"] is None


def test_unknown_fields_and_misfits_are_rescued(spark, tmp_path):
    lines = ['{"a":1,"b":"x"}', '{"a":2,"new":{"k":[1,2]},"more":"y"}', '{"a":"no","b":"z"}', "{broken", "[1,2]", "", "7", '{"a":null}']
    (tmp_path / "in").mkdir()
    (tmp_path / "in" / "one.json").write_text("\n".join(lines))
    schema = T.StructType.fromDDL("a INT, b STRING")
    batch = {(r.a, r.b, r._rescued_data) for r in read_json(spark, str(tmp_path / "in"), schema).collect()}
    run_append(ingest_json(spark, str(tmp_path / "in"), schema), str(tmp_path / "out"), str(tmp_path / "ck"))
    assert batch == {(r.a, r.b, r._rescued_data) for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    kept = {text for _, _, text in batch}
    assert (1, "x", None) in batch and (None, None, None) in batch and len(batch) == 7
    assert {"{broken", "[1,2]", "7", '{"a":"no","b":"z"}'} <= kept
    late = next(json.loads(t) for _, _, t in batch if t and "new" in t)
    assert late["more"] == "y" and json.loads(late["new"]) == {"k": [1, 2]}


def test_reopening_with_other_settings_is_refused(spark, tmp_path):
    events = spark.createDataFrame([(i, "n", "x", "APPEND", i) for i in range(20)], EVENTS)
    Scd2Table(spark, f"{tmp_path}/t", buckets=4, track_history=["name"], **COMMON).apply(events, 0)
    again = Scd2Table(spark, f"{tmp_path}/t", buckets=4, track_history=["name"], **COMMON)
    again.apply(events.withColumn("seq", F.col("seq") + 100), 1)
    for settings in ({"buckets": 8, "track_history": ["name"]}, {"buckets": 4, "track_history": ["note"]}):
        other = Scd2Table(spark, f"{tmp_path}/t", **settings, **COMMON)
        with pytest.raises(ValueError):
            other.apply(events, 2)
        with pytest.raises(ValueError):
            other.read()


def test_types_are_kept_widened_or_refused(spark, tmp_path):
    table = Scd1Table(spark, f"{tmp_path}/t", buckets=2, **COMMON)
    wide = EVENTS.replace("name string", "name bigint")
    table.apply(spark.createDataFrame([(1, 2**40, "x", "APPEND", 1)], wide), 0)
    table.apply(spark.createDataFrame([(2, 5, "x", "APPEND", 2)], wide.replace("bigint", "int")), 1)
    assert rows(table.read().select("id", "name")) == [(1, 2**40), (2, 5)]
    with pytest.raises(ValueError):
        table.apply(spark.createDataFrame([(3, "text", "x", "APPEND", 3)], EVENTS), 2)
    assert table.read().count() == 2


def test_a_writer_that_lost_is_told(spark, tmp_path):
    one, two = (BatchFolders(spark, f"{tmp_path}/table", ["t"]) for _ in range(2))
    one.publish(0, {"t": []})
    with pytest.raises(RuntimeError):
        two.publish(0, {"t": ["other"]})
    assert one.folders() == {"t": []} and one.last_step() == 0
    two.folders()
    for step in (1, 2, 3):
        one.publish(step, {"t": []})
    with pytest.raises(RuntimeError):  # also after the pointer it would have written is gone
        two.publish(1, {"t": ["other"]})
    assert one.folders() == {"t": []} and one.last_step() == 3


def test_split_and_whole_keys_agree_on_odd_sequences(spark):
    draws = [float("nan"), math.inf, -math.inf, 0.0, 1.5, -3.0, 7.25] * 3
    events = [(0, f"v{i % 5}", s) for i, s in enumerate(draws)] + [(1, "w", 2.0)]
    table = spark.createDataFrame(events, "id int, name string, seq double")
    fold = lambda limit: fold_scd2(table, ["id"], "seq", except_columns=["seq"], hot_rows=limit)
    assert repr(rows(fold(1))) == repr(rows(fold(10**6)))


def test_ranges_cut_evenly_and_never_decrease(spark):
    table = spark.range(0, 5000, 3)
    cuts = range_cuts(table, "id", 100)
    counted = table.groupBy(range_index(F.col("id"), cuts).alias("part")).agg(F.min("id").alias("low"), F.max("id").alias("high"), F.count("*").alias("n")).orderBy("part").collect()
    assert [r.part for r in counted] == list(range(len(cuts) + 1)) and all(a.high < b.low for a, b in zip(counted, counted[1:]))
    assert max(r.n for r in counted) < 3 * 100
    assert spark.range(1).select(range_index(F.lit(None).cast("long"), cuts)).first()[0] == 0
    assert range_cuts(table.limit(0), "id") == []


def test_row_filter_takes_no_single_string(spark):
    with pytest.raises(TypeError):
        apply_row_filter(spark.range(1), "id", "abc")


def test_rows_from_python_do_not_shuffle_the_table_they_are_joined_to(spark, tmp_path):
    codes = F.array(*map(F.lit, ["1-URGENT", "2-HIGH", "3-MEDIUM", "5-LOW"]))
    orders = spark.range(40).select(F.get(codes, (F.col("id") % 4).cast("int")).alias("o_orderpriority"))
    orders.write.parquet(f"{tmp_path}/orders.parquet")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a table too big to broadcast
    try:
        found = runs.local_rows(spark, str(tmp_path))
        plan = found._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "BroadcastHashJoin" in plan and "hashpartitioning(o_orderpriority" not in plan
    assert sorted(map(tuple, found.collect())) == [("later", 10), ("now", 10), ("soon", 10)]
