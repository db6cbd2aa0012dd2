"""Snapshots, change feed, reconciliation, de-duplication, positions, layout."""

import random

import pytest
from helpers import rows
from pyspark.sql import functions as F

from tidemark.operators.common import END_AT, START_AT
from tidemark.operators.latest import dedupe_by_key, latest_by_key
from tidemark.operators.pairing import change_feed, reconcile, reconcile_summary
from tidemark.operators.position import with_position, zip_rows
from tidemark.operators.snapshots import apply_snapshot_scd2, fold_snapshots_scd2, open_history
from tidemark.sinks.layout import DatasetSpec, clustered, write_dataset, write_json
from tidemark.sinks.paths import child_files, create_text, read_text
from tidemark.sinks.snapshot_table import SnapshotTable

SNAPSHOT = "id int, name string, note string"


def random_snapshots(seed, versions=5, keys=12):
    draw = random.Random(seed)
    return {
        v: [
            (None if k == 0 else k, draw.choice(["a", "b", None]), draw.choice("xyz"))
            for k in range(keys)
            if draw.random() < 0.7
        ]
        for v in range(1, versions + 1)
    }


def expected_history(snapshots, tracked):
    open_, out = {}, []
    for version, snapshot in snapshots.items():
        now = {row[0]: row for row in snapshot}
        for key in list(open_):
            old = open_[key]
            if key not in now or any(old[0][i] != now[key][i] for i in tracked):
                out.append((*old[0], old[1], version))
                del open_[key]
        for key, row in now.items():
            open_[key] = (row, open_[key][1] if key in open_ else version)
    return sorted(out + [(*row, start, None) for row, start in open_.values()], key=repr)


@pytest.mark.parametrize("track", [["name"], ["name", "note"]], ids=str)
def test_snapshot_histories_agree(spark, tmp_path, track):
    snapshots = random_snapshots(len(track))
    expected = expected_history(snapshots, [1] if track == ["name"] else [1, 2])
    stored = SnapshotTable(spark, f"{tmp_path}/h", ["id"], track_history=track)
    stacked = None
    for step, (version, data) in enumerate(snapshots.items()):
        df = spark.createDataFrame(data, SNAPSHOT)
        stored.apply(df, F.lit(version), step)
        stored.apply(df, F.lit(version), step)
        part = df.withColumn("version", F.lit(version))
        stacked = part if stacked is None else stacked.unionByName(part)
    names = ["id", "name", "note", START_AT, END_AT]
    assert rows(stored.read().select(names)) == expected
    assert rows(fold_snapshots_scd2(stacked, ["id"], "version", track_history=track).select(names)) == expected


def test_single_snapshot_and_bad_input(spark):
    df = spark.createDataFrame([(1, "a", "x"), (2, "b", "y")], SNAPSHOT)
    history = open_history(df, F.lit(1))
    assert rows(history) == [(1, "a", "x", 1, None), (2, "b", "y", 1, None)]
    with pytest.raises(Exception, match="not newer"):
        apply_snapshot_scd2(history, df, F.lit(1), ["id"]).collect()
    with pytest.raises(Exception, match="de-duplicate"):
        apply_snapshot_scd2(history, df.union(df), F.lit(2), ["id"]).collect()
    with pytest.raises(Exception, match="repeat inside"):
        fold_snapshots_scd2(df.union(df).withColumn("v", F.lit(1)), ["id"], "v").collect()
    with pytest.raises(ValueError, match="not in the payload"):
        apply_snapshot_scd2(history, df, F.lit(2), ["id"], track_history=["nope"])


def test_change_feed_turns_old_into_new(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", "x"), (None, "n", "q"), (4, "d", "z")], SNAPSHOT)
    new = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (None, None, "q"), (5, "e", "z")], SNAPSHOT)
    feed = change_feed(old, new, ["id"])
    assert rows(feed) == sorted(
        [
            (1, "update_preimage", "a", None),
            (1, "update_postimage", "a", "x"),
            (None, "update_preimage", "n", "q"),
            (None, "update_postimage", None, "q"),
            (4, "delete", "d", "z"),
            (5, "insert", "e", "z"),
        ],
        key=repr,
    )
    with pytest.raises(Exception, match="repeat"):
        change_feed(old, new.union(new), ["id"]).collect()


def test_reconcile_compares_multisets(spark):
    expected = spark.createDataFrame([(1, "a", "x"), (1, "b", "x"), (2, "c", "x"), (3, "d", None)], SNAPSHOT)
    found = spark.createDataFrame([(1, "b", "x"), (1, "a", "x"), (2, "c", "x"), (2, "c", "x"), (None, "d", "x")], SNAPSHOT)
    result = reconcile(expected, found, ["id"])
    assert rows(result) == sorted(
        [(1, 2, 2, "matched"), (2, 1, 2, "different"), (3, 1, 0, "missing"), (None, 0, 1, "unexpected")], key=repr
    )
    assert rows(reconcile_summary(result)) == [("different", 1), ("matched", 1), ("missing", 1), ("unexpected", 1)]


def test_dedupe_does_not_depend_on_partitions(spark):
    draw = random.Random(1)
    data = [(draw.randrange(20), draw.choice("ab"), draw.choice("xyz")) for _ in range(300)]
    df = spark.createDataFrame(data, SNAPSHOT)
    results = {tuple(rows(dedupe_by_key(df.repartition(n), ["id"]))) for n in (1, 3, 7)}
    assert len(results) == 1
    best = {}
    for key, name, note in data:
        best[key] = max(best.get(key, (note, name)), (note, name))
    assert rows(latest_by_key(df, ["id"], ["note"])) == sorted([(k, n, o) for k, (o, n) in best.items()], key=repr)


def test_positions_with_copies(spark):
    data = [(i % 7, "same", "row") for i in range(90)] + [(3, "same", "row")] * 200
    df = spark.createDataFrame(data, SNAPSHOT).repartition(6)
    numbered = with_position(df, ["id"]).orderBy("_position").collect()
    assert [r["_position"] for r in numbered] == list(range(1, 291))
    assert [r["id"] for r in numbered] == sorted(d[0] for d in data)
    assert with_position(df.where("id > 100"), ["id"]).count() == 0
    many = spark.range(0, 400_000).selectExpr("IF(id < 250000, 7, id) AS id", "repeat('x', 200) AS wide")
    held = with_position(many, ["wide"]).agg(F.min("_position"), F.max("_position"), F.countDistinct("_position")).first()
    assert tuple(held) == (1, 400_000, 400_000)
    assert with_position(many, ["id"]).where("id = 7").agg(F.min("_position"), F.max("_position")).first()[:] == (1, 250_000)
    left = spark.range(10).withColumnRenamed("id", "a")
    right = spark.range(100, 106).withColumnRenamed("id", "b")
    assert rows(zip_rows(left, right, ["a"], ["b"]).select("a", "b")) == [(i, 100 + i) for i in range(6)]


def test_layout(spark, tmp_path):
    df = spark.range(0, 4000).selectExpr("id", "CASE WHEN id < 3000 THEN 0 ELSE id % 50 END AS area")
    ranges = clustered(df, ["area"], 8).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert max(r["count"] for r in ranges) < 1500, "one value must spread over several files"
    spec = DatasetSpec(
        name="layout_test", layer="gold", comment="It's a test", path=f"{tmp_path}/t", cluster_by=["area"],
        properties={"project.environment": "test"},
    )
    write_dataset(df, spec)
    assert spark.read.table("layout_test").count() == 4000
    properties = {r["key"]: r["value"] for r in spark.sql("SHOW TBLPROPERTIES layout_test").collect()}
    assert properties["quality"] == "gold" and properties["project.environment"] == "test"
    spark.sql("DROP TABLE layout_test")
    write_json(df, f"{tmp_path}/json", 5)
    assert len([n for n in child_files(spark, f"{tmp_path}/json") if n.endswith(".json")]) == 5
    assert create_text(spark, f"{tmp_path}/note.txt", "one é") and not create_text(spark, f"{tmp_path}/note.txt", "two")
    assert read_text(spark, f"{tmp_path}/note.txt") == "one é"
