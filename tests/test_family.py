"""Tables found under a landing root, and their rules counted by batch."""

import shutil

from pyspark.sql import functions as F

from tidemark.operators.quality import stored_metrics
from tidemark.sinks.layout import write_json
from tidemark.sources.files import files_written_for
from tidemark.streaming.family import TableSpec, family_metrics, run_cdc_family


def feed(spark, count):
    return spark.range(count).select(
        F.when(F.col("id") % 4 != 0, F.col("id") % 10).alias("id"), F.lit("n").alias("name"), F.lit("UPDATE").alias("operation"), F.col("id").alias("seq")
    )


def test_folders_are_found_and_replayed_batches_count_once(spark, tmp_path):
    rules = {"valid_id": "id IS NOT NULL", "small": "seq < 30"}
    default = TableSpec("", sequence_by="seq", rules=rules, history=False, except_columns=["operation", "seq", "_rescued_data"], table_options={"buckets": 2})
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")

    def run():
        return run_cdc_family(spark, landing, target, default=default, max_files_per_trigger=1)

    def counts():
        rows = family_metrics(spark, target).groupBy("name", "rule").agg(F.sum("passed"), F.sum("failed")).collect()
        return {(r.name, r.rule): (r[2], r[3]) for r in rows}

    write_json(feed(spark, 40), f"{landing}/one", 2)
    assert set(run()) == {"one"} and counts() == {("one", "valid_id"): (30, 10), ("one", "small"): (30, 10)}
    assert stored_metrics(spark, f"{target}/one/metrics").select("batch").distinct().count() == 2
    # the last batch is replayed: its commit is gone
    commits = tmp_path / "out" / "one" / "checkpoints" / "changes" / "commits"
    for name in ("1", ".1.crc"):
        (commits / name).unlink(missing_ok=True)
    write_json(feed(spark, 8), f"{landing}/two", 1)
    tables = run()
    assert set(tables) == {"one", "two"}
    assert counts() == {("one", "valid_id"): (30, 10), ("one", "small"): (30, 10), ("two", "valid_id"): (6, 2), ("two", "small"): (8, 0)}
    assert tables["one"]["scd1"].read().count() == 10 - sum(all(x % 4 == 0 or x >= 30 for x in range(40) if x % 10 == d) for d in range(10))
    shutil.rmtree(landing)


def test_a_landing_file_that_becomes_many_raw_files_is_applied_at_once(spark, tmp_path):
    """Batches are counted in landing files, so their number does not grow with the rows in a file."""
    default = TableSpec("", sequence_by="seq", history=False, except_columns=["operation", "seq", "_rescued_data"], table_options={"buckets": 2})
    landing, target = str(tmp_path / "in"), str(tmp_path / "out")
    write_json(feed(spark, 2000), f"{landing}/one", 3)
    limits = {"spark.sql.files.maxPartitionBytes": "8192", "spark.sql.files.openCostInBytes": "0"}
    for name, value in limits.items():
        spark.conf.set(name, value)
    try:
        tables = run_cdc_family(spark, landing, target, default=default, max_files_per_trigger=2)
    finally:
        for name in limits:
            spark.conf.unset(name)
    assert len(list((tmp_path / "out" / "one" / "raw").glob("*.parquet"))) > 6
    assert tables["one"]["scd1"].store.last_step() == 1
    assert files_written_for(spark, f"{target}/one/raw", f"{landing}/one", None) is None
    assert files_written_for(spark, f"{landing}/none", f"{landing}/none", 4) == 4
