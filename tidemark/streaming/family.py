"""One landing folder per table, one ingest-clean-apply chain each."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field, replace

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.quality import Rules, stored_metrics
from tidemark.sinks.paths import child_folders, exists
from tidemark.sources.files import files_written_for, ingest_json, stream_table
from tidemark.sources.schemas import RESCUED, infer_schema, merge_schema_hints
from tidemark.streaming.append import run_append
from tidemark.streaming.change_tables import CurrentRows, Scd1Table, Scd2Table, run_changes


@dataclass(frozen=True)
class TableSpec:
    """How the change feed of one table is read and applied."""

    name: str
    keys: Sequence[str] = ("id",)
    sequence_by: str | Column = "operation_date"
    delete_when: str = "operation = 'DELETE'"
    except_columns: Sequence[str] = ("operation", "operation_date", RESCUED)
    rules: Rules = field(default_factory=dict)
    schema: T.StructType | None = None
    schema_hints: str = ""
    history: bool = True
    ignore_null_updates: bool = False
    track_history_except: Sequence[str] | None = None
    table_options: Mapping[str, object] = field(default_factory=dict)


def list_tables(spark: SparkSession, landing: str) -> list[str]:
    """Names of the tables that have a landing folder."""
    return [name for name in child_folders(spark, landing) if not name.startswith("_")]


def run_cdc_family(
    spark: SparkSession,
    landing: str,
    target: str,
    specs: Sequence[TableSpec] = (),
    default: TableSpec | None = None,
    max_files_per_trigger: int | None = None,
    chains_at_once: int = 4,
) -> dict[str, dict[str, Scd1Table | Scd2Table | CurrentRows]]:
    """Bring every table up to date with its landing folder and return the tables.

    Each chain: new JSON files are appended to a raw table as they are (records that do not parse kept in
    `_rescued_data`); rows that pass the rules are applied to a type 2 table, whose open versions are the type 1
    form too, or, without history, to a type 1 table.
    The chains share nothing, so several run side by side and fill the cluster between them. Rows passing and failing
    each rule are kept by batch (`family_metrics`). `max_files_per_trigger` counts landing files: the raw files that so
    many of them became, on average, are applied together.

    With `default`, every folder found under `landing` that no spec names is a table too, read and applied like
    `default`; one that appears later is found by the next run.
    """
    if default is not None:
        named = {spec.name for spec in specs}
        specs = [*specs, *[replace(default, name=name) for name in list_tables(spark, landing) if name not in named]]

    def chain(spec: TableSpec) -> dict[str, Scd1Table | Scd2Table | CurrentRows]:
        source, base = f"{landing}/{spec.name}", f"{target}/{spec.name}"
        schema = spec.schema or infer_schema(spark, source, "json")
        if spec.schema_hints:
            schema = merge_schema_hints(schema, spec.schema_hints)
        raw = ingest_json(spark, source, schema, max_files_per_trigger=max_files_per_trigger)
        run_append(raw, f"{base}/raw", f"{base}/checkpoints/raw")

        files = files_written_for(spark, f"{base}/raw", source, max_files_per_trigger)
        stored = stream_table(spark, f"{base}/raw", raw.schema, files)
        common = dict(
            keys=spec.keys,
            sequence_by=spec.sequence_by,
            delete_when=spec.delete_when,
            except_columns=spec.except_columns,
            ignore_null_updates=spec.ignore_null_updates,
            **spec.table_options,
        )
        if spec.history:
            history = Scd2Table(spark, f"{base}/scd2", track_history_except=spec.track_history_except, **common)
            tables = {"scd1": CurrentRows(history), "scd2": history}
        else:
            tables = {"scd1": Scd1Table(spark, f"{base}/scd1", **common)}
        kept = [table for table in tables.values() if not isinstance(table, CurrentRows)]
        run_changes(stored, kept, f"{base}/checkpoints/changes", spec.rules, f"{base}/metrics")
        return tables

    with ThreadPoolExecutor(chains_at_once) as pool:
        return dict(zip([spec.name for spec in specs], pool.map(chain, specs), strict=True))


def family_metrics(spark: SparkSession, target: str) -> DataFrame:
    """(name, batch, rule, passed, failed): what the rules of every table have let through and kept out so far."""
    rows = spark.createDataFrame([], "name string, batch long, rule string, passed long, failed long")
    for name in child_folders(spark, target):
        if exists(spark, f"{target}/{name}/metrics"):
            rows = rows.unionByName(stored_metrics(spark, f"{target}/{name}/metrics").withColumn("name", F.lit(name)))
    return rows
