"""Batch sinks: overwrite tables, clustered layout, JSON with a set number of files."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.common import col


@dataclass(frozen=True)
class DatasetSpec:
    """How a dataset is stored: table name or folder, comment, layer properties, clustering columns."""

    name: str
    layer: str
    comment: str = ""
    path: str | None = None
    cluster_by: Sequence[str] = ()
    properties: Mapping[str, str] = field(default_factory=dict)


def clustered(df: DataFrame, columns: Sequence[str], partitions: int | None = None) -> DataFrame:
    """Rows in ranges of the clustering columns, so that files and row groups can be skipped by their
    min/max statistics. Equal rows are ranked by their place in the input: one clustering value with a
    large share of the table still spreads over many files."""
    order = [*map(col, columns), F.monotonically_increasing_id()]
    ranged = df.repartitionByRange(partitions, *order) if partitions else df.repartitionByRange(*order)
    return ranged.sortWithinPartitions(*map(col, columns))


def write_dataset(df: DataFrame, spec: DatasetSpec, mode: str = "overwrite") -> None:
    """Recompute a dataset (a materialized view) as a table, or as a folder when `path` is set alone."""
    if spec.cluster_by:
        df = clustered(df, spec.cluster_by)
    writer = df.write.mode(mode).format("parquet")
    if not spec.name:
        writer.save(spec.path)
        return
    if spec.path:
        writer = writer.option("path", spec.path)
    writer.saveAsTable(spec.name)
    spark = df.sparkSession
    properties = {"quality": spec.layer, **spec.properties}
    pairs = ", ".join(f"{_quoted(k)} = {_quoted(v)}" for k, v in properties.items())
    table = ".".join("`" + part.strip("`").replace("`", "``") + "`" for part in spec.name.split("."))
    spark.sql(f"ALTER TABLE {table} SET TBLPROPERTIES ({pairs})")
    if spec.comment:
        spark.sql(f"COMMENT ON TABLE {table} IS {_quoted(spec.comment)}")


def _quoted(text: str) -> str:
    return "'" + str(text).replace("\\", "\\\\").replace("'", "\\'") + "'"


def write_json(df: DataFrame, path: str, files: int) -> None:
    """JSON lines in `files` files of even size, replacing what is there."""
    df.repartition(files).write.format("json").mode("overwrite").save(path)
