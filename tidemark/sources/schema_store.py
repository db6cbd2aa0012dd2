"""Schemas that are kept, and grow by what new files bring."""

from __future__ import annotations

import json

from pyspark.sql import SparkSession, types as T

from tidemark.sinks.paths import child_files, child_folders, create_text, exists, read_text
from tidemark.sources.landing import FileLedger, infer_csv_schema, list_files, wider


def merge_schemas(one: T.StructType, two: T.StructType) -> T.StructType:
    """The columns of both, those of `one` first, each with a type that takes the values of both (see `landing.wider`)."""
    return wider(one, two) if one.fields else two


class SchemaStore:
    """The schema of a landing folder: one small JSON file for each version, and a ledger of the files it comes from.

    `grow` looks into files that no earlier call has seen and into no others; types found in them (by Spark's own inference,
    which combines within tasks first) widen the stored ones: INT and BIGINT to BIGINT, numbers to DOUBLE, unlike types to
    STRING, structs field by field, lists by element. Hints override types for readers and are not stored.
    """

    def __init__(self, spark: SparkSession, folder: str, file_format: str, **options: object):
        if file_format not in ("json", "csv"):
            raise ValueError("schemas are inferred from json and csv files")
        self.spark, self.folder, self.file_format, self.options = spark, folder, file_format, options
        self.ledger = FileLedger(spark, f"{folder}/files")

    def versions(self) -> list[int]:
        if not exists(self.spark, f"{self.folder}/schemas"):
            return []
        return sorted(int(name.split(".")[0]) for name in child_files(self.spark, f"{self.folder}/schemas") if name.endswith(".json"))

    def schema(self) -> T.StructType:
        """The newest version; no columns before the first."""
        versions = self.versions()
        if not versions:
            return T.StructType()
        return T.StructType.fromJson(json.loads(read_text(self.spark, f"{self.folder}/schemas/{versions[-1]:08d}.json")))

    def grow(self, landing: str, glob: str | None = None) -> list[str]:
        """Take what new files under `landing` bring into the schema; returns the paths of the files that were opened."""
        files = list_files(self.spark, landing, glob)
        fresh = files.join(self.ledger.compare(files).where("status IN ('new', 'rewritten')"), "path", "left_semi")
        rows = fresh.collect()
        fresh, paths = self.spark.createDataFrame(rows, files.schema), sorted(row.path for row in rows)
        if not paths:
            return []
        if self.file_format == "csv":
            found = infer_csv_schema(self.spark, paths, **self.options)
        else:
            found = self.spark.read.options(**self.options).json(paths).schema
        version = (self.versions() or [0])[-1] + 1
        merged = merge_schemas(self.schema(), found)
        if merged != self.schema() and not create_text(self.spark, f"{self.folder}/schemas/{version:08d}.json", merged.json()):
            raise RuntimeError(f"another writer has stored version {version} of this schema")
        # recorded last: a call that stopped before this looks into the same files again, which changes nothing
        done = [int(name.split("=")[1]) for name in child_folders(self.spark, f"{self.folder}/files") if name.startswith("batch=")]
        self.ledger.record(fresh, max(done, default=-1) + 1)
        return paths
