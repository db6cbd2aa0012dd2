"""A stored table as plain parquet folders, one per batch, and a small pointer to those that count.

A batch writes folders of its own and then publishes one small file that names the folders which make up the table.
Readers take the newest pointer, so they never see half a batch; folders of an attempt that failed are named by none.
No folder is changed once written, and none is shared by two attempts.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.common import col
from tidemark.sinks.paths import child_files, child_folders, create_text, delete_file, read_text, remove_old_folders
from tidemark.sources.schemas import evolve_schema

STEP = "_step"
BUCKET = "_bucket"
#: Types whose every value the other type holds.
_WHOLE = (T.ByteType, T.ShortType, T.IntegerType, T.LongType)
WIDENING = {
    *((a, b) for i, a in enumerate(_WHOLE) for b in _WHOLE[i + 1 :]),
    *((a, T.DoubleType) for a in (T.FloatType, *_WHOLE[:3])),
    (T.NullType, T.StringType),
}


def as_type(value: Column, kind: T.DataType, wanted: T.DataType) -> Column:
    """The value as `wanted`, inside structs too; fields that `wanted` lacks stay. TypeError where it may not fit."""
    if isinstance(kind, T.StructType) and isinstance(wanted, T.StructType):
        have = {f.name: f.dataType for f in wanted.fields}
        if all(f.dataType == have.get(f.name, f.dataType) for f in kind.fields):
            return value
        parts = [as_type(value.getField(f.name), f.dataType, have.get(f.name, f.dataType)).alias(f.name) for f in kind.fields]
        return F.when(value.isNotNull(), F.struct(*parts))
    if kind.simpleString() == wanted.simpleString():
        return value
    if (type(kind), type(wanted)) in WIDENING:
        return value.cast(wanted)
    raise TypeError(f"{value} comes as {kind.simpleString()}, but the table has {wanted.simpleString()}")


class BatchFolders:
    """The folders of a table's parts, bucketed by key. The pointer also holds the parts' schemas and the settings that
    every writer of the table must agree on."""

    def __init__(self, spark: SparkSession, root: str, parts: Sequence[str], settings: dict[str, object] | None = None):
        self.spark, self.root, self.parts = spark, root.rstrip("/"), tuple(parts)
        self.schemas: dict[str, T.StructType] = {}
        self.settings: dict[str, object] = settings or {}
        #: (batch, rewrite) of the pointer that was read last: what the next one is based on.
        self.based_on: tuple[int, int] | None = None

    # ---- the pointer

    def _pointers(self) -> list[tuple[int, int]]:
        """(batch, rewrite) of the pointers there are, oldest first: the newest, and the one it replaced."""
        return sorted(tuple(map(int, name.split(".")[:2])) for name in child_files(self.spark, f"{self.root}/pointer"))

    def _path(self, pointer: tuple[int, int]) -> str:
        return f"{self.root}/pointer/{pointer[0]:010d}.{pointer[1]:04d}.json"

    def last_step(self) -> int:
        """Number of the last published batch; -1 before the first."""
        return max((batch for batch, _ in self._pointers()), default=-1)

    def folders(self) -> dict[str, list[str]]:
        """The folders of every part as of the last batch, oldest first. Also loads their schemas."""
        self.based_on = max(self._pointers(), default=None)
        if self.based_on is None:
            return {part: [] for part in self.parts}
        known = json.loads(read_text(self.spark, self._path(self.based_on)))
        self.schemas = {part: T.StructType.fromJson(json.loads(text)) for part, text in known["schemas"].items()}
        stored = known["settings"]
        if stored != self.settings:
            changed = sorted(k for k in {*stored, *self.settings} if stored.get(k) != self.settings.get(k))
            raise ValueError(f"{self.root} was written with other {', '.join(changed)}: {stored} against {self.settings}")
        return known["folders"]

    def publish(self, batch: int, folders: dict[str, list[str]]) -> None:
        """Make `folders` the table. RuntimeError if another writer has published since they were read."""
        pointers = self._pointers()
        newest = max(pointers, default=None)
        rewrite = newest[1] + 1 if newest and newest[0] == batch else 0
        schemas = {part: schema.json() for part, schema in self.schemas.items()}
        text = json.dumps({"folders": folders, "schemas": schemas, "settings": self.settings})
        if newest != self.based_on or not create_text(self.spark, self._path((batch, rewrite)), text):
            raise RuntimeError(f"{self.root}: another writer published before batch {batch}; this one's rows are not in the table")
        self.based_on = (batch, rewrite)
        for old in pointers[:-1]:  # the one before stays for readers that have just found it
            delete_file(self.spark, self._path(old))

    def remove_unused(self, older_than: float) -> list[str]:
        """Delete folders that no pointer names and whose newest file is over `older_than` seconds old: what rewrites have
        replaced, and what attempts that failed have left. Younger ones may belong to a batch under way or be read still.
        """
        named: set[str] = set()
        for pointer in self._pointers():
            for folders in json.loads(read_text(self.spark, self._path(pointer)))["folders"].values():
                named.update(folder.rsplit("/", 1)[1] for folder in folders)
        return [
            name for part in self.parts for name in remove_old_folders(self.spark, f"{self.root}/{part}", named, older_than)
        ]

    # ---- rows

    def write(self, rows: DataFrame, part: str, batch: int, order: Sequence[str] = ()) -> str:
        """Write one folder. Rebalancing gives few files per bucket, and several for a big bucket; rows are in `order`
        inside a file, so that its statistics tell readers which row groups to pass over.
        Columns that are new to the part are added to its schema; older rows read as NULL there."""
        path = f"{self.root}/{part}/{STEP}={batch:010d}-{uuid.uuid4().hex}"
        rows = self._as_stored(rows, part)
        sorted_rows = rows.hint("rebalance", F.col(BUCKET)).sortWithinPartitions(BUCKET, *map(col, order))
        sorted_rows.write.partitionBy(BUCKET).parquet(path)
        self.schemas[part] = evolve_schema(self.schemas.get(part, T.StructType()), rows.drop(STEP).schema)
        return path

    def _as_stored(self, rows: DataFrame, part: str) -> DataFrame:
        """The rows with the types that the table has; a type that could lose a value is refused."""
        have = {f.name: f.dataType for f in self.schemas.get(part, T.StructType()).fields}
        try:
            return rows.select(
                *[
                    as_type(col(f.name), f.dataType, have.get(f.name, f.dataType)).alias(f.name)
                    for f in rows.schema.fields
                ]
            )
        except TypeError as error:
            raise ValueError(f"{self.root}, {part}: {error}") from error

    def buckets_in(self, folder: str) -> list[int]:
        """Numbers of the buckets a written folder has rows in."""
        return [int(name.split("=")[1]) for name in child_folders(self.spark, folder) if "=" in name]

    def read(self, part: str, folders: Sequence[str], buckets: Sequence[int] | None = None) -> DataFrame | None:
        """Rows of the folders with their step; only the given buckets are read."""
        if not folders:
            return None
        schema = T.StructType([*self.schemas[part].fields, T.StructField(STEP, T.StringType())])
        rows = self.spark.read.schema(schema).option("basePath", f"{self.root}/{part}").parquet(*folders)
        return rows if buckets is None else rows.where(F.col(BUCKET).isin(list(buckets)))


def bucket_of(keys: Sequence[str], buckets: int) -> Column:
    return F.pmod(F.xxhash64(*map(col, keys)), F.lit(buckets)).cast("int").alias(BUCKET)
