"""Landing folders: which files are there, what their header lines say, and which of them have been taken in."""

from __future__ import annotations

import csv
from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from tidemark.sinks.paths import exists, first_line
from tidemark.sources.schemas import RESCUED

READERS = 16
_FILE = "path string, length long, modified timestamp"


def list_files(spark: SparkSession, path: str | list[str], glob: str | None = None) -> DataFrame:
    """path, length and modified of the files under a folder; their contents are not read."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    return reader.load(path).select("path", "length", F.col("modificationTime").alias("modified"))


def header_groups(spark: SparkSession, files: list[str], options: Mapping[str, object] | None = None) -> dict[tuple[str, ...], list[str]]:
    """Files by the column names of their header lines; files without a line are left out.

    Only the first line of each file is fetched, by the driver through Hadoop, compressed or not; a line end inside a
    quoted name is not supported.
    """
    given = {name.lower(): str(value) for name, value in (options or {}).items()}
    files = sorted(files)
    with ThreadPoolExecutor(READERS) as pool:
        lines = list(pool.map(lambda path: first_line(spark, path, given.get("encoding", "UTF-8")), files))
    groups: dict[tuple[str, ...], list[str]] = {}
    for path, line in zip(files, lines, strict=True):
        if line is not None:
            text = line.removeprefix("﻿")
            names = next(csv.reader([text], delimiter=given.get("sep", given.get("delimiter", ",")), quotechar=given.get("quote", '"')), [])
            groups.setdefault(tuple(name.strip() for name in names), []).append(path)
    return groups


def _read_group(
    spark: SparkSession, names: tuple[str, ...], files: list[str], schema: T.StructType, rescue: bool, options: Mapping[str, object]
) -> DataFrame:
    """Files that share one header: columns found by name, whatever their order."""
    wanted = {f.name.lower(): f for f in schema.fields if f.name != RESCUED}
    place: dict[str, int] = {}
    for i, name in enumerate(names):
        if name.lower() in wanted:
            place.setdefault(name.lower(), i)
    taken = {i: wanted[name].dataType for name, i in place.items()}
    fields = [T.StructField(f"_{i}", taken.get(i, T.StringType())) for i in range(len(names))]
    reader = spark.read.options(**{"header": "true", **options})
    if rescue:
        fields.append(T.StructField("_bad", T.StringType()))
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad")
    rows = reader.schema(T.StructType(fields)).csv(files)
    columns = [
        F.col(f"_{place[f.name.lower()]}").alias(f.name) if f.name.lower() in place else F.lit(None).cast(f.dataType).alias(f.name)
        for f in wanted.values()
    ]
    if not rescue:
        return rows.select(*columns)
    others = [i for i in range(len(names)) if i not in taken]
    rest = F.lit(None).cast("string")
    if others:
        # a name that stands twice is told apart by its place
        labels = [names[i] if names.count(names[i]) == 1 else f"{names[i]}#{i + 1}" for i in others]
        pairs = [x for label, i in zip(labels, others, strict=True) for x in (F.lit(label), F.col(f"_{i}"))]
        kept = F.map_filter(F.create_map(*pairs), lambda _, value: value.isNotNull())
        rest = F.when(F.size(kept) > 0, F.to_json(kept))
    return rows.select(*columns, F.coalesce(F.col("_bad"), rest).alias(RESCUED))


def read_csv_files(
    spark: SparkSession, files: list[str], schema: T.StructType, rescue: bool = True, **options: object
) -> DataFrame:
    """CSV files whose columns are found by the names in their headers (upper and lower case alike).

    There is one reader for each distinct header. A column of `schema` that a file lacks is NULL. With `rescue`,
    `_rescued_data` holds the whole text of a record that does not fit, else a JSON object of the columns that `schema`
    does not have; without, these are dropped.
    """
    parts = [_read_group(spark, *group, schema, rescue, options) for group in header_groups(spark, files, options).items()]
    if not parts:
        fields = [f for f in schema.fields if f.name != RESCUED] + [T.StructField(RESCUED, T.StringType())] * rescue
        return spark.createDataFrame([], T.StructType(fields))
    rows = parts[0]
    for part in parts[1:]:
        rows = rows.unionByName(part)
    return rows


def wider(one: T.DataType, two: T.DataType) -> T.DataType:
    """The narrowest type that takes the values of both; text takes all. Structs have the fields of both."""
    if one == two or isinstance(two, T.NullType):
        return one
    if isinstance(one, T.NullType):
        return two
    if isinstance(one, T.StructType) and isinstance(two, T.StructType):
        fresh = {f.name.lower(): f for f in two.fields}
        both = [T.StructField(f.name, wider(f.dataType, fresh.pop(f.name.lower(), f).dataType)) for f in one.fields]
        return T.StructType(both + [T.StructField(f.name, f.dataType) for f in fresh.values()])
    if isinstance(one, T.ArrayType) and isinstance(two, T.ArrayType):
        return T.ArrayType(wider(one.elementType, two.elementType))
    whole = [T.IntegerType(), T.LongType()]
    if one in whole and two in whole:
        return T.LongType()
    numbers = [*whole, T.DoubleType()]
    return T.DoubleType() if one in numbers and two in numbers else T.StringType()


def infer_csv_schema(spark: SparkSession, files: list[str], **options: object) -> T.StructType:
    """Types of all columns that any header names; a column that has several types gets one that takes them all."""
    known = T.StructType()
    for names, members in header_groups(spark, files, options).items():
        found = spark.read.options(**{"header": "true", **options}).option("inferSchema", "true").csv(members).schema
        first = {f.name.lower(): f for f in reversed([T.StructField(n, f.dataType) for n, f in zip(names, found.fields, strict=False)])}
        known = wider(known, T.StructType([f for _, f in reversed(first.items())]))
    return known


class FileLedger:
    """The files that a stream has taken in, with their length and time: one small parquet folder for each batch."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = spark, folder

    def read(self) -> DataFrame:
        if not exists(self.spark, self.folder):
            return self.spark.createDataFrame([], _FILE)
        return self.spark.read.schema(_FILE + ", batch long").parquet(self.folder).drop("batch")

    def record(self, files: DataFrame, batch: int) -> None:
        """A batch that comes again replaces what it had recorded."""
        files.select("path", "length", "modified").write.mode("overwrite").parquet(f"{self.folder}/batch={batch}")

    def compare(self, files: DataFrame) -> DataFrame:
        """path and status of every file there is or was: new, unchanged, rewritten (length or time differ) or gone."""
        was = self.read().select("path", F.col("length").alias("old_length"), F.col("modified").alias("old_modified"))
        status = (
            F.when(F.col("old_length").isNull(), "new")
            .when(F.col("length").isNull(), "gone")
            .when((F.col("length") == F.col("old_length")) & (F.col("modified") == F.col("old_modified")), "unchanged")
            .otherwise("rewritten")
        )
        return files.join(was, "path", "full").select("path", status.alias("status"))


def append_csv(
    spark: SparkSession,
    landing: str,
    table: str,
    checkpoint: str,
    schema: T.StructType,
    glob: str | None = None,
    max_files_per_trigger: int = 1000,
    rescue: bool = True,
    transform: Callable[[DataFrame], DataFrame] = lambda rows: rows,
    **options: object,
) -> FileLedger:
    """Take the CSV files that are new under `landing` into a parquet table, columns found by name, and stop.

    The stream is one of file names, so files of each micro-batch are grouped by their headers before any row is read. A
    batch is a folder batch=<number> of the table; one that is complete is not written again if its batch is replayed.
    A file is taken in once: what happens to it later is not read again but can be told from the ledger, which is kept
    beside the checkpoint. `transform` is applied to the rows of each batch.
    """
    ledger = FileLedger(spark, f"{checkpoint}/files")
    reader = spark.readStream.format("binaryFile").option("maxFilesPerTrigger", max_files_per_trigger)
    reader = reader.option("recursiveFileLookup", "true")
    reader = reader.option("pathGlobFilter", glob) if glob else reader
    kinds = "path string, modificationTime timestamp, length long, content binary"
    names = reader.schema(kinds).load(landing).select("path", "length", F.col("modificationTime").alias("modified"))

    def take(files: DataFrame, batch: int) -> None:
        if not exists(spark, f"{table}/batch={batch}/_SUCCESS"):
            paths = [row.path for row in files.select("path").collect()]
            rows = transform(read_csv_files(spark, paths, schema, rescue, **options))
            rows.write.mode("overwrite").parquet(f"{table}/batch={batch}")
        ledger.record(files, batch)

    query = names.writeStream.foreachBatch(take).option("checkpointLocation", f"{checkpoint}/stream")
    query.trigger(availableNow=True).start().awaitTermination()
    return ledger
