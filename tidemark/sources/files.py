"""File sources. The streaming readers pick up only files they have not seen (their checkpoint keeps
the list), which is how a landing folder is ingested incrementally."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.sinks.paths import child_files
from tidemark.sources.landing import list_files, read_csv_files
from tidemark.sources.schemas import RESCUED, with_rescue


def _reader(reader, schema: T.StructType, rescue: bool, glob: str | None, options: Mapping[str, object]):
    reader = reader.schema(with_rescue(schema) if rescue else schema).options(**options)
    if rescue:
        reader = reader.option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", RESCUED)
    return reader.option("pathGlobFilter", glob) if glob else reader


def _whole_files(options: Mapping[str, object]) -> bool:
    """Whether records may span lines, so that lines cannot be taken one by one."""
    return str(options.get("multiLine", options.get("multiline", "false"))).lower() == "true"


def _lines(reader, path: str, glob: str | None, whole: bool = False) -> DataFrame:
    return (reader.option("pathGlobFilter", glob) if glob else reader).text(path, wholetext=whole)


def _holds_struct(kind: T.DataType) -> bool:
    return isinstance(kind, T.StructType) or isinstance(kind, T.ArrayType) and _holds_struct(kind.elementType)


def _unknown(text: Column, kind: T.DataType, options: Mapping[str, str], path: Column) -> Column | None:
    """A map from path to JSON text of what `text` holds and `kind` has no place for; None if nothing can be.

    Structs are walked by field (a.b), arrays by place (a[0].b). Only the parts that can hold unknown fields are parsed.
    """
    if isinstance(kind, T.StructType):
        known = [name for name in kind.fieldNames() if name != RESCUED]
        fields = F.from_json(text, "map<string,string>", options)
        strange = F.map_filter(fields, lambda name, value: ~name.isin(known))
        found = [F.transform_keys(strange, lambda name, value: F.concat(path, name))]
        for field in kind.fields:
            inside = F.concat(path, F.lit(field.name))
            inside = F.concat(inside, F.lit(".")) if isinstance(field.dataType, T.StructType) else inside
            more = _unknown(F.element_at(fields, field.name), field.dataType, options, inside)
            if more is not None:
                found.append(F.coalesce(more, F.expr("map()").cast("map<string,string>")))
        return F.map_concat(*found) if len(found) > 1 else found[0]
    if isinstance(kind, T.ArrayType):
        if not _holds_struct(kind.elementType):
            return None
        dot = "]." if isinstance(kind.elementType, T.StructType) else "]"
        items = F.from_json(text, "array<string>", options)

        def entries(element: Column, i: Column) -> Column:
            inside = F.concat(path, F.lit("["), i.cast("string"), F.lit(dot))
            return F.map_entries(_unknown(element, kind.elementType, options, inside))

        each = F.filter(F.transform(items, entries), lambda entry: entry.isNotNull())
        return F.map_from_entries(F.flatten(each))
    return None


def _rescued(lines: DataFrame, schema: T.StructType, options: Mapping[str, object]) -> DataFrame:
    """Records of JSON texts, with the text of everything that `schema` does not take, at any depth.

    Each text is parsed once for the record and once for the rest, inside a generator: filters on the result would
    otherwise be pushed below the projection and parse every text again for each of their columns.
    """
    wanted, line = with_rescue(schema), F.col("value")
    given = {name: str(value) for name, value in options.items() if name.lower() != "multiline"}
    record = F.from_json(line, wanted, {**given, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": RESCUED})
    strange = _unknown(line, schema, given, F.lit(""))
    once = F.inline(F.array(F.struct(record.alias("r"), strange.alias("strange"), line.alias("line"))))
    # a line that is no object (a list, a bare value) has no fields to keep, so it is kept whole
    rest = F.when(F.ltrim("line").startswith("{"), F.when(F.size("strange") > 0, F.to_json("strange"))).otherwise(F.col("line"))
    parsed = lines.where(F.trim(line) != "").select(once)
    columns = [F.col("r").getField(name).alias(name) for name in wanted.fieldNames() if name != RESCUED]
    return parsed.select(*columns, F.coalesce(F.col("r").getField(RESCUED), rest).alias(RESCUED))


def _texts(reader, path: str, glob: str | None, options: Mapping[str, object]) -> DataFrame:
    """JSON texts of the records: lines, or with `multiLine` the elements of each file's list (or its one object)."""
    if not _whole_files(options):
        return _lines(reader, path, glob)
    whole = _lines(reader, path, glob, whole=True)
    text = F.col("value")
    items = F.when(F.regexp_replace(text, r"^\s+", "").startswith("["), F.from_json(text, "array<string>"))
    return whole.select(F.explode(F.coalesce(items, F.array(text))).alias("value"))


def ingest_json(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    glob: str | None = None,
    max_files_per_trigger: int | None = None,
    rescue: bool = True,
    **options: object,
) -> DataFrame:
    """Stream of the JSON-lines files that appear under `path`.

    With `rescue`, what does not fit `schema` is kept as text in `_rescued_data`: the whole text of a record
    that does not parse or has a value of another type, else the fields that the schema has no place for, by their
    path (`a.b`, `a[0].b`) - such as a column that arrived after the schema was inferred. With `multiLine`, a file is one
    list of records, or one record.
    """
    reader = spark.readStream.options(**options) if rescue else _reader(spark.readStream, schema, rescue, glob, options)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return _rescued(_texts(reader, path, glob, options), schema, options) if rescue else reader.json(path)


def read_csv(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, rescue: bool = True, **options: object
) -> DataFrame:
    """CSV files (plain or compressed) under `path`, columns found by the names in each file's header line.

    See `landing.read_csv_files`; `landing.append_csv` takes files in as they come. With header=false there are no
    names, so columns are taken by place.
    """
    if str(options.get("header", "true")).lower() != "true":
        return _reader(spark.read, schema, rescue, glob, options).csv(path)
    return read_csv_files(spark, [row.path for row in list_files(spark, path, glob).select("path").collect()], schema, rescue, **options)


def read_json(
    spark: SparkSession, path: str, schema: T.StructType, glob: str | None = None, rescue: bool = True, **options: object
) -> DataFrame:
    """The same records in one batch."""
    if rescue:
        return _rescued(_texts(spark.read.options(**options), path, glob, options), schema, options)
    return _reader(spark.read, schema, rescue, glob, options).json(path)


def stream_table(
    spark: SparkSession, path: str, schema: T.StructType | None = None, max_files_per_trigger: int | None = None
) -> DataFrame:
    """Stream of the rows appended to a parquet table folder.

    The folder must be append-only (the sinks in `streaming` are): rows already read are never read
    again, whatever later happens to their files.
    """
    reader = spark.readStream.schema(schema if schema is not None else spark.read.parquet(path).schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.parquet(path)


def files_written_for(spark: SparkSession, table: str, source: str, files: int | None) -> int | None:
    """How many files of `table` stand, on average, for so many of the folder `source` that it was written from.

    One source file becomes the more files the larger it is, so a limit on source files has to be carried over: taken
    as it is, it would cut the table into ever more micro-batches as the data grows.
    """
    if not files:
        return None
    written, given = len(child_files(spark, table)), len(child_files(spark, source))
    return max(files, -(-written * files // max(1, given)))
