"""Schemas of file sources: infer once, pin named columns, add new columns, keep bad records."""

from __future__ import annotations

from pyspark.sql import SparkSession, types as T

RESCUED = "_rescued_data"


def infer_schema(
    spark: SparkSession, path: str, file_format: str, sampling_ratio: float = 1.0, **options: str
) -> T.StructType:
    """Column types found in the files now. A separate batch step: store the result (`schema.json()`)
    and hand it to the stream. CSV columns are those that any file's header names. Lower `sampling_ratio` to read only part of a large landing folder."""
    reader = spark.read.options(**options).option("samplingRatio", sampling_ratio)
    if file_format == "csv" and options.get("header", "true") == "true":
        from tidemark.sources.landing import infer_csv_schema, list_files

        given = {name: value for name, value in options.items() if name != "pathGlobFilter"}
        files = [row.path for row in list_files(spark, path, options.get("pathGlobFilter")).select("path").collect()]
        return infer_csv_schema(spark, files, samplingRatio=sampling_ratio, **given)
    if file_format == "csv":
        reader = reader.option("inferSchema", "true")
    return reader.format(file_format).load(path).schema


def _ddl(spark_type_list: str) -> T.StructType:
    return T.StructType.fromDDL(spark_type_list)


def merge_schema_hints(inferred: T.StructType, hints: str) -> T.StructType:
    """Override the types of columns named in a DDL list ("a TIMESTAMP, b INT"); unknown ones are added."""
    hinted = {field.name.lower(): field for field in _ddl(hints).fields}
    fields = [
        T.StructField(f.name, hinted.pop(f.name.lower()).dataType if f.name.lower() in hinted else f.dataType)
        for f in inferred.fields
    ]
    return T.StructType(fields + list(hinted.values()))


def evolve_schema(known: T.StructType, seen: T.StructType) -> T.StructType:
    """`known` with the columns (or fields of structs) only `seen` has appended as nullable. Known types
    stay as they are: a value that no longer fits goes to the rescued column."""
    fresh = {f.name.lower(): f for f in seen.fields}
    fields = []
    for field in known.fields:
        other = fresh.pop(field.name.lower(), field).dataType
        nested = isinstance(field.dataType, T.StructType) and isinstance(other, T.StructType)
        kind = evolve_schema(field.dataType, other) if nested else field.dataType
        fields.append(T.StructField(field.name, kind, True))
    return T.StructType(fields + [T.StructField(f.name, f.dataType, True) for f in fresh.values()])


def with_rescue(schema: T.StructType) -> T.StructType:
    """The schema plus the column that keeps the text of records that do not fit it."""
    if RESCUED in schema.fieldNames():
        return schema
    return T.StructType([*schema.fields, T.StructField(RESCUED, T.StringType(), True)])
