"""MAP and VARIANT columns in a form that can be compared, grouped and ranked, and back."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.common import col


def needs_form(kind: T.DataType) -> bool:
    """Whether values of the type hold a MAP or VARIANT at any depth, which Spark does not order."""
    if isinstance(kind, (T.MapType, T.VariantType)):
        return True
    if isinstance(kind, T.ArrayType):
        return needs_form(kind.elementType)
    return isinstance(kind, T.StructType) and any(needs_form(f.dataType) for f in kind.fields)


def to_form(value: Column, kind: T.DataType) -> Column:
    """Maps as entries sorted by key, variants as their type and JSON text, inside structs and arrays too."""
    if not needs_form(kind):
        return value
    if isinstance(kind, T.VariantType):
        return F.when(value.isNotNull(), F.struct(F.to_json(value).alias("text"), F.schema_of_variant(value).alias("type")))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: to_form(item, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.transform(
            F.map_entries(value),
            lambda e: F.struct(to_form(e["key"], kind.keyType).alias("key"), to_form(e["value"], kind.valueType).alias("value")),
        )
        return F.array_sort(entries)
    fields = [to_form(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def from_form(value: Column, kind: T.DataType) -> Column:
    """The value that `to_form` was given; entries of a map come back in order of their keys."""
    if not needs_form(kind):
        return value
    if isinstance(kind, T.VariantType):
        return F.parse_json(value.getField("text"))
    if isinstance(kind, T.ArrayType):
        return F.transform(value, lambda item: from_form(item, kind.elementType))
    if isinstance(kind, T.MapType):
        entries = F.transform(
            value, lambda e: F.struct(from_form(e["key"], kind.keyType).alias("key"), from_form(e["value"], kind.valueType).alias("value"))
        )
        return F.map_from_entries(entries)
    fields = [from_form(value.getField(f.name), f.dataType).alias(f.name) for f in kind.fields]
    return F.when(value.isNotNull(), F.struct(*fields))


def orderable(df: DataFrame) -> tuple[DataFrame, dict[str, T.DataType]]:
    """The table with every MAP or VARIANT in its form, and the types of the columns that changed.

    Two maps with the same entries get one form, whatever their order. A variant is compared by its JSON text and type; it
    comes back as that text parsed, so dates, times and binary values inside a variant come back as text.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields if needs_form(f.dataType)}
    return df.withColumns({name: to_form(col(name), kind) for name, kind in kinds.items()}) if kinds else df, kinds


def restored(df: DataFrame, kinds: dict[str, T.DataType]) -> DataFrame:
    """The columns of `kinds` that `df` has in their own types again."""
    back = {name: from_form(col(name), kind) for name, kind in kinds.items() if name in df.columns}
    return df.withColumns(back) if back else df
