"""Column names that cannot clash with those a table brings along."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, functions as F


def unused(taken: Iterable[str], name: str) -> str:
    """`name`, behind as many underscores as make it differ from all of `taken` (letters' case aside)."""
    low = {other.lower() for other in taken}
    while name.lower() in low:
        name = "_" + name
    return name


def set_aside(docs: DataFrame, names: Iterable[str]) -> tuple[DataFrame, list[Column]]:
    """`docs` with every column that is named like one of `names` renamed, and the selection that names it back."""
    names = list(names)
    low = {name.lower() for name in names}
    given: dict[str, str] = {}
    for column in docs.columns:
        if column.lower() in low:
            given[column] = unused([*docs.columns, *names, *given.values()], column)
    back = [F.col(f"`{given.get(column, column)}`").alias(column) for column in docs.columns]
    return docs.withColumnsRenamed(given), back
