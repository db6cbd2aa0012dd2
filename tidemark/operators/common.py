"""Small helpers the operators share."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, functions as F

START_AT = "__START_AT"
END_AT = "__END_AT"
SEQ = "_seq"
DEL = "_del"


def col(name: str) -> Column:
    """A column by its exact name, dots included."""
    return F.col("`" + name.replace("`", "``") + "`")


def as_column(value: str | Column) -> Column:
    return col(value) if isinstance(value, str) else value


def as_predicate(value: str | Column | None) -> Column:
    """A SQL condition or Column as a two-valued flag: NULL counts as false."""
    if value is None:
        return F.lit(False)
    return F.coalesce(F.expr(value) if isinstance(value, str) else value, F.lit(False))


def others(df: DataFrame, *groups: Sequence[str]) -> list[str]:
    """Columns of `df` in none of the groups, in table order."""
    named = {name for group in groups for name in group}
    return [name for name in df.columns if name not in named]


def require_columns(df: DataFrame, names: Sequence[str], what: str) -> None:
    absent = [name for name in names if name not in df.columns]
    if absent:
        raise ValueError(f"{what}: no such column {absent}; the table has {df.columns}")


def any_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a | b, conditions, F.lit(False))


def all_of(conditions: Sequence[Column]) -> Column:
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def join_on(
    left: DataFrame, right: DataFrame, keys: Sequence[str], how: str = "inner", take: Sequence[str] = ()
) -> DataFrame:
    """Null-safe join on the keys both sides have; adds the columns `take` of `right` to those of `left`.

    The right side is renamed first, so the sides may derive from each other.
    """
    aliases = [f"_key_{i}" for i in range(len(keys))]
    renamed = right.select(
        *[col(k).alias(a) for k, a in zip(keys, aliases, strict=True)], *[col(c).alias(c) for c in take]
    )
    match = all_of([col(k).eqNullSafe(F.col(a)) for k, a in zip(keys, aliases, strict=True)])
    return left.join(renamed, match, how).drop(*aliases)
