"""Compare two states of a table: change feed, and expected-against-found reconciliation.

Neither joins: both sides are stacked and grouped by key, which needs one pass over each side, is
NULL-safe on the keys, and cannot blow up on repeated keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.canonical import orderable, restored
from tidemark.operators.common import col, others, require_columns

OLD, NEW = "_old", "_new"


def pair_by_key(old: DataFrame, new: DataFrame, keys: Sequence[str], what: str = "pair_by_key") -> DataFrame:
    """One row per key with the whole old and new row as structs (NULL where a side lacks the key).

    The keys must identify rows on each side; a repeated key fails the query instead of losing a row.
    """
    for side in (old, new):
        require_columns(side, keys, what)
    old_row = F.struct(F.lit(True).alias("_present"), *map(col, others(old, keys)))
    new_row = F.struct(F.lit(True).alias("_present"), *map(col, others(new, keys)))
    stacked = old.select(*map(col, keys), old_row.alias(OLD)).unionByName(
        new.select(*map(col, keys), new_row.alias(NEW)), allowMissingColumns=True
    )
    paired = stacked.groupBy(*map(col, keys)).agg(
        F.max(OLD).alias(OLD), F.max(NEW).alias(NEW), F.greatest(F.count(OLD), F.count(NEW)).alias("_rows")
    )
    unique = F.assert_true(F.col("_rows") == 1, F.lit(f"{what}: the keys {list(keys)} repeat; de-duplicate first"))
    return paired.where(unique.isNull()).drop("_rows")


def change_feed(old: DataFrame, new: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Row changes that turn `old` into `new`: insert, delete, update_preimage, update_postimage."""
    payload = others(new, keys)
    if sorted(payload) != sorted(others(old, keys)):
        raise ValueError("change_feed: both versions must have the same columns")
    (old, _), (new, kinds) = orderable(old), orderable(new)
    paired = pair_by_key(old, new, keys, "change_feed")
    before, after = F.col(OLD), F.col(NEW)
    same = [before.getField(c).eqNullSafe(after.getField(c)) for c in payload]
    changed = F.lit(False)
    for flag in same:
        changed = changed | ~flag

    def image(kind: str, side) -> F.Column:
        return F.struct(F.lit(kind).alias("_change_type"), *[side.getField(c).alias(c) for c in payload])

    images = (
        F.when(before.isNull(), F.array(image("insert", after)))
        .when(after.isNull(), F.array(image("delete", before)))
        .when(changed, F.array(image("update_preimage", before), image("update_postimage", after)))
    )
    return restored(paired.select(*map(col, keys), F.inline(images)), kinds)


def reconcile(
    expected: DataFrame, found: DataFrame, keys: Sequence[str], compare: Sequence[str] | None = None
) -> DataFrame:
    """Per key: matched, missing, unexpected or different, with the row counts of both sides.

    Compares the rows of a key as multisets, so repeated keys are compared exactly. Identical rows
    collapse on the map side before anything is shuffled.
    """
    names = list(compare) if compare is not None else others(expected, keys)
    for side in (expected, found):
        require_columns(side, [*keys, *names], "reconcile")
    (expected, kinds), (found, _) = orderable(expected), orderable(found)

    def tagged(side: DataFrame, wanted: int) -> DataFrame:
        return side.select(*map(col, [*keys, *names]), F.lit(wanted).alias("_wanted"))

    rows = (
        tagged(expected, 1)
        .unionByName(tagged(found, 0))
        .groupBy(*map(col, [*keys, *names]))
        .agg(F.sum("_wanted").alias("_expected"), F.sum(1 - F.col("_wanted")).alias("_found"))
    )
    sides = rows.groupBy(*map(col, keys)).agg(
        F.sum("_expected").alias("expected_rows"),
        F.sum("_found").alias("found_rows"),
        F.max(F.col("_expected") != F.col("_found")).alias("_differs"),
    )
    status = (
        F.when(F.col("found_rows") == 0, "missing")
        .when(F.col("expected_rows") == 0, "unexpected")
        .when(F.col("_differs"), "different")
        .otherwise("matched")
    )
    return restored(sides.select(*map(col, keys), "expected_rows", "found_rows", status.alias("status")), kinds)


def reconcile_summary(reconciled: DataFrame) -> DataFrame:
    """Key counts per status."""
    return reconciled.groupBy("status").agg(F.count(F.lit(1)).alias("keys"))
