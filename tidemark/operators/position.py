"""Line two tables up by row position, under an explicit order."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tidemark.operators.common import col, others
from tidemark.operators.ranges import cuts_of, place_among, sampled

POSITION = "_position"
ROWS_PER_RANGE = 1_000_000
MOST_RANGES = 10_000
#: Copies of one row are numbered by so many at once.
COPIES = 100_000
_PREFIX = 64


def _cut_key(df: DataFrame, order: Sequence[str], asked: int) -> Column:
    """What the cuts compare: the columns that were asked for, and the others up to the first that may be long, of
    which a prefix counts. Equal or ascending wherever the rows are."""
    parts = []
    for place, name in enumerate(order):
        kind, value = df.schema[name].dataType, F.col("row").getField(name)
        fixed = isinstance(kind, (T.NumericType, T.DatetimeType, T.BooleanType))
        if place < asked or fixed:
            parts.append(value)
            continue
        if isinstance(kind, T.StringType) and kind.collation == "UTF8_BINARY":
            parts.append(F.substring(value, 1, _PREFIX))
        break
    return F.struct(*[part.alias(f"c{i}") for i, part in enumerate(parts)])


def with_position(df: DataFrame, order_by: Sequence[str]) -> DataFrame:
    """Add the 1-based rank of each row in the whole table.

    Fixed cuts deal the order into ranges; a row's position is its place in its range plus the sizes of the ranges
    before, a table of one row per range. Ties fall back to the other columns. Full copies of a row are one row with a
    count until the end, so however many there are no range holds them. All of it is in the plan: no jobs run before rows
    are asked for, nothing is sorted as a whole, and lost tasks give the same numbers again.
    """
    order = [*order_by, *others(df, order_by)]
    width = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    total = df.agg(F.count(F.lit(1)).alias("n"))
    ranges = F.least(F.lit(MOST_RANGES), F.greatest(F.lit(width), F.col("n") / ROWS_PER_RANGE))
    share = total.select((ranges / F.greatest("n", F.lit(1))).alias("share")).scalar()
    key, whole = _cut_key(df, order, len(order_by)), df.select(F.struct(*map(col, order)).alias("row"))
    cuts = whole.select(key.alias("key")).where(sampled(F.col("key"), share)).agg(cuts_of(F.col("key")).alias("cuts")).scalar()

    counted = whole.groupBy("row").agg(F.count(F.lit(1)).alias("n"))
    beside = counted.select("*", cuts.alias("cuts"))  # no subquery may stand inside a higher-order function
    placed = beside.select("row", "n", place_among(key, F.col("cuts")).alias("range"))
    sizes = placed.groupBy("range").agg(F.sum("n").alias("size"))
    before = F.sum("size").over(Window.orderBy("range").rowsBetween(Window.unboundedPreceding, -1))
    offsets = sizes.select("range", F.coalesce(before, F.lit(0)).alias("offset"))
    inside = F.sum("n").over(Window.partitionBy("range").orderBy("row").rowsBetween(Window.unboundedPreceding, -1))
    started = placed.withColumn("inside", F.coalesce(inside, F.lit(0))).join(F.broadcast(offsets), "range")
    first = F.expr("explode(sequence(offset + inside + 1, offset + inside + n, %d))" % COPIES)
    chunks = started.select("row", F.expr("offset + inside + n").alias("last"), first.alias("first"))
    each = F.expr("explode(sequence(first, least(last, first + %d)))" % (COPIES - 1))
    numbered = chunks.repartition("first").select("row", each.alias(POSITION))
    return numbered.select(*[F.col("row").getField(name).alias(name) for name in df.columns], POSITION)


def zip_rows(left: DataFrame, right: DataFrame, left_order: Sequence[str], right_order: Sequence[str]) -> DataFrame:
    """Row n of `left` beside row n of `right`, as far as the shorter table goes."""
    return with_position(left, left_order).join(with_position(right, right_order), POSITION)
