"""Find keys too big for one task, and cut their history into segments that are not.

An analytic window puts all rows of a key in one task. For a key that holds a large share of a
table that task never ends, so such keys are handled in two levels: windows inside
(key, segment), then a window over one summary row per segment whose result is carried back into
the segments. All of it is part of the plan: nothing runs until rows are asked for, and where no key
is that big adaptive execution drops the second level.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F, types as T

from tidemark.operators.common import SEQ, col
from tidemark.operators.ranges import cuts_of, place_among, sampled

HOT = "_hot"
SEGMENT = "_segment"
LIMIT = "_limit"
HOT_ROWS = 1_000_000
#: Fewer keys than this can be hot, which bounds what is broadcast.
MOST_HOT = 10_000
#: Segments that `LIMIT` rows of a hot key are cut into, on average.
SEGMENTS_A_LIMIT = 4


def hot_keys(df: DataFrame, keys: Sequence[str], hot_rows: int = HOT_ROWS) -> DataFrame:
    """(`_hot`, `_limit`): keys, as structs, with more rows than `hot_rows` and than one in `MOST_HOT` of the table.

    The second condition bounds the answer: fewer than `MOST_HOT` keys can exceed it, so it is safe to broadcast at
    any table size. Reads the key columns only; counts combine on the map side.
    """
    counts = df.groupBy(*map(col, keys)).agg(F.count(F.lit(1)).alias("_rows"))
    share = F.floor(counts.agg(F.sum("_rows")).scalar() / MOST_HOT)
    limit = F.greatest(F.lit(hot_rows).cast("long"), share).alias(LIMIT)
    return counts.select(_whole_key(keys), "_rows", limit).where(F.col("_rows") > F.col(LIMIT)).drop("_rows")


def _whole_key(keys: Sequence[str]) -> Column:
    """The key as one value that is never NULL: structs whose fields are NULL alike are equal, in joins too."""
    return F.struct(*map(col, keys)).alias(HOT)


def split_hot(df: DataFrame, keys: Sequence[str], hot: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rows of ordinary keys, rows of hot keys with the struct `_hot`, and `_limit`, in place of the key)."""
    rows = df.select("*", _whole_key(keys))
    cold = rows.join(F.broadcast(hot.select(HOT)), HOT, "left_anti").drop(HOT)
    return cold, rows.join(F.broadcast(hot), HOT).select(HOT, LIMIT, *[col(c) for c in df.columns if c not in keys])


def restore_keys(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The columns of the key in place of its struct again."""
    rest = [c for c in rows.columns if c != HOT]
    return rows.select(*[F.col(HOT).getField(k).alias(k) for k in keys], *map(col, rest))


def require_order(dtype: T.DataType) -> None:
    """Refuse sequences whose order is not that of events."""
    if isinstance(dtype, T.StructType):
        return require_order(dtype[0].dataType)
    if not isinstance(dtype, (T.NumericType, T.TimestampType, T.DateType, T.TimestampNTZType)):
        raise TypeError(
            f"a sequence of type {dtype.simpleString()} has no usable order: parse it to a timestamp or a "
            "number first (text event times such as MM-dd-yyyy do not even sort by time)"
        )


def segment_cuts(numbered: DataFrame) -> DataFrame:
    """(`_hot`, `_cuts`): ascending sequences that cut each hot key into ranges of about equal depth.

    A sample of the key's distinct sequences, chosen by their hash, places the cuts; whole sequences are compared,
    so the fields of a struct all count. Copies and ties count once. Recomputing a lost partition gives the same
    cuts, and results do not depend on them. All cuts together are fewer than `SEGMENTS_A_LIMIT * MOST_HOT`, about.
    """
    share = F.lit(float(SEGMENTS_A_LIMIT)) / F.col(LIMIT)
    return numbered.where(sampled(F.col(SEQ), share)).groupBy(HOT).agg(cuts_of(F.col(SEQ)).alias("_cuts"))


def add_segments(rows: DataFrame, cuts: DataFrame) -> DataFrame:
    """Number each row's segment. Once (key, sequence) is unique, no (key, segment) is big."""
    placed = rows.join(F.broadcast(cuts), HOT, "left")
    return placed.withColumn(SEGMENT, place_among(F.col(SEQ), F.col("_cuts"))).drop("_cuts")
