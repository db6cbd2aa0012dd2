"""Ranges with fixed cuts, so that rows keep their range however often they are computed.

Cuts come from a sample that a hash of the value chooses. It is the same in every run, takes no digest of the whole
column to one task, and only places the cuts: all rows are ranged.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

MOST_RANGES = 1 << 17
#: Sampled values between two cuts; ranges of 16 differ in depth by about a quarter.
A_CUT = 16
_STEPS = 20


def sampled(value: Column, cuts_a_row: Column) -> Column:
    """Whether the value is in a sample that gives so many cuts a (distinct) row."""
    return F.xxhash64(value).cast("double") < (2 * F.least(F.lit(1.0), cuts_a_row * A_CUT) - 1) * 2.0**63


def cuts_of(value: Column) -> Column:
    """Aggregate: ascending cuts from the distinct values of a sample."""
    return F.filter(F.sort_array(F.collect_set(value)), lambda _, i: i % A_CUT == A_CUT - 1)


def place_among(value: Column, cuts: Column) -> Column:
    """The number of (ascending) cuts at or below the value, by binary search; 0 without cuts, or for NULL."""

    def step(at: Column, width: Column) -> Column:
        return F.when(F.get(cuts, at + width - 1) <= value, at + width).otherwise(at)

    return F.aggregate(F.lit([1 << bit for bit in reversed(range(_STEPS))]), F.lit(0), step)


def range_count(df: DataFrame, rows: int, rows_per_range: int) -> int:
    """As many ranges as the session has shuffle partitions, or more where they would exceed `rows_per_range`."""
    partitions = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return min(MOST_RANGES, max(1, partitions, -(-rows // rows_per_range)))


def range_cuts(df: DataFrame, column: str, rows_per_range: int = 50_000) -> list[int]:
    """Ascending cuts that split the whole numbers of `column` into ranges of about equal counts of distinct values.

    Two passes over the column alone; one task holds the sample, some `A_CUT * MOST_RANGES` numbers at most, and the
    driver a sixteenth of it.
    """
    number = F.col(column).cast("long").alias("v")
    rows = df.select(number).agg(F.count("v")).first()[0]
    ranges = range_count(df, rows, rows_per_range)
    if rows == 0 or ranges == 1:
        return []
    share = F.lit(ranges / rows)
    return df.select(number).where("v IS NOT NULL").where(sampled(F.col("v"), share)).agg(cuts_of(F.col("v"))).first()[0]


def range_index(column: Column, cuts: Sequence[float], kind: str = "bigint") -> Column:
    """The number of (ascending) cuts at or below the value, by binary search; NULL counts as below all."""
    if not cuts:
        return F.lit(0)
    table = F.split(F.lit(",".join(map(repr, cuts)).replace("inf", "Infinity")), ",").cast(f"array<{kind}>")
    steps = F.lit([1 << bit for bit in reversed(range(len(cuts).bit_length()))])

    def step(at: Column, width: Column) -> Column:
        beyond = (at + width <= len(cuts)) & (F.get(table, at + width - 1) <= column.cast(kind))
        return F.when(beyond, at + width).otherwise(at)

    return F.aggregate(steps, F.lit(0), step)
