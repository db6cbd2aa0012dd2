"""Keep one row per key: the one that ranks highest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tidemark.operators.canonical import orderable, restored
from tidemark.operators.common import col, others, require_columns


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """The row of each key with the greatest `order_by` values.

    Rows equal on `order_by` are ranked by the rest of their columns, so the result does not depend
    on partitioning. `max(struct)` combines on the map side: however many rows a key has, each map
    task sends one.
    """
    require_columns(df, [*keys, *order_by], "latest_by_key")
    df, kinds = orderable(df)
    order = [name for name in order_by if name not in keys]
    ranked = [*order, *others(df, keys, order)]
    if not ranked:
        return restored(df.select(*map(col, keys)).distinct(), kinds)
    top = df.groupBy(*map(col, keys)).agg(F.max(F.struct(*map(col, ranked))).alias("_top"))
    fields = {name: F.col("_top").getField(name).alias(name) for name in ranked}
    return restored(top.select(*[fields[name] if name in fields else col(name) for name in df.columns]), kinds)


def dedupe_by_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Keyed de-duplication that keeps the same row on every run (see `latest_by_key`)."""
    return latest_by_key(df, keys, order_by)
