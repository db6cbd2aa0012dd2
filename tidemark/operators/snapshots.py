"""Type 2 history from full snapshots: a key missing from a snapshot was deleted."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.common import DEL, END_AT, SEQ, START_AT, any_of, col, others
from tidemark.operators.pairing import NEW, OLD, pair_by_key
from tidemark.operators.scd import fold_versions, tracked_columns


def open_history(snapshot: DataFrame, version: Column) -> DataFrame:
    """The history after the first snapshot: every row is current."""
    return snapshot.withColumns({START_AT: version, END_AT: F.when(F.lit(False), version)})


def apply_snapshot_scd2(
    history: DataFrame,
    snapshot: DataFrame,
    version: Column,
    keys: Sequence[str],
    track_history: Sequence[str] | None = None,
    track_history_except: Sequence[str] | None = None,
) -> DataFrame:
    """History after one more snapshot.

    Only open versions are matched against the snapshot; closed ones pass through unshuffled. A version
    not after everything already applied fails the query. The snapshot must have one row per key
    (`dedupe_by_key`).
    """
    payload = others(snapshot, keys)
    tracked = tracked_columns(payload, track_history, track_history_except, True) or []
    newest = F.greatest(F.col(START_AT), F.col(END_AT))
    in_order = F.assert_true(newest < version, F.lit("apply_snapshot_scd2: this version is not newer than the history"))
    history = history.where(in_order.isNull())
    closed = history.where(F.col(END_AT).isNotNull())
    paired = pair_by_key(history.where(F.col(END_AT).isNull()), snapshot, keys, "apply_snapshot_scd2")

    old, new = F.col(OLD), F.col(NEW)
    nothing = F.when(F.lit(False), version)

    def row(side: Column, start: Column, end: Column) -> Column:
        return F.struct(*[side.getField(c).alias(c) for c in payload], start.alias(START_AT), end.alias(END_AT))

    differs = any_of([~old.getField(c).eqNullSafe(new.getField(c)) for c in tracked])
    since = old.getField(START_AT)
    rows = (
        F.when(old.isNull(), F.array(row(new, version, nothing)))
        .when(new.isNull(), F.array(row(old, since, version)))
        .when(differs, F.array(row(old, since, version), row(new, version, nothing)))
        .otherwise(F.array(row(new, since, nothing)))
    )
    return closed.unionByName(paired.select(*map(col, keys), F.inline(rows)))


def fold_snapshots_scd2(
    snapshots: DataFrame,
    keys: Sequence[str],
    version: str,
    track_history: Sequence[str] | None = None,
    track_history_except: Sequence[str] | None = None,
) -> DataFrame:
    """History from many snapshots stacked in one table, in a single pass over it.

    A row whose key is absent from the next snapshot is followed by a delete at that snapshot's version.
    A key has at most one row per snapshot, so no key is big. The list of versions (one row per
    snapshot) is matched by an ordinary join, which Spark broadcasts when it is small.
    """
    payload = others(snapshots, keys, [version])
    tracked = tracked_columns(payload, track_history, track_history_except, True)
    versions = snapshots.select(col(version)).distinct()
    following = versions.select(
        col(version), F.lead(col(version)).over(Window.partitionBy(F.lit(0)).orderBy(col(version))).alias("_following")
    )
    seen_again = F.lead(col(version)).over(Window.partitionBy(*map(col, keys)).orderBy(col(version)))
    rows = snapshots.join(following, version).withColumn("_seen_again", seen_again)
    single = F.assert_true(
        ~F.col("_seen_again").eqNullSafe(col(version)),
        F.lit(f"fold_snapshots_scd2: the keys {list(keys)} repeat inside a snapshot; de-duplicate first"),
    )
    rows = rows.where(single.isNull())
    vanishes = F.col("_following").isNotNull() & ~F.col("_seen_again").eqNullSafe(F.col("_following"))

    def event(sequence: Column, delete: bool) -> Column:
        return F.struct(sequence.alias(SEQ), F.lit(delete).alias(DEL), *map(col, payload))

    stays = event(col(version), False)
    events = F.when(vanishes, F.array(stays, event(F.col("_following"), True))).otherwise(F.array(stays))
    return fold_versions(rows.select(*map(col, keys), F.inline(events)), keys, tracked, hot_rows=None)
