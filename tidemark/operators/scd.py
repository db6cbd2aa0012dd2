"""Change events folded into slowly changing dimensions of type 1 and type 2.

Events of a key apply in sequence order, whatever order they arrive in:

* a version opens when the key is new, when the event before was a delete, or when a tracked column
  differs (null-safely) from the event before; untracked columns take their last value inside it;
* a version ends at the sequence of the next version or delete; deletes themselves emit no row, and
  a delete of an unknown key still beats older events that arrive later;
* events that share (key, sequence) leave one: the greatest by (is delete, payload). With
  `ignore_null_updates` they merge column by column instead, greater value first;
* events without a sequence cannot be placed and are left out (count them with the quality rules).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from tidemark.operators.canonical import orderable, restored
from tidemark.operators.common import (
    DEL,
    END_AT,
    SEQ,
    START_AT,
    any_of,
    as_column,
    as_predicate,
    col,
    require_columns,
)
from tidemark.operators.skew import (
    HOT,
    HOT_ROWS,
    LIMIT,
    SEGMENT,
    add_segments,
    hot_keys,
    require_order,
    restore_keys,
    segment_cuts,
    split_hot,
)

TOP = "_top"


def prepare_events(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Column,
    delete_when: str | Column | None = None,
    except_columns: Sequence[str] = (),
) -> DataFrame:
    """(keys, sequence, delete flag, payload) of every event that has a sequence."""
    require_columns(changes, keys, "keys")
    payload = [c for c in changes.columns if c not in keys and c not in except_columns]
    events = changes.select(
        *map(col, keys),
        as_column(sequence_by).alias(SEQ),
        as_predicate(delete_when).alias(DEL),
        *map(col, payload),
    ).where(F.col(SEQ).isNotNull())
    require_order(events.schema[SEQ].dataType)
    return events


def payload_of(events: DataFrame, keys: Sequence[str]) -> list[str]:
    return [c for c in events.columns if c not in keys and c not in (SEQ, DEL, HOT, SEGMENT)]


# ---------------------------------------------------------------------------------------- type 1


def scd1_state(events: DataFrame, keys: Sequence[str], ignore_null_updates: bool = False) -> DataFrame:
    """Partial type 1 state, one row per key, deletes included. States of any split of the events
    merge to the same result (`merge_scd1`), so a stream can append them and merge on read."""
    payload = payload_of(events, keys)
    grouped = events.groupBy(*map(col, keys))
    if not ignore_null_updates:
        return grouped.agg(F.max(F.struct(SEQ, DEL, *map(col, payload))).alias(TOP))
    deleted = F.col(DEL)
    values = [
        F.max(
            F.when(deleted | col(c).isNotNull(), F.struct(SEQ, DEL, F.when(~deleted, col(c)).alias("value")))
        ).alias(c)
        for c in payload
    ]
    return grouped.agg(F.max(F.struct(SEQ, DEL)).alias(TOP), *values)


def merge_scd1(states: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One state row per key out of many."""
    rest = [c for c in states.columns if c not in keys]
    return states.groupBy(*map(col, keys)).agg(*[F.max(col(c)).alias(c) for c in rest])


def finish_scd1(state: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Live rows of a merged state: keys and payload."""
    per_column = [c for c in state.columns if c not in keys and c != TOP]
    live = state.where(~F.col(TOP).getField(DEL))
    if per_column:
        return live.select(*map(col, keys), *[col(c).getField("value").alias(c) for c in per_column])
    payload = [f.name for f in state.schema[TOP].dataType if f.name not in (SEQ, DEL)]
    return live.select(*map(col, keys), *[F.col(TOP).getField(c).alias(c) for c in payload])


def fold_scd1(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Column,
    delete_when: str | Column | None = None,
    except_columns: Sequence[str] = (),
    ignore_null_updates: bool = False,
) -> DataFrame:
    """Latest state of every key that is not deleted. One shuffle, combined on the map side, so a key
    with most of the events costs no more than any other."""
    events, kinds = orderable(prepare_events(changes, keys, sequence_by, delete_when, except_columns))
    return restored(finish_scd1(scd1_state(events, keys, ignore_null_updates), keys), kinds)


# ---------------------------------------------------------------------------------------- type 2


def tracked_columns(
    payload: Sequence[str],
    track_history: Sequence[str] | None,
    track_history_except: Sequence[str] | None,
    coalesce_unchanged: bool | None,
) -> list[str] | None:
    """Columns whose change opens a version; None when every event does."""
    if track_history is not None and track_history_except is not None:
        raise ValueError("give track_history or track_history_except, not both")
    listed = track_history is not None or track_history_except is not None
    unknown = [c for c in [*(track_history or []), *(track_history_except or [])] if c not in payload]
    if unknown:
        raise ValueError(f"tracked columns {unknown} are not in the payload {list(payload)}")
    if not (listed if coalesce_unchanged is None else coalesce_unchanged):
        return None
    if track_history is not None:
        return list(track_history)
    return [c for c in payload if c not in (track_history_except or [])]


def fold_scd2(
    changes: DataFrame,
    keys: Sequence[str],
    sequence_by: str | Column,
    delete_when: str | Column | None = None,
    except_columns: Sequence[str] = (),
    track_history: Sequence[str] | None = None,
    track_history_except: Sequence[str] | None = None,
    coalesce_unchanged: bool | None = None,
    ignore_null_updates: bool = False,
    hot_rows: int = HOT_ROWS,
) -> DataFrame:
    """Version history of every key, with `__START_AT` and `__END_AT` (NULL while current).

    Without a tracking list every event is a version; with one, events that change no tracked column
    extend the version before (`coalesce_unchanged` overrides this). Keys over
    `hot_rows` are found and cut inside the plan (see `operators.skew`); no job runs before rows are asked for.
    """
    events, kinds = orderable(prepare_events(changes, keys, sequence_by, delete_when, except_columns))
    tracked = tracked_columns(payload_of(events, keys), track_history, track_history_except, coalesce_unchanged)
    return restored(fold_versions(events, keys, tracked, ignore_null_updates, hot_rows), kinds)


def fold_versions(
    events: DataFrame,
    keys: Sequence[str],
    tracked: Sequence[str] | None,
    ignore_null_updates: bool = False,
    hot_rows: int | None = HOT_ROWS,
) -> DataFrame:
    """`fold_scd2` on prepared events. `hot_rows=None` skips the count where no key can be big."""
    if hot_rows is None:
        return _versions_by_key(events, keys, tracked, ignore_null_updates)
    hot = hot_keys(events, keys, hot_rows)
    cold, numbered = split_hot(events, keys, hot)
    segmented = _versions_by_segment(numbered, tracked, ignore_null_updates)
    return _versions_by_key(cold, keys, tracked, ignore_null_updates).unionByName(
        restore_keys(segmented, keys)
    )


def _versions_by_key(
    events: DataFrame, keys: Sequence[str], tracked: Sequence[str] | None, ignore_null_updates: bool
) -> DataFrame:
    """All windows share one partitioning and one sort: (keys, sequence, ...)."""
    payload = payload_of(events, keys)
    if ignore_null_updates:
        events = _merge_ties(events, keys, payload)
        window = Window.partitionBy(*map(col, keys)).orderBy(SEQ)
        events = events.select(
            *map(col, keys), SEQ, DEL, *[_filled(c, window).getField("value").alias(c) for c in payload]
        )
    else:
        by_rank = Window.partitionBy(*map(col, keys)).orderBy(SEQ, DEL, *map(col, payload))
        follower = F.lead(SEQ).over(by_rank)
        events = events.withColumn("_tied", follower.eqNullSafe(F.col(SEQ))).where(~F.col("_tied")).drop("_tied")
    rows = _with_neighbours(events, keys, tracked)
    opens = F.col("_prev").isNull() | _breaks(F.col("_prev"), tracked)
    running = Window.partitionBy(*map(col, keys)).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn(START_AT, F.max(F.when(opens, F.col(SEQ))).over(running))
    return _closing_rows(rows, keys, payload, tracked)


def _versions_by_segment(
    numbered: DataFrame, tracked: Sequence[str] | None, ignore_null_updates: bool
) -> DataFrame:
    """The same history for hot keys, by their structs. Windows run inside (key, segment); what they need from
    outside the segment - the event before its first, the event after its last, the latest opening before
    it - comes from a window over one summary row per segment."""
    cuts, numbered = segment_cuts(numbered), numbered.drop(LIMIT)
    payload = payload_of(numbered, [])
    if ignore_null_updates:
        rows = _fill_by_segment(add_segments(_merge_ties(numbered, [HOT], payload), cuts), payload)
    else:
        # exact copies and other ties collapse before the shuffle
        top = numbered.groupBy(HOT, SEQ).agg(F.max(F.struct(DEL, *map(col, payload))).alias(TOP))
        rows = add_segments(top.select(HOT, SEQ, f"{TOP}.*"), cuts)

    part = [HOT, SEGMENT]
    rows = _with_neighbours(rows, part, tracked)
    inner = F.col("_prev").isNotNull() & _breaks(F.col("_prev"), tracked)
    running = Window.partitionBy(*part).orderBy(SEQ).rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumn(START_AT, F.max(F.when(inner, F.col(SEQ))).over(running))

    # the summary reads the same columns as the rows it is joined to, so both share one shuffle
    untracked = [c for c in payload if c not in (tracked or [])]
    whole = F.struct(SEQ, DEL, *map(col, [*(tracked or []), *untracked]))
    edges = rows.groupBy(*part).agg(
        F.min(_event(tracked)).alias("_first"), F.max(whole).alias("_last"), F.max(START_AT).alias("_opened")
    )
    by_segment = Window.partitionBy(HOT).orderBy(SEGMENT)
    edges = edges.withColumn("_before", F.lag("_last").over(by_segment)).withColumn(
        "_after", F.lead("_first").over(by_segment)
    )
    first_opens = F.col("_before").isNull() | _breaks(F.col("_before"), tracked, F.col("_first"))
    edges = edges.withColumn("_entry", F.when(first_opens, F.col("_first").getField(SEQ)))
    opened = F.max(F.coalesce("_opened", "_entry")).over(by_segment.rowsBetween(Window.unboundedPreceding, -1))
    carry = edges.select(*part, "_before", "_after", F.coalesce("_entry", opened).alias("_carried"))

    rows = (
        rows.join(carry, part)
        .withColumn("_next", F.coalesce("_next", "_after"))
        .withColumn(START_AT, F.coalesce(START_AT, "_carried"))
    )
    return _closing_rows(rows, [HOT], payload, tracked)


def _event(tracked: Sequence[str] | None) -> Column:
    return F.struct(SEQ, DEL, *map(col, tracked or []))


def _with_neighbours(rows: DataFrame, part: Sequence[str], tracked: Sequence[str] | None) -> DataFrame:
    window = Window.partitionBy(*map(col, part)).orderBy(SEQ)
    event = _event(tracked)
    return rows.withColumns({"_prev": F.lag(event).over(window), "_next": F.lead(event).over(window)})


def _breaks(before: Column, tracked: Sequence[str] | None, after: Column | None = None) -> Column:
    """Does an event (this row by default) end the version of the event before it?"""
    if tracked is None:
        return F.lit(True)

    def field(name: str) -> Column:
        return col(name) if after is None else after.getField(name)

    changed = [~before.getField(c).eqNullSafe(field(c)) for c in tracked]
    return any_of([field(DEL), before.getField(DEL), *changed])


def _closing_rows(
    rows: DataFrame, keys: Sequence[str], payload: Sequence[str], tracked: Sequence[str] | None
) -> DataFrame:
    """The last event of each version carries its latest values, and the event after ends it."""
    nxt = F.col("_next")
    if tracked is None:
        last = F.lit(True)
    else:
        changed = [~nxt.getField(c).eqNullSafe(col(c)) for c in tracked]
        last = nxt.isNull() | any_of([nxt.getField(DEL), *changed])
    return rows.where(~F.col(DEL) & last).select(
        *map(col, keys), *map(col, payload), START_AT, nxt.getField(SEQ).alias(END_AT)
    )


def _merge_ties(events: DataFrame, part: Sequence[str], payload: Sequence[str]) -> DataFrame:
    """One event per (key, sequence), merged column by column; a delete blanks the payload."""
    merged = events.groupBy(*map(col, part), SEQ).agg(
        F.max(DEL).alias(DEL), *[F.max(col(c)).alias(c) for c in payload]
    )
    return merged.withColumns({c: F.when(~F.col(DEL), col(c)) for c in payload})


def _set_value(name: str) -> Column:
    """What an event writes to a column: its value, NULL if it deletes; nothing if it leaves it."""
    return F.when(F.col(DEL) | col(name).isNotNull(), F.struct(col(name).alias("value")))


def _filled(name: str, window) -> Column:
    return F.last(_set_value(name), ignorenulls=True).over(window.rowsBetween(Window.unboundedPreceding, 0))


def _fill_by_segment(rows: DataFrame, payload: Sequence[str]) -> DataFrame:
    """Running last non-NULL value per column, reset at deletes, across the segments of a hot key."""
    part = [HOT, SEGMENT]
    carried = {c: f"_carried_{i}" for i, c in enumerate(payload)}
    ends = rows.groupBy(*part).agg(
        *[F.max_by(_set_value(c), F.when(_set_value(c).isNotNull(), F.col(SEQ))).alias(carried[c]) for c in payload]
    )
    before = Window.partitionBy(HOT).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    ends = ends.select(*part, *[F.last(n, ignorenulls=True).over(before).alias(n) for n in carried.values()])
    window = Window.partitionBy(*part).orderBy(SEQ)
    local = rows.withColumns({c: _filled(c, window) for c in payload})
    values = [F.coalesce(col(c), F.col(carried[c])).getField("value").alias(c) for c in payload]
    return local.join(ends, part).select(HOT, SEGMENT, SEQ, DEL, *values)


# -------------------------------------------------------------------------------------- readers


def current_dimension(
    versions: DataFrame,
    columns: Sequence[str] | None = None,
    start_name: str = "record_effective_from",
    end_name: str = "record_effective_to",
) -> DataFrame:
    """Open versions only, with the effective-dating columns under their reporting names."""
    names = columns if columns is not None else [c for c in versions.columns if c not in (START_AT, END_AT)]
    return versions.where(F.col(END_AT).isNull()).select(
        *map(col, names), F.col(START_AT).alias(start_name), F.col(END_AT).alias(end_name)
    )
