"""Type 1 and type 2 tables kept up to date from a stream of change events.

Both apply micro-batches in any order of event time: late events are put where their sequence says.
Both are idempotent: a batch that was published already is skipped, one that was not is redone.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F, types as T

from tidemark.operators.quality import Rules, expect_or_drop, expectation_metrics
from tidemark.operators.common import DEL, END_AT, SEQ, START_AT, all_of, col, join_on
from tidemark.operators.latest import latest_by_key
from tidemark.operators.scd import (
    finish_scd1,
    fold_versions,
    merge_scd1,
    payload_of,
    prepare_events,
    scd1_state,
    tracked_columns,
)
from tidemark.operators.skew import HOT_ROWS
from tidemark.sinks.batch_folders import BUCKET, STEP, BatchFolders, bucket_of

GONE = "_gone"
HEAD = "_head"
FIRST, LAST = "_first", "_last"
LOW, HIGH = "_low", "_high"
KEEP_SECONDS = 7 * 86400
SIZED_CACHE = "spark.sql.optimizer.canChangeCachedPlanOutputPartitioning"
#: Types whose limits the statistics of parquet files answer for.
ORDERED = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.StringType, T.DateType, T.TimestampType, T.TimestampNTZType)


def persisted(df: DataFrame) -> DataFrame:
    """`df.persist()`, in as many partitions as its size asks for: by default a kept result has all the shuffle
    partitions, however few its rows, and each of its readers that shuffles cuts each of them as often again."""
    conf = df.sparkSession.conf
    before = conf.get(SIZED_CACHE, None)
    conf.set(SIZED_CACHE, "true")
    try:
        return df.persist()
    finally:
        conf.set(SIZED_CACHE, before) if before is not None else conf.unset(SIZED_CACHE)


def limits_of(rows: DataFrame, low: dict[str, str], high: dict[str, str]) -> Column:
    """A filter that only compares columns with literals, so that it reaches the scan: every column of `low` is at least
    the least value of the named column of `rows`, every one of `high` at most the greatest. A value that is NULL, or of
    a type without file statistics, sets no limit."""
    kinds = {f.name: type(f.dataType) for f in rows.schema.fields}
    sides = [(place, name, F.min, "ge") for place, name in low.items()] + [(place, name, F.max, "le") for place, name in high.items()]
    sides = [side for side in sides if kinds[side[1]] in ORDERED]
    if not sides:
        return F.lit(True)
    found = rows.agg(
        *[F.when(F.count(col(name)) == F.count("*"), edge(col(name))).alias(f"limit_{i}") for i, (_, name, edge, _) in enumerate(sides)]
    ).first()
    limits = [(place, way, found[i], kinds[name]) for i, (place, name, _, way) in enumerate(sides) if found[i] is not None]
    at = lambda value, kind: F.lit(value).cast(kind())
    return all_of([col(p) >= at(v, k) if way == "ge" else col(p) <= at(v, k) for p, way, v, k in limits])


class _ChangeTable:
    tables: tuple[str, ...] = ()

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        sequence_by,
        delete_when=None,
        except_columns: Sequence[str] = (),
        ignore_null_updates: bool = False,
        buckets: int = 64,
        compact_every: int = 32,
        keep_seconds: float = KEEP_SECONDS,
    ):
        self.spark, self.keys = spark, list(keys)
        self.sequence_by, self.delete_when, self.except_columns = sequence_by, delete_when, list(except_columns)
        self.ignore_null_updates, self.buckets = ignore_null_updates, buckets
        settings = {"keys": self.keys, "buckets": buckets, "ignore_null_updates": ignore_null_updates}
        self.compact_every, self.keep_seconds = compact_every, keep_seconds
        self.store = BatchFolders(spark, root, self.tables, settings)

    def _events(self, batch: DataFrame) -> DataFrame:
        return prepare_events(batch, self.keys, self.sequence_by, self.delete_when, self.except_columns)

    def apply(self, batch: DataFrame, batch_id: int) -> None:
        """Apply one micro-batch; the signature `foreachBatch` expects."""
        last = self.store.last_step()
        if batch_id < last:
            raise ValueError(
                f"{self.store.root} is at batch {last} and was given batch {batch_id}: "
                "this stream's checkpoint does not belong to the table"
            )
        if batch_id > last:
            folders = self._apply(self._events(batch), batch_id, self.store.folders())
            self.store.publish(batch_id, folders)
            if max(map(len, folders.values())) >= self.compact_every:
                self.compact()

    def compact(self) -> None:
        """Rewrite every part that has several folders as one, and delete what has been unused for `keep_seconds`.

        An ordinary job over the table: it runs between batches, after every `compact_every` of them or whenever it is
        called. Readers see the same rows before and after.
        """
        folders, step = self.store.folders(), self.store.last_step()
        if any(len(several) > 1 for several in folders.values()):
            for part, (merge, order) in self._merges().items():
                if len(folders[part]) > 1:
                    folders[part] = [self.store.write(merge(self.store.read(part, folders[part])), part, step, order)]
            self.store.publish(step, folders)
        self.store.remove_unused(self.keep_seconds)

    def _merges(self) -> dict[str, tuple]:
        """Per part: how rows of several folders become one row each, and the order of rows in a file."""
        raise NotImplementedError

    def _apply(self, events: DataFrame, batch_id: int, folders: dict[str, list[str]]) -> dict[str, list[str]]:
        raise NotImplementedError


class Scd1Table(_ChangeTable):
    """Latest row per key. A batch appends its partial state (one row per key in it, deletes included);
    reading merges the states. Writing never looks at older data, so its cost is the batch's alone."""

    tables = ("state",)

    def _apply(self, events: DataFrame, batch_id: int, folders: dict[str, list[str]]) -> dict[str, list[str]]:
        state = scd1_state(events, self.keys, self.ignore_null_updates)
        state = state.withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        written = self.store.write(state, "state", batch_id, self.keys)
        if not self.store.buckets_in(written):
            return folders
        return {"state": [*folders["state"], written]}

    def _merges(self) -> dict[str, tuple]:
        # deletes stay, because an older event may still arrive
        return {"state": (lambda rows: merge_scd1(rows.drop(STEP), [*self.keys, BUCKET]), self.keys)}

    def read(self) -> DataFrame | None:
        """The current rows; None before the first batch."""
        states = self.store.read("state", self.store.folders()["state"])
        if states is None:
            return None
        return finish_scd1(merge_scd1(states.drop(STEP, BUCKET), self.keys), self.keys)


class Scd2Table(_ChangeTable):
    """Version history, kept in three append-only parts:

    * `events`, the log of all events, read again only for keys with late events;
    * `versions`: a version is identified by (key, `__START_AT`); the newest row with that identity counts,
      and may say that the version is gone;
    * `heads`, one row per key: its last sequence and its open version.

    Events later than their key's head are folded onto the open version alone: the cost of a batch in order
    is that of the batch and the heads of its buckets, however long the histories are. For late events the
    stretch of history they can change is taken from the log and folded again. Only the buckets of late keys are read
    for it, and of their files only the row groups whose statistics meet the limits of those keys and sequences.
    """

    tables = ("events", "versions", "heads")

    def __init__(
        self,
        *args,
        track_history: Sequence[str] | None = None,
        track_history_except: Sequence[str] | None = None,
        coalesce_unchanged: bool | None = None,
        hot_rows: int = HOT_ROWS,
        **kwargs,
    ):
        super().__init__(*args, **kwargs)
        self.tracking = (track_history, track_history_except, coalesce_unchanged)
        listed = [None if names is None else sorted(names) for names in self.tracking[:2]]
        self.store.settings |= {"track_history": listed[0], "track_history_except": listed[1], "coalesce_unchanged": coalesce_unchanged}
        self.hot_rows = hot_rows

    def _apply(self, events: DataFrame, batch_id: int, folders: dict[str, list[str]]) -> dict[str, list[str]]:
        events = self._distinct_events(events).withColumn(BUCKET, bucket_of(self.keys, self.buckets))
        written = {"events": self.store.write(events, "events", batch_id, [*self.keys, SEQ])}
        touched = self.store.buckets_in(written["events"])
        if not touched:
            return folders
        new = self.store.read("events", [written["events"]]).drop(STEP)
        kept: list[DataFrame] = []

        def keep(df: DataFrame) -> DataFrame:
            """Hold on to an intermediate result of this batch that several of its steps read."""
            kept.append(persisted(df))
            return kept[-1]

        placed = keep(self._placed(new.drop(BUCKET), folders["heads"], touched))
        try:
            is_late = F.coalesce(F.col(FIRST) <= F.col(HEAD), F.lit(False))
            late = placed.where(is_late).select(*self._named(), FIRST, LAST)
            stretch = None
            of_late = late.agg(F.collect_set(bucket_of(self.keys, self.buckets))).first()[0]
            if of_late:
                own = {key: key for key in self.keys}
                near = limits_of(late, own, own)
                live = self._live(folders["versions"], of_late, late, [END_AT], near)
                stretch = keep(self._stretches(late, live))
            inside = self._events_in_order(new.drop(BUCKET), placed.where(~is_late), stretch is None)
            if stretch is not None:
                log = self.store.read("events", [*folders["events"], written["events"]], of_late)
                log = log.where(near & limits_of(stretch, {SEQ: LOW}, {SEQ: HIGH})).drop(STEP, BUCKET)
                inside = keep(inside.unionByName(self._within(log, stretch, F.col(SEQ), closed=True).drop(LOW)))
            delta = self._versions(inside, payload_of(new.drop(BUCKET), self.keys))
            if stretch is not None:
                replaced = self._within(live, stretch, F.col(START_AT), closed=False)
                gone = replaced.select(*self._named(), START_AT, F.lit(True).alias(GONE))
                delta = self._newest(delta.unionByName(gone, allowMissingColumns=True), [])
            delta = delta.withColumn(BUCKET, bucket_of(self.keys, self.buckets))
            written["versions"] = self.store.write(delta, "versions", batch_id, [*self.keys, START_AT])
            heads = self._new_heads(placed, self.store.read("versions", [written["versions"]]), stretch)
            written["heads"] = self.store.write(heads, "heads", batch_id, self.keys)
        finally:
            for df in kept:
                df.unpersist()
        return {part: [*folders[part], written[part]] for part in self.tables}

    def _merges(self) -> dict[str, tuple]:
        return {
            "events": (self._merge_events, [*self.keys, SEQ]),
            "versions": (self._merge_versions, [*self.keys, START_AT]),
            "heads": (self._merge_heads, self.keys),
        }

    def _named(self) -> list:
        return list(map(col, self.keys))

    def _placed(self, new: DataFrame, heads: Sequence[str], touched: Sequence[int]) -> DataFrame:
        """Per key of the batch: its first and last new sequence, and its head so far."""
        spans = new.groupBy(*self._named()).agg(F.min(SEQ).alias(FIRST), F.max(SEQ).alias(LAST))
        known = self.store.read("heads", heads, touched)
        payload = payload_of(new, self.keys)
        stored = [] if known is None else [c for c in payload if c in known.columns]
        blank = {c: F.lit(None).cast(new.schema[c].dataType) for c in payload if c not in stored}
        if known is None:
            nothing = F.when(F.lit(False), F.col(FIRST))
            return spans.withColumns({HEAD: nothing, START_AT: nothing, **blank})
        known = join_on(known, spans, self.keys, "left_semi").drop(BUCKET)
        known = self._merge_heads(known) if len(heads) > 1 else known.drop(STEP)
        placed = join_on(spans, known, self.keys, "left", [HEAD, START_AT, *stored])
        return placed.withColumns(blank) if blank else placed

    def _events_in_order(self, new: DataFrame, ordered: DataFrame, all_ordered: bool) -> DataFrame:
        """New events of keys without late ones. A key's open version stands for its history: as an event at
        its start with its latest values, it is all that the fold of later events can depend on."""
        if not all_ordered:
            new = join_on(new, ordered, self.keys, "left_semi")
        stand_in = ordered.where(F.col(START_AT).isNotNull()).select(
            *self._named(), F.col(START_AT).alias(SEQ), F.lit(False).alias(DEL), *map(col, payload_of(new, self.keys))
        )
        return new.unionByName(stand_in).withColumn(HIGH, F.when(F.lit(False), F.col(SEQ)))

    def _versions(self, inside: DataFrame, payload: Sequence[str]) -> DataFrame:
        """Versions of the stretches. `_high` rides along as a constant of the key: the version that starts
        there lies outside."""
        tracked = tracked_columns(payload, *self.tracking)
        versions = fold_versions(inside, self.keys, tracked, self.ignore_null_updates, self.hot_rows)
        inner = F.col(HIGH).isNull() | (F.col(START_AT) < F.col(HIGH))
        return versions.where(inner).drop(HIGH).withColumn(GONE, F.lit(False))

    def _new_heads(self, placed: DataFrame, delta: DataFrame, stretch: DataFrame | None) -> DataFrame:
        """Heads after the batch: the version the batch left open, or the old one where the batch changed
        only history before it."""
        values = [START_AT, *[c for c in placed.columns if c not in (*self.keys, FIRST, LAST, HEAD, START_AT)]]
        left_open = {c: f"_opened_{i}" for i, c in enumerate(values)}
        opened = delta.where(F.col(END_AT).isNull() & ~F.col(GONE)).withColumnsRenamed(left_open)
        joined = join_on(placed, opened, self.keys, "left", list(left_open.values()))
        kept = F.lit(False)
        if stretch is not None:
            joined = join_on(joined, stretch, self.keys, "left", [HIGH])
            kept = F.col(HIGH).isNotNull()
        chosen = [F.when(kept, col(c)).otherwise(F.col(left_open[c])).alias(c) for c in values]
        heads = joined.select(*self._named(), F.greatest(HEAD, LAST).alias(HEAD), *chosen)
        return heads.withColumn(BUCKET, bucket_of(self.keys, self.buckets))

    def _distinct_events(self, events: DataFrame, extra: Sequence[str] = ()) -> DataFrame:
        """Fewer rows, same fold: ties collapse to the one that counts, or only exact copies where ties
        are merged by column."""
        if self.ignore_null_updates:
            return events.distinct()
        return latest_by_key(events, [*self.keys, SEQ, *extra], [DEL, *payload_of(events, [*self.keys, *extra])])

    def _stretches(self, late: DataFrame, live: DataFrame) -> DataFrame:
        """Per key with late events, the part of its history (`_low` to `_high`) that its new events can change.

        From the last version that starts before the first of them - that start stays one - up to the end of
        the first version that starts after the last: the event there follows one that is not new. NULL
        means no limit, as for values carried forward by `ignore_null_updates`.
        """
        nothing = F.when(F.lit(False), F.col(FIRST))
        if self.ignore_null_updates:
            return late.select(*self._named(), nothing.alias(LOW), nothing.alias(HIGH))
        pairs = join_on(live, late, self.keys, "inner", [FIRST, LAST])
        start, later = F.col(START_AT), F.col(START_AT) > F.col(LAST)
        limits = pairs.groupBy(*self._named()).agg(
            F.max(F.when(start < F.col(FIRST), start)).alias(LOW),
            F.min(F.when(later, F.struct(START_AT, END_AT))).getField(END_AT).alias(HIGH),
        )
        return join_on(late.select(*self._named()), limits, self.keys, "left", [LOW, HIGH])

    def _within(self, rows: DataFrame, stretch: DataFrame, place, closed: bool) -> DataFrame:
        joined = join_on(rows, stretch, self.keys, "inner", [LOW, HIGH])
        below = (place <= F.col(HIGH)) if closed else (place < F.col(HIGH))
        return joined.where((F.col(LOW).isNull() | (place >= F.col(LOW))) & (F.col(HIGH).isNull() | below))

    def _newest(self, rows: DataFrame, rank: Sequence) -> DataFrame:
        """The row that counts for each (key, start): of the newest step, and a version before its removal."""
        rest = [c for c in rows.columns if c not in (*self.keys, START_AT)]
        ranked = F.struct(*[r.alias(f"_rank_{i}") for i, r in enumerate(rank)], (~F.col(GONE)).alias("_stays"), *map(col, rest))
        top = rows.groupBy(*map(col, self.keys), START_AT).agg(F.max(ranked).alias("_top"))
        return top.select(*map(col, self.keys), START_AT, *[F.col("_top").getField(c).alias(c) for c in rest])

    def _live(
        self,
        folders: Sequence[str],
        touched: Sequence[int] | None = None,
        only: DataFrame | None = None,
        columns: Sequence[str] | None = None,
        near: Column | None = None,
    ) -> DataFrame | None:
        """Versions that count; of some keys only (`near`: limits of those keys), and with some columns beside
        (keys, start), if so asked."""
        rows = self.store.read("versions", folders, touched)
        if rows is None:
            return None
        if near is not None:
            rows = rows.where(near)
        if only is not None:
            rows = join_on(rows, only, self.keys, "left_semi")
        if columns is not None:
            rows = rows.select(*self._named(), START_AT, *map(col, columns), GONE, STEP, BUCKET)
        rows = self._newest(rows.drop(BUCKET), [F.col(STEP)]) if len(folders) > 1 else rows.drop(BUCKET)
        return rows.where(~F.col(GONE)).drop(GONE, STEP)

    def _merge_events(self, rows: DataFrame) -> DataFrame:
        return self._distinct_events(rows.drop(STEP), [BUCKET])

    def _merge_versions(self, rows: DataFrame) -> DataFrame:
        newest = self._newest(rows.drop(BUCKET), [F.col(STEP)]).drop(STEP).where(~F.col(GONE))
        return newest.withColumn(BUCKET, bucket_of(self.keys, self.buckets))

    def _merge_heads(self, rows: DataFrame) -> DataFrame:
        by = [c for c in (*self.keys, BUCKET) if c in rows.columns]
        return latest_by_key(rows, by, [STEP]).drop(STEP)

    def current(self) -> DataFrame | None:
        """The open version of every key that has one; None before the first batch.

        Comes from the heads, one row per key and unmerged step; the history is neither read nor shuffled.
        """
        folders = self.store.folders()["heads"]
        heads = self.store.read("heads", folders)
        if heads is None:
            return None
        heads = self._merge_heads(heads) if len(folders) > 1 else heads.drop(STEP)
        payload = [c for c in heads.columns if c not in (*self.keys, HEAD, START_AT, BUCKET)]
        ended = F.lit(None).cast(heads.schema[START_AT].dataType).alias(END_AT)
        return heads.where(F.col(START_AT).isNotNull()).select(*self._named(), *map(col, payload), START_AT, ended)

    def read(self) -> DataFrame | None:
        """All versions; None before the first batch."""
        versions = self._live(self.store.folders()["versions"])
        if versions is None:
            return None
        dates = [START_AT, END_AT]
        return versions.select(*map(col, [c for c in versions.columns if c not in dates]), *dates)


class CurrentRows:
    """The type 1 form of a type 2 table: what its open versions hold, without their dates. Nothing is stored twice."""

    def __init__(self, history: Scd2Table):
        self.history = history

    def read(self) -> DataFrame | None:
        rows = self.history.current()
        return None if rows is None else rows.drop(START_AT, END_AT)


def run_changes(
    stream: DataFrame, tables: Sequence[_ChangeTable], checkpoint: str, rules: Rules | None = None, metrics: str | None = None
) -> None:
    """Feed what is new at the source to all the tables, one micro-batch at a time, and return when it is
    caught up. The batch is computed once and kept while the tables read it.

    Rows that fail one of `rules` are left out. With `metrics`, passed and failed rows of each rule are written to that
    folder by batch number, so a batch that is replayed counts once (see `operators.quality.stored_metrics`).
    """

    def apply(batch: DataFrame, batch_id: int) -> None:
        kept = batch.persist()
        try:
            if rules and metrics:
                expectation_metrics(kept, rules).write.mode("overwrite").parquet(f"{metrics}/batch={batch_id}")
            passed = expect_or_drop(kept, rules) if rules else kept
            for table in tables:
                table.apply(passed, batch_id)
        finally:
            kept.unpersist()

    query = stream.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint)
    query.trigger(availableNow=True).start().awaitTermination()
