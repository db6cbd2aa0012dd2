"""A stored type 2 history that takes one full snapshot per step."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from tidemark.operators.common import END_AT
from tidemark.operators.snapshots import apply_snapshot_scd2, open_history
from tidemark.sinks.batch_folders import BUCKET, STEP, BatchFolders

CLOSED, OPEN = 0, 1


class SnapshotTable:
    """Each step writes the versions that are open after it and those it closed. Only the last step's open
    versions are read to apply the next snapshot; closed versions are never read or written again."""

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        keys: Sequence[str],
        track_history: Sequence[str] | None = None,
        track_history_except: Sequence[str] | None = None,
    ):
        self.keys, self.tracking = list(keys), (track_history, track_history_except)
        self.store = BatchFolders(spark, root, ("history",))

    def apply(self, snapshot: DataFrame, version: Column, step: int) -> None:
        """Apply a snapshot with one row per key, as number `step`; a step that was published is skipped."""
        if step <= self.store.last_step():
            return
        folders = self.store.folders()["history"]
        if folders:
            rows = apply_snapshot_scd2(self._part(folders[-1:], OPEN), snapshot, version, self.keys, *self.tracking)
        else:
            rows = open_history(snapshot, version)
        placed = rows.withColumn(BUCKET, F.when(F.col(END_AT).isNull(), OPEN).otherwise(CLOSED))
        self.store.publish(step, {"history": [*folders, self.store.write(placed, "history", step, self.keys)]})

    def _part(self, folders: Sequence[str], which: int) -> DataFrame:
        return self.store.read("history", folders, [which]).drop(BUCKET, STEP)

    def read(self) -> DataFrame | None:
        """All versions; None before the first snapshot."""
        folders = self.store.folders()["history"]
        if not folders:
            return None
        return self._part(folders, CLOSED).unionByName(self._part(folders[-1:], OPEN))
