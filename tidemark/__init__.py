"""Layered tables from files and change feeds, as DataFrame and Structured Streaming operators."""

from tidemark.operators.latest import dedupe_by_key, latest_by_key
from tidemark.operators.pairing import change_feed, reconcile, reconcile_summary
from tidemark.operators.position import with_position, zip_rows
from tidemark.operators.protection import (
    Control,
    MaskedColumn,
    Policy,
    apply_column_masks,
    apply_policies,
    apply_row_filter,
    protection_audit,
    secured_view,
)
from tidemark.operators.quality import expect_or_drop, expectation_metrics, observe_expectations, rejected_rows
from tidemark.operators.scd import current_dimension, fold_scd1, fold_scd2
from tidemark.operators.snapshots import apply_snapshot_scd2, fold_snapshots_scd2, open_history

__all__ = [
    "Control",
    "MaskedColumn",
    "Policy",
    "apply_column_masks",
    "apply_policies",
    "apply_row_filter",
    "apply_snapshot_scd2",
    "change_feed",
    "current_dimension",
    "dedupe_by_key",
    "expect_or_drop",
    "expectation_metrics",
    "fold_scd1",
    "fold_scd2",
    "fold_snapshots_scd2",
    "latest_by_key",
    "observe_expectations",
    "open_history",
    "protection_audit",
    "reconcile",
    "reconcile_summary",
    "rejected_rows",
    "secured_view",
    "with_position",
    "zip_rows",
]
