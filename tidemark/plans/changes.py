"""Change feed of a retail application: JSON events -> checked events -> type 1 and type 2 tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tidemark.operators.quality import expect_or_drop
from tidemark.sources.schemas import RESCUED
from tidemark.sources.synthetic import EVENT_TIME_FORMAT

# Operation codes and row rules of the feed.
OPERATIONS = ("APPEND", "DELETE", "UPDATE")
FEED_RULES = {
    "valid_id": "id IS NOT NULL",
    "valid_operation": "operation IN ('APPEND', 'DELETE', 'UPDATE')",
}
RESCUE_RULE = {"valid_json_schema": f"{RESCUED} IS NULL"}
SEQUENCE_RULE = {"valid_sequence": "operation_date IS NOT NULL"}
IS_DELETE = "operation = 'DELETE'"
DROPPED_COLUMNS = ("operation", "operation_date", RESCUED)


def event_time(name: str = "operation_date") -> Column:
    """The feed writes event times as text that does not sort by time; parse it before sequencing."""
    return F.try_to_timestamp(F.col(name), F.lit(EVENT_TIME_FORMAT))


def clean_changes(raw: DataFrame, rescued: bool = True) -> DataFrame:
    """Events with an id, a known operation and, where records can be rescued, nothing rescued."""
    return expect_or_drop(raw, {**FEED_RULES, **(RESCUE_RULE if rescued else {})})
