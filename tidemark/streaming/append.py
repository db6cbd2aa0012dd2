"""Append-only streaming tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql.streaming import StreamingQuery


def append_stream(stream: DataFrame, path: str, checkpoint: str, name: str | None = None) -> StreamingQuery:
    """Start writing what is new at the source to a parquet folder, and stop when it is caught up.

    Exactly once per source row: the folder's own log lists the files of each completed micro-batch.
    That log is kept by batch number, so a folder takes one stream with one checkpoint. Restart it with
    a wider schema to take in new columns.
    """
    writer = stream.writeStream.format("parquet").outputMode("append").option("path", path)
    if name:
        writer = writer.queryName(name)
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def run_append(stream: DataFrame, path: str, checkpoint: str) -> None:
    """`append_stream`, waiting for it; raises if the stream failed."""
    append_stream(stream, path, checkpoint).awaitTermination()
