"""Files and small tables in the folder that all executors share."""

from __future__ import annotations

import contextlib
import os
import uuid
from collections.abc import Iterator

import pyarrow.fs
from pyspark.sql import DataFrame, SparkSession

from tidemark.session import new_work_folder


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """Write the rows as parquet to a fresh folder that all executors share, and read them back.

    This cuts the lineage: what is lost with an executor is read again, never computed again.
    """
    spark = df.sparkSession
    folder = new_work_folder(spark, purpose)
    df.write.parquet(folder)
    return spark.read.schema(df.schema).parquet(folder)


def file_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh folder for files that tasks write by themselves, as a URI that pyarrow opens."""
    folder = new_work_folder(spark, purpose)
    return folder if "://" in folder or folder.startswith("file:") else f"file://{os.path.abspath(folder)}"


def _opened(uri: str) -> tuple[pyarrow.fs.FileSystem, str]:
    if uri.startswith("file:") and not uri.startswith("file://"):
        uri = "file://" + uri.removeprefix("file:")
    return pyarrow.fs.FileSystem.from_uri(uri)


@contextlib.contextmanager
def writing(uri: str) -> Iterator:
    """A binary output stream whose file appears under its name only when it is complete.

    A repeated or speculative attempt writes a file of its own and puts the same bytes in place.
    """
    fs, path = _opened(uri)
    fs.create_dir(os.path.dirname(path), recursive=True)
    attempt = f"{path}.{uuid.uuid4().hex}.tmp"
    with fs.open_output_stream(attempt, compression=None) as out:
        yield out
    fs.move(attempt, path)


@contextlib.contextmanager
def reading(uri: str) -> Iterator:
    """A sequential binary input stream."""
    fs, path = _opened(uri)
    with fs.open_input_stream(path, compression=None) as stream:
        yield stream


@contextlib.contextmanager
def random_reading(uri: str) -> Iterator:
    """A binary input file that can seek."""
    fs, path = _opened(uri)
    with fs.open_input_file(path) as stream:
        yield stream
