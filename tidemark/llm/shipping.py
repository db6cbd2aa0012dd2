"""Make this package importable in the Python workers of any cluster."""

from __future__ import annotations

import os
import tempfile
import zipfile
from pathlib import Path

import tidemark
from pyspark.sql import SparkSession

_shipped: set[str] = set()
BATCH_LIMIT, BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch", "4m"


def bound_batches(spark: SparkSession) -> None:
    """Let rows go to Python workers in Arrow batches of about 4 MB; a limit that the session names already stays.

    By default a batch may be 64 MB, which a task holds several times over: twice on either side, and more as buffers double.
    """
    if spark.conf.get(BATCH_LIMIT, None) is None:
        spark.conf.set(BATCH_LIMIT, BATCH_BYTES)


def ship(spark: SparkSession) -> None:
    """Send the package's sources to the executors, once per application.

    Functions then travel by name, so workers keep the tables and caches of a module from task to task.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    _shipped.add(context.applicationId)
    root = Path(tidemark.__file__).parent
    handle, name = tempfile.mkstemp(prefix="tidemark-", suffix=".zip")
    os.close(handle)
    with zipfile.ZipFile(name, "w") as archive:
        for source in sorted(root.rglob("*.py")):
            archive.write(source, str(source.relative_to(root.parent)))
    context.addPyFile(name)
