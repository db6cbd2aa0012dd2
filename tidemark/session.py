"""Session helpers: the settings the library expects and the shared work folder."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import SparkSession

SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
}


def build_session(app: str = "tidemark", master: str | None = None, **settings: str) -> SparkSession:
    """Create (or reuse) a session with the library's defaults; `settings` use `__` for dots."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    given = {name.replace("__", "."): value for name, value in settings.items()}
    for name, value in {**SETTINGS, **given}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def shared_folder(spark: SparkSession) -> str:
    """The folder every executor can reach, as the cluster names it in `spark.checkpoint.dir`.

    Only a local session that names none (as in tests) gets a temporary folder.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="tidemark-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def ensure_checkpoint_dir(spark: SparkSession) -> None:
    """Make `DataFrame.checkpoint()` usable, leaving a folder that is already set alone."""
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_folder(spark))


def new_work_folder(spark: SparkSession, purpose: str) -> str:
    """A fresh path under the shared folder; nothing is created yet."""
    return os.path.join(shared_folder(spark), f"{purpose}-{uuid.uuid4().hex}")
