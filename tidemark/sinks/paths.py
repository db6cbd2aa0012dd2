"""File-system helpers on the driver, through Hadoop so that they work on any store Spark can write."""

from __future__ import annotations

import time
import uuid
from collections.abc import Collection

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    hadoop_path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def child_folders(spark: SparkSession, path: str) -> list[str]:
    """Names of the folders directly under `path`."""
    hadoop_path, fs = _at(spark, path)
    if not fs.exists(hadoop_path):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isDirectory()]
    return sorted(name for name in found if not name.startswith(("_temporary", ".")))


def child_files(spark: SparkSession, path: str) -> list[str]:
    hadoop_path, fs = _at(spark, path)
    if not fs.exists(hadoop_path):
        return []
    found = [s.getPath().getName() for s in fs.listStatus(hadoop_path) if s.isFile()]
    return sorted(name for name in found if not name.startswith("_"))


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file unless it is there already; False if it was.

    The text is written aside and renamed without overwriting, so readers never see part of it and of two
    writers one is told that it lost, as far as the store's rename allows.
    """
    hadoop_path, fs = _at(spark, path)
    if fs.exists(hadoop_path):
        return False
    jvm = spark.sparkContext._jvm
    aside = jvm.org.apache.hadoop.fs.Path(hadoop_path.getParent(), f"_{uuid.uuid4().hex}.tmp")
    out = fs.create(aside, False)
    out.write(bytearray(text.encode()))
    out.close()
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark.sparkContext._jsc.hadoopConfiguration())
    try:
        context.rename(fs.makeQualified(aside), fs.makeQualified(hadoop_path), options)
    except Py4JJavaError as error:
        fs.delete(aside, False)
        if "FileAlreadyExists" in str(error.java_exception):
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    hadoop_path, fs = _at(spark, path)
    stream = fs.open(hadoop_path)
    try:
        return spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _at(spark, path)
    return fs.exists(hadoop_path)


def first_line(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str | None:
    """The first line of a text file, decompressed by its name's ending; None if the file is empty."""
    hadoop_path, fs = _at(spark, path)
    jvm = spark.sparkContext._jvm
    codec = jvm.org.apache.hadoop.io.compress.CompressionCodecFactory(spark.sparkContext._jsc.hadoopConfiguration()).getCodec(hadoop_path)
    stream = fs.open(hadoop_path)
    try:
        plain = codec.createInputStream(stream) if codec else stream
        return jvm.java.io.BufferedReader(jvm.java.io.InputStreamReader(plain, encoding)).readLine()
    finally:
        stream.close()


def replace_file(spark: SparkSession, source: str, target: str) -> None:
    """Put `source` in the place of `target`, which may be there."""
    from_path, fs = _at(spark, source)
    to_path, _ = _at(spark, target)
    fs.delete(to_path, False)
    if not fs.rename(from_path, to_path):
        raise OSError(f"{source} could not be renamed to {target}")


def delete_file(spark: SparkSession, path: str) -> None:
    hadoop_path, fs = _at(spark, path)
    fs.delete(hadoop_path, False)


def remove_old_folders(spark: SparkSession, path: str, keep: Collection[str], older_than: float) -> list[str]:
    """Delete the folders directly under `path` that are not in `keep` and whose newest file is over `older_than` seconds
    old; returns their names. Folders without a file stay, as nothing tells their age on every store."""
    removed = []
    for name in child_folders(spark, path):
        if name in keep:
            continue
        hadoop_path, fs = _at(spark, f"{path}/{name}")
        files, newest = fs.listFiles(hadoop_path, True), None
        while files.hasNext():
            newest = max(newest or 0, files.next().getModificationTime())
        if newest is not None and newest < (time.time() - older_than) * 1000:
            fs.delete(hadoop_path, True)
            removed.append(name)
    return removed
