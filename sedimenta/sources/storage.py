"""Small file-system helpers on the Hadoop API Spark itself uses."""

from __future__ import annotations

import re
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession

_UNITS = {"": 1, "b": 1, "k": 1 << 10, "m": 1 << 20, "g": 1 << 30, "t": 1 << 40}


def byte_count(text: str) -> int:
    """``10485760``, ``10MB``, ``10m``, ``-1`` as a number of bytes."""
    match = re.fullmatch(r"\s*(-?\d+)\s*([bkmgt]?)b?\s*", text.lower())
    if not match:
        raise ValueError(f"not a size: {text!r}")
    return int(match.group(1)) * _UNITS[match.group(2)]


def _resolve(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _resolve(spark, path)
    return fs.exists(jpath)


def child_names(spark: SparkSession, path: str) -> list[str]:
    """Names directly below ``path``; empty if it is not there."""
    fs, jpath = _resolve(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(status.getPath().getName() for status in fs.listStatus(jpath))


def read_text(spark: SparkSession, path: str) -> str:
    fs, jpath = _resolve(spark, path)
    stream = fs.open(jpath)
    try:
        data = spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)
    finally:
        stream.close()
    return bytes(data).decode("utf-8")


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """Make ``text`` appear at ``path`` in one step; fail if something is there.

    The rename refuses an existing target. That is one atomic step on HDFS; a local
    file system or an object store checks first, so there two writers may both pass.
    """
    fs, jpath = _resolve(spark, path)
    if fs.exists(jpath):
        raise FileExistsError(path)
    folder, _, name = path.rpartition("/")
    _, draft = _resolve(spark, f"{folder}/.{name}.{uuid.uuid4().hex}")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode("utf-8")))
    finally:
        stream.close()
    jvm = spark._jvm
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(
        fs.getUri(), spark._jsc.hadoopConfiguration()
    )
    options = spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 0)
    try:
        context.rename(draft, jpath, options)
    except Py4JJavaError as error:
        fs.delete(draft, False)
        if "FileAlreadyExists" in str(error.java_exception):
            raise FileExistsError(path) from error
        raise


def remove_tree(spark: SparkSession, path: str) -> None:
    fs, jpath = _resolve(spark, path)
    fs.delete(jpath, True)
