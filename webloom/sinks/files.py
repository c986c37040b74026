"""Small files and folders on whatever file system a path names, through Hadoop (classic sessions)."""

from __future__ import annotations

import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark._jsc.hadoopConfiguration())


def write_once(spark: SparkSession, path: str, text: str) -> bool:
    """Create the file as a whole by one rename; False, and nothing changed, if it exists."""
    target, fs = _at(spark, path)
    temporary, _ = _at(spark, f"{target.getParent()}/.{uuid.uuid4().hex}")
    out = fs.create(temporary, False)
    try:
        out.write(bytearray(text.encode()))
    finally:
        out.close()
    jvm, gateway = spark._jvm, spark.sparkContext._gateway
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(fs.getUri(), spark._jsc.hadoopConfiguration())
    no_options = gateway.new_array(getattr(jvm.org.apache.hadoop.fs, "Options$Rename"), 0)
    try:
        context.rename(fs.makeQualified(temporary), fs.makeQualified(target), no_options)
    except Py4JJavaError as failed:
        fs.delete(temporary, False)
        if "FileAlreadyExists" in failed.java_exception.getClass().getName():
            return False
        raise
    return True


def read_text(spark: SparkSession, path: str) -> str:
    target, fs = _at(spark, path)
    stream = fs.open(target)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def names(spark: SparkSession, folder: str) -> list[str]:
    """Names in a folder, sorted; none if there is no such folder."""
    target, fs = _at(spark, folder)
    return sorted(s.getPath().getName() for s in fs.listStatus(target)) if fs.exists(target) else []


def matching(spark: SparkSession, pattern: str) -> list[tuple[str, float]]:
    """Path and age in seconds of everything that matches a pattern."""
    target, fs = _at(spark, pattern)
    now = spark._jvm.java.lang.System.currentTimeMillis()
    return [(s.getPath().toString(), (now - s.getModificationTime()) / 1000) for s in fs.globStatus(target) or []]


def delete(spark: SparkSession, path: str) -> None:
    target, fs = _at(spark, path)
    fs.delete(target, True)
