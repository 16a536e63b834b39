"""The few file-system questions Spark's readers and writers do not answer. Any Hadoop file system."""

from __future__ import annotations

import uuid
from typing import NamedTuple

from pyspark.sql import SparkSession


class Listed(NamedTuple):
    name: str
    modified: float  # seconds since 1970


def _located(spark: SparkSession, path: str):
    found = spark._jvm.org.apache.hadoop.fs.Path(path)
    return found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), found


def exists(spark: SparkSession, path: str) -> bool:
    system, found = _located(spark, path)
    return system.exists(found)


def remove(spark: SparkSession, path: str) -> None:
    """Delete a file or folder this library wrote; a missing one is fine."""
    system, found = _located(spark, path)
    system.delete(found, True)


def make_folder(spark: SparkSession, path: str) -> None:
    system, found = _located(spark, path)
    system.mkdirs(found)


def listed(spark: SparkSession, folder: str) -> list[Listed]:
    """What a folder holds, by name; a missing folder holds nothing."""
    system, found = _located(spark, folder)
    if not system.exists(found):
        return []
    inside = [Listed(s.getPath().getName(), s.getModificationTime() / 1000) for s in system.listStatus(found)]
    return sorted(inside)


def read_text(spark: SparkSession, path: str) -> str:
    """A small file."""
    system, found = _located(spark, path)
    stream = system.open(found)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file all at once: aside under a hidden name, then renamed. False if there is one of that
    name already; a writer that dies leaves at most a hidden file."""
    system, found = _located(spark, path)
    folder = found.getParent()
    aside = spark._jvm.org.apache.hadoop.fs.Path(folder, f"_{uuid.uuid4().hex}")
    system.mkdirs(folder)
    stream = system.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    # FileSystem.rename replaces a file of that name on some systems; FileContext.rename refuses.
    jvm, hadoop = spark._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    renames = getattr(jvm.org.apache.hadoop.fs, "Options$Rename")
    options = spark.sparkContext._gateway.new_array(renames, 1)
    options[0] = renames.NONE
    context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(system.makeQualified(folder).toUri(), hadoop)
    try:
        context.rename(system.makeQualified(aside), system.makeQualified(found), options)
    except Exception:
        system.delete(aside, False)
        if system.exists(found):
            return False
        raise
    return True
