"""Paths in the file system that holds them."""

from __future__ import annotations

import re

from pyspark.sql import Column, SparkSession
from pyspark.sql import functions as F


def matching(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, sorted."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    return sorted(s.getPath().toString() for s in fs.globStatus(path) or [])


def any_match(spark: SparkSession, pattern: str) -> bool:
    """Whether a glob matches anything; the names stay where they are."""
    path = spark._jvm.org.apache.hadoop.fs.Path(pattern)
    found = path.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(path)
    return found is not None and len(found) > 0


def _at(spark: SparkSession, path: str):
    path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return path.getFileSystem(spark._jsc.hadoopConfiguration()), path


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """Put a short text into a file of its own, whole or not at all."""
    fs, target = _at(spark, path)
    _, part = _at(spark, f"{path}.part")
    out = fs.create(part, True)
    out.write(bytearray(text.encode()))
    out.close()
    fs.delete(target, False)
    fs.rename(part, target)


def read_text(spark: SparkSession, path: str) -> str:
    """A short text as it was put there."""
    fs, target = _at(spark, path)
    stream = fs.open(target)
    try:
        return bytes(stream.readAllBytes()).decode()
    finally:
        stream.close()


def folder_bytes(spark: SparkSession, path: str) -> int:
    """The bytes of all files in a folder."""
    fs, target = _at(spark, path)
    return fs.getContentSummary(target).getLength()


def removed(spark: SparkSession, path: str) -> None:
    """Remove a file, or a folder with all that is in it."""
    fs, target = _at(spark, path)
    fs.delete(target, True)


def escaped(name: str) -> str:
    """A file name as a glob that matches it alone."""
    return re.sub(r"([\\{}\[\]*?])", r"\\\1", name)


def plain_name(encoded: Column) -> Column:
    """File name as it is on disk, from the URI form of Spark's file metadata."""
    return F.url_decode(F.replace(encoded, F.lit("+"), F.lit("%2B")))
