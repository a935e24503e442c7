"""Folders of the file system that a path belongs to, through Hadoop's file API, so that any store Spark can write is served."""

from __future__ import annotations

from py4j.protocol import Py4JJavaError
from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    place = spark._jvm.org.apache.hadoop.fs.Path(path)
    return place.getFileSystem(spark._jsc.hadoopConfiguration()), place


def exists(spark: SparkSession, path: str) -> bool:
    fs, place = _at(spark, path)
    return fs.exists(place)


def remove(spark: SparkSession, path: str) -> bool:
    """Delete a file or a whole folder; False if there was none."""
    fs, place = _at(spark, path)
    return fs.delete(place, True)


def names(spark: SparkSession, path: str) -> list[str]:
    """Sorted names of what lies directly in a folder (empty if it is missing); marks and hidden files included."""
    fs, place = _at(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(place)) if fs.exists(place) else []


def modified(spark: SparkSession, path: str) -> float:
    """Time of the last change of a file or folder, in seconds since 1970."""
    fs, place = _at(spark, path)
    return fs.getFileStatus(place).getModificationTime() / 1000


def mark(spark: SparkSession, path: str) -> bool:
    """Create an empty file; False if it was there already. Stores that create atomically let one of two writers win."""
    fs, place = _at(spark, path)
    return fs.createNewFile(place)


def rename(spark: SparkSession, path: str, to: str) -> bool:
    """Move a folder; False if the target exists."""
    fs, place = _at(spark, path)
    target = spark._jvm.org.apache.hadoop.fs.Path(to)
    if fs.exists(target):
        return False
    fs.mkdirs(target.getParent())
    return fs.rename(place, target)


def write_text(spark: SparkSession, path: str, text: str) -> bool:
    """Create a small file; False if it is there already. Creating is one step of the store, so of two writers one wins."""
    fs, place = _at(spark, path)
    try:
        out = fs.create(place, False)
    except Py4JJavaError as e:
        if fs.exists(place):
            return False
        raise e
    out.write(bytearray(text.encode()))
    out.close()
    return True


def read_text(spark: SparkSession, path: str) -> str:
    """A small file's text; empty if the file is missing."""
    fs, place = _at(spark, path)
    if not fs.exists(place):
        return ""
    stream = fs.open(place)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()
