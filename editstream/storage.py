"""Small file-system calls on whatever store a path names (Hadoop's API)."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at, at.getFileSystem(spark._jsc.hadoopConfiguration())


def exists(spark: SparkSession, path: str) -> bool:
    at, fs = _at(spark, path)
    return fs.exists(at)


def names(spark: SparkSession, path: str) -> list[str]:
    """Names in a folder; none if it is not there."""
    at, fs = _at(spark, path)
    return [s.getPath().getName() for s in fs.listStatus(at)] if fs.exists(at) else []


def delete(spark: SparkSession, path: str) -> None:
    at, fs = _at(spark, path)
    fs.delete(at, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    at, fs = _at(spark, path)
    target, _ = _at(spark, to)
    fs.mkdirs(target.getParent())
    if not fs.rename(at, target):
        raise OSError(f"cannot move {path} to {to}")


def set_modified(spark: SparkSession, path: str, millis: int) -> None:
    at, fs = _at(spark, path)
    fs.setTimes(at, millis, -1)


def stamp(spark: SparkSession, path: str) -> tuple:
    """Name, bytes and time of each file of a table: differs once the table changes."""
    at, fs = _at(spark, path)
    listed = fs.listStatus(at)
    return tuple(sorted((s.getPath().getName(), s.getLen(), s.getModificationTime()) for s in listed))


def size(spark: SparkSession, path: str) -> int:
    """Bytes of all files below a folder."""
    at, fs = _at(spark, path)
    return fs.getContentSummary(at).getLength()


def read_text(spark: SparkSession, path: str) -> str:
    at, fs = _at(spark, path)
    stream = fs.open(at)
    try:
        return spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    finally:
        stream.close()


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Writes a file in full and gives it its name; False if the name is taken."""
    at, fs = _at(spark, path)
    draft, _ = _at(spark, f"{path}.{uuid.uuid4().hex}.draft")
    stream = fs.create(draft, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    # A rename onto a file fails on shared stores; a local one replaces it, hence the look.
    if not fs.exists(at) and fs.rename(draft, at):
        return True
    fs.delete(draft, False)
    return False


def files(spark: SparkSession, path: str) -> list[str]:
    """Paths of the files of a folder (not of its folders)."""
    at, fs = _at(spark, path)
    return [s.getPath().toString() for s in fs.listStatus(at) if s.isFile()]
