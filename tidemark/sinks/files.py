"""Folder operations on whatever file system a path names."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession


def _resolve(spark: SparkSession, path: str):
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = _resolve(spark, path)
    return fs.exists(p)


def size_of(spark: SparkSession, path: str) -> int:
    """Bytes of a file or of all files in a folder."""
    fs, p = _resolve(spark, path)
    return fs.getContentSummary(p).getLength()


def delete(spark: SparkSession, path: str) -> None:
    fs, p = _resolve(spark, path)
    fs.delete(p, True)


def rename(spark: SparkSession, path: str, to: str) -> None:
    fs, p = _resolve(spark, path)
    if not fs.rename(p, spark._jvm.org.apache.hadoop.fs.Path(to)):
        raise OSError(f"cannot rename {path} to {to}")


def subfolders(spark: SparkSession, path: str) -> list[str]:
    """Names of the direct subfolders, sorted."""
    fs, p = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p) if s.isDirectory())


def names(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies directly in a folder, sorted; none if there is no such folder."""
    fs, p = _resolve(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(p)) if fs.exists(p) else []


def publish_text(spark: SparkSession, path: str, text: str) -> None:
    """A small file that is either there as a whole or not at all; one that is there already is not replaced."""
    fs, p = _resolve(spark, path)
    if fs.exists(p):
        raise FileExistsError(path)
    part = f"{path}.part-{uuid.uuid4().hex}"
    out = fs.create(_resolve(spark, part)[1], False)
    out.write(bytearray(text.encode()))
    out.close()
    rename(spark, part, path)


def read_text(spark: SparkSession, path: str) -> str:
    fs, p = _resolve(spark, path)
    stream = fs.open(p)
    try:
        return bytes(spark._jvm.org.apache.hadoop.io.IOUtils.readFullyToByteArray(stream)).decode()
    finally:
        stream.close()
