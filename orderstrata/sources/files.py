"""Small files and folders of any file system that Spark reaches, from the driver."""

from __future__ import annotations

from pyspark.sql import SparkSession


def _at(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def names_in(spark: SparkSession, folder: str) -> list[str]:
    """Names of what a folder holds, in order; none if there is no such folder."""
    system, where = _at(spark, folder)
    if not system.exists(where):
        return []
    return sorted(status.getPath().getName() for status in system.listStatus(where))


def read_small(spark: SparkSession, path: str) -> str:
    system, where = _at(spark, path)
    stream = system.open(where)
    try:
        return bytes(spark._jvm.org.apache.commons.io.IOUtils.toByteArray(stream)).decode()
    finally:
        stream.close()


def write_new(spark: SparkSession, path: str, text: str) -> None:
    """A file that must not be there yet; of several writers one succeeds."""
    system, where = _at(spark, path)
    stream = system.create(where, False)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    system, where = _at(spark, path)
    system.delete(where, True)
