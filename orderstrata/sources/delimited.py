"""Delimited text files."""

from __future__ import annotations

from collections import defaultdict
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

def data_files(spark: SparkSession, path: str) -> dict[str, int]:
    """Files at a path, in a folder or by a pattern, with their bytes; hidden ones left out."""
    jvm, conf = spark._jvm, spark._jsc.hadoopConfiguration()
    pattern = jvm.org.apache.hadoop.fs.Path(path)
    system = pattern.getFileSystem(conf)
    found: dict[str, int] = {}
    for match in system.globStatus(pattern) or []:
        listed = system.listStatus(match.getPath()) if match.isDirectory() else [match]
        for status in listed:
            name = status.getPath().getName()
            if not status.isDirectory() and not name.startswith(("_", ".")):
                found[status.getPath().toString()] = status.getLen()
    return found


def header_lines(spark: SparkSession, files: list[str]) -> dict[str, str]:
    """The header of each file, found by tasks; files without a line are left out.

    The first line that holds something in a file's first block; the driver opens no file.
    What comes to the driver is a line for each file, whose names it holds anyway.
    """
    lines = spark.read.text(files).select("_metadata.file_path", "_metadata.file_block_start", "value")
    filled = lines.where("file_block_start = 0 AND trim(BOTH FROM value) <> ''")
    # all lines of a first block are in one partition, in their order
    first = filled.groupBy("file_path").agg(F.first("value").alias("line"))
    return {_plain(row.file_path): row.line.removeprefix("\ufeff") for row in first.collect()}


def _plain(uri: str) -> str:
    """A file's name as the file system lists it."""
    name = unquote(uri)
    return name.replace("file:///", "file:/", 1) if name.startswith("file:///") else name


def read_alike(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder whose files have the same header row; every column is text.

    No file is looked at beforehand but one. Tasks hold each file's header against its, and one
    that differs fails the job (see :func:`tells_of_headers`).
    """
    return spark.read.csv(path, header=True, enforceSchema=False)


def tells_of_headers(error: Exception) -> bool:
    """Whether a job failed on files with differing headers."""
    return "CSV header does not conform to the schema" in str(error) or (
        "Number of column in CSV header is not equal to number of fields in the schema"
        in str(error)
    )


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """A CSV file or folder with a header row in each file; every column is text.

    Columns go by name: files of a folder may list them in different orders. One that
    lacks a column or has one more than the others is an error that names the file. Headers
    of several files are read first, by tasks, which takes one scan of the lines; files with the
    same header are one scan then, and Spark holds every file against it once more while
    reading. Empty files are left out.
    """
    files = [file for file, size in sorted(data_files(spark, path).items()) if size]
    by_header: dict[str, list[str]] = defaultdict(list)
    if len(files) > 1:
        for file, header in sorted(header_lines(spark, files).items()):
            by_header[header].append(file)
    if len(by_header) < 2:
        return read_alike(spark, path)
    scans = [
        (alike[0], spark.read.csv(alike, header=True, enforceSchema=False))
        for alike in by_header.values()
    ]
    names = {name.lower() for name in scans[0][1].columns}
    for file, scan in scans[1:]:
        differing = names ^ {name.lower() for name in scan.columns}
        if differing:
            told = ", ".join(sorted(differing))
            raise ValueError(f"{file} and {scans[0][0]} differ in the columns {told}")
    return reduce(DataFrame.unionByName, [scan for _, scan in scans])
