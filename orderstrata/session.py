"""Session settings, and the folder that jobs share."""

from __future__ import annotations

import atexit
import shutil
import tempfile
from math import ceil

from pyspark.sql import SparkSession

# Bytes a task should get from a scan or a shuffle, while that makes few enough tasks.
PARTITION_BYTES = 128 * 1024 * 1024
# The driver holds a size for each pair of map and reduce tasks, if only a bit;
# with more tasks than this on both sides that alone fills its memory.
MOST_PARTITIONS = 100_000


def partition_bytes(largest_bytes: int) -> int:
    """Bytes per task: the usual size, or more once tasks would be too many."""
    return max(PARTITION_BYTES, ceil(largest_bytes / MOST_PARTITIONS))


def size_settings(largest_bytes: int) -> dict[str, str]:
    """How scans and shuffles are cut for a largest table of so many bytes."""
    size = partition_bytes(largest_bytes)
    return {
        "spark.sql.shuffle.partitions": str(max(200, ceil(largest_bytes / size))),
        "spark.sql.files.maxPartitionBytes": str(size),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(size),
    }


def size_for(spark: SparkSession, largest_bytes: int) -> None:
    """Sets a session that is there already to a largest table of so many bytes."""
    for name, value in size_settings(largest_bytes).items():
        spark.conf.set(name, value)


def build_session(
    app_name: str = "orderstrata", largest_bytes: int | None = None
) -> SparkSession:
    """A session with the settings the operators count on; the master comes from outside.

    ``largest_bytes`` is the size of the largest table, as a rule the order
    details; scans and shuffles are cut into parts accordingly. Where it is only known
    later, :func:`size_for` does the same.
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.sql.ansi.enabled", "true")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
    )
    if largest_bytes is not None:
        builder = builder.config(map=size_settings(largest_bytes))
    return builder.getOrCreate()


_own_folders: dict[str, str] = {}


def shared_folder(spark: SparkSession) -> str:
    """The folder that every executor reaches: ``spark.checkpoint.dir``.

    Where it is unset, a local session gets one temporary folder, removed when the
    process ends; on a cluster that is an error, as executors don't see one another's
    disks.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    application = spark.sparkContext.applicationId
    if application not in _own_folders:
        _own_folders[application] = tempfile.mkdtemp(prefix="orderstrata-")
        atexit.register(shutil.rmtree, _own_folders[application], ignore_errors=True)
    return _own_folders[application]
