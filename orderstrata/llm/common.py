"""What the operators of this package share: intermediate tables and packed arrays."""

from __future__ import annotations

import struct
import uuid
from collections import defaultdict
from collections.abc import Iterable

import numpy as np
import zstandard
from pyspark.sql import DataFrame, SparkSession

from orderstrata.session import shared_folder
from orderstrata.sources.files import delete


_made: dict[str, list[str]] = defaultdict(list)


def new_folder(spark: SparkSession, name: str) -> str:
    """A path nothing is at yet, in the folder that driver and executors share."""
    path = f"{shared_folder(spark)}/llm-{name}-{uuid.uuid4().hex}"
    _made[spark.sparkContext.applicationId].append(path)
    return path


def drop_intermediates(spark: SparkSession) -> int:
    """Deletes what the operators of this application left in the shared folder; the number.

    Only when no frame that they returned is needed any more: results are lazy and read these
    tables. Archives and stages that went to a path of :func:`new_folder` go as well.
    """
    paths = _made.pop(spark.sparkContext.applicationId, [])
    for path in paths:
        delete(spark, path)
    return len(paths)


def stored(df: DataFrame, name: str) -> DataFrame:
    """``df``, written to the shared folder and read back: later steps start from files."""
    path = new_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def unused_name(df: DataFrame, name: str) -> str:
    """``name``, with underscores before it until ``df`` has no such column in any case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name = f"_{name}"
    return name


def pack(arrays: Iterable[np.ndarray]) -> bytes:
    """Flat arrays as one compressed string; bytes of equal rank lie together."""
    head, body = [], []
    for array in arrays:
        array = np.ascontiguousarray(array)
        kind = array.dtype.str.encode()
        head.append(struct.pack("<B", len(kind)) + kind + struct.pack("<q", array.size))
        planes = array.view(np.uint8).reshape(-1, array.dtype.itemsize)
        body.append(planes.T.tobytes())
    raw = struct.pack("<B", len(head)) + b"".join(head) + b"".join(body)
    return zstandard.ZstdCompressor(level=1).compress(raw)


def unpack(packed: bytes) -> list[np.ndarray]:
    raw = zstandard.ZstdDecompressor().decompress(packed)
    at, kinds = 1, []
    for _ in range(raw[0]):
        width = raw[at]
        kind = np.dtype(raw[at + 1 : at + 1 + width].decode())
        (size,) = struct.unpack_from("<q", raw, at + 1 + width)
        kinds.append((kind, size))
        at += 9 + width
    arrays = []
    for kind, size in kinds:
        planes = np.frombuffer(raw, np.uint8, size * kind.itemsize, at)
        rows = np.ascontiguousarray(planes.reshape(kind.itemsize, size).T)
        arrays.append(rows.view(kind).reshape(-1))
        at += size * kind.itemsize
    return arrays


def plainly_named(df: DataFrame) -> DataFrame:
    """The same columns under the names c0, c1, ...: any name can be there twice or hold dots."""
    return df.toDF(*[f"c{k}" for k in range(len(df.columns))])
