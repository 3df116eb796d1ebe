"""Whole rows in batches of about a megabyte of text, stored so that texts are moved once."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame

from orderstrata.llm.common import new_folder

# Bytes of text in a batch; a longer text is a batch of its own.
BATCH_BYTES = 1 << 20
BATCH = "batch_id long, n_bytes long, rows binary"


def _ipc(batch: pa.RecordBatch) -> bytes:
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    return sink.getvalue().to_pybytes()


def batch_rows(raw: bytes) -> pa.RecordBatch:
    """The rows of a stored batch."""
    return next(iter(pa.ipc.open_stream(raw)))


def _batched(
    batches: Iterable[pa.RecordBatch], text: int, most_bytes: int
) -> Iterator[pa.RecordBatch]:
    number = TaskContext.get().partitionId() << 32
    for batch in batches:
        lengths = pc.binary_length(batch.column(text).cast(pa.binary()))
        ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False))
        at = 0
        while at < batch.num_rows:
            before = int(ends[at - 1]) if at else 0
            to = max(at + 1, int(np.searchsorted(ends, before + most_bytes, side="right")))
            cut = batch.slice(at, to - at)
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([number], pa.int64()),
                    pa.array([int(ends[to - 1]) - before], pa.int64()),
                    pa.array([_ipc(cut)], pa.binary()),
                ],
                ["batch_id", "n_bytes", "rows"],
            )
            number, at = number + 1, to


def store_batches(docs: DataFrame, text: int, most_bytes: int = BATCH_BYTES) -> DataFrame:
    """Batches in files by batch, so that joining by batch leaves the text where it is.

    ``text`` is the number of the column whose bytes are counted. The table's name is put
    into the session's catalog, which must take a table, and dropped again; the files, in
    the shared folder, stay.
    """
    spark = docs.sparkSession
    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    batches = docs.mapInArrow(lambda it: _batched(it, text, most_bytes), BATCH)
    path = new_folder(spark, "batches")
    name = f"batches_{path.rsplit('-', 1)[-1]}"
    writer = batches.repartition(tasks, "batch_id").write.option("compression", "none")
    writer.option("path", path).bucketBy(tasks, "batch_id").saveAsTable(name)
    table = spark.read.table(name)
    spark.sql(f"DROP TABLE {name}")  # the name only: the files are outside the warehouse
    return table
