"""The prefix tree of conversations: ROLLUP over turns as columns counts all prefixes together."""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from orderstrata.llm.common import stored

# Turns that stand side by side as columns of one row.
COLUMNS = 4
# Digests that stand for a turn's role and text, and for a node of the tree.
DIGEST_BYTES = 16
ROOT = bytes(DIGEST_BYTES)
# Ids that end at one node and lie in one such range (a power of two) are joined in one row.
ENDS_BITS = 9
WORD = r"[^\x20\x09-\x0D]+"

ENDS = "key binary, ends_sha256 string"


def turn_marks(turns: DataFrame) -> DataFrame:
    """Every turn with its place from 1, a digest of role and text, and its number of words.

    ``turns`` has ``conv_id``, ``turn``, ``role`` and ``text``. Turns go by number, none
    first; those of one number by role and then digest, so that rows that repeat one
    another are turns of their own. NULL role or text counts as empty; rows without a
    ``conv_id`` belong to no conversation and go. Other columns go.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    whole = F.concat(F.length(role).cast("string"), F.lit(":"), role, text)
    digest = F.substring(F.unhex(F.sha2(whole.cast("binary"), 256)), 1, DIGEST_BYTES)
    marks = turns.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").alias("turn"),
        role.alias("role"),
        digest.alias("mark"),
        F.regexp_count(text, F.lit(WORD)).cast("long").alias("words"),
    )
    order = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("turn"), "role", "mark")
    return marks.select("conv_id", F.row_number().over(order).alias("place"), "mark", "words")


# --- rows of some turns each ---------------------------------------------------------


def _block_fields(columns: int) -> list[str]:
    marks = [f"t{k}" for k in range(1, columns + 1)]
    words = [f"w{k}" for k in range(1, columns + 1)]
    return ["conv_id", "block", "prior", *marks, *words, "last"]


def _block_schema(columns: int) -> str:
    kinds = {"conv_id": "long", "block": "long", "prior": "binary", "last": "boolean"}
    default = {"t": "binary", "w": "long"}
    return ", ".join(f"{f} {kinds.get(f) or default[f[0]]}" for f in _block_fields(columns))


def _blocks(batches: Iterable[pa.RecordBatch], columns: int) -> Iterator[pa.RecordBatch]:
    """Rows in order of conversation and place, as rows of ``columns`` turns each.

    ``prior`` stands for all turns before: a digest of the block before and of its own
    prior. One block is held at a time, however long a conversation is.
    """
    kinds = {"t": pa.binary(), "w": pa.int64(), "conv_id": pa.int64(), "block": pa.int64(),
             "prior": pa.binary(), "last": pa.bool_()}
    names = _block_fields(columns)
    schema = pa.schema([(n, kinds.get(n) or kinds[n[0]]) for n in names])
    rows: list[tuple] = []
    conv, block, prior, held = None, 0, ROOT, []

    def row(last: bool) -> tuple:
        padded = [*held, *[(None, None)] * (columns - len(held))]
        return (conv, block, prior, *[m for m, _ in padded], *[w for _, w in padded], last)

    def batch() -> pa.RecordBatch:
        arrays = zip(*rows, strict=True) if rows else [()] * len(names)
        made = [pa.array(a, t) for a, t in zip(arrays, schema.types, strict=True)]
        rows.clear()
        return pa.RecordBatch.from_arrays(made, schema=schema)

    for given in batches:
        for conv_id, mark, words in zip(*(c.to_pylist() for c in given.columns), strict=True):
            if conv_id != conv:
                if conv is not None:
                    rows.append(row(last=True))
                conv, block, prior, held = conv_id, 0, ROOT, []
            if mark is None:
                continue
            if len(held) == columns:
                rows.append(row(last=False))
                prior = _digest(prior, *[m for m, _ in held])
                block, held = block + 1, []
            held.append((mark, words))
        if rows:
            yield batch()
    if conv is not None:
        rows.append(row(last=True))
    yield batch()


def _digest(*parts: bytes) -> bytes:
    return hashlib.sha256(b"".join(parts)).digest()[:DIGEST_BYTES]


def _key(depth: int) -> str:
    """SQL: the node of the first ``depth`` turns of a block; as :func:`_digest` makes it."""
    if depth == 0:
        return "prior"
    turns = ", ".join(f"coalesce(t{k}, X'')" for k in range(1, depth + 1))
    return f"substring(unhex(sha2(concat(prior, {turns}), 256)), 1, {DIGEST_BYTES})"


# --- all prefixes of a block together ----------------------------------------------------


def _rolled_up(
    spark: SparkSession, blocks: DataFrame, columns: int, totals: dict[str, str]
) -> DataFrame:
    """A row for each node with the ``totals`` over its members; ``d`` is its depth in the block.

    In ``totals`` ``#`` stands for that depth, as a part of a column's name: of the sums
    at all depths each node takes that of its own.
    """
    turns = ", ".join(f"t{k}" for k in range(1, columns + 1))

    def at_depth(name: str) -> str:
        if "#" not in totals[name]:
            return name
        cases = " ".join(f"WHEN {k} THEN {name}{k}" for k in range(columns + 1))
        return f"CASE d {cases} END AS {name}"

    sums = [
        f"{total.replace('#', str(k))} AS {name}{k if '#' in total else ''}"
        for name, total in totals.items()
        for k in (range(columns + 1) if "#" in total else (0,))
    ]
    own = " ".join(f"WHEN {k} THEN t{k} IS NOT NULL" for k in range(1, columns + 1))
    keys = " ".join(f"WHEN {k} THEN {_key(k)}" for k in range(columns + 1))
    parents = " ".join(f"WHEN {k} THEN {_key(k - 1)}" for k in range(1, columns + 1))
    # A block's depth 0 is the last node of the block before, but for the root. Where a
    # conversation has ended the column is NULL: no node.
    return spark.sql(
        f"""
        WITH rolled AS (
            SELECT block, prior, {turns}, {columns} - bit_count(grouping_id()) AS d,
                {", ".join(sums)}
            FROM {{blocks}}
            GROUP BY block, prior, ROLLUP ({turns})
        )
        SELECT CASE d {keys} END AS key, CASE d {parents} END AS parent,
            block, CAST(d AS INT) AS d, block * {columns} + d AS depth,
            {", ".join(at_depth(name) for name in totals)}
        FROM rolled
        WHERE CASE d WHEN 0 THEN block = 0 {own} END
        """,
        blocks=blocks,
    )


def _own_values(spark: SparkSession, blocks: DataFrame, columns: int) -> DataFrame:
    """Per block the values of nodes whose smallest member is the block's conversation.

    A node is counted once among the rows of its members in this way: in ``own``, ``leaf``
    and ``saved`` at its depth.
    """
    more = {f"m{k}": F.col(f"t{k + 1}").isNotNull() for k in range(columns)}
    more[f"m{columns}"] = ~F.col("last")
    nodes = _rolled_up(
        spark,
        blocks.withColumns(more).withColumn("w0", F.lit(0)),
        columns,
        {
            "conv_id": "min(conv_id)",
            "n_convs": "count(*)",
            "words": "max(w#)",
            "goes_on": "bool_or(m#)",
        },
    )
    values = {
        "own": F.lit(1),
        "leaf": F.when(F.col("goes_on"), 0).otherwise(1),
        "saved": (F.col("n_convs") - 1) * F.col("words"),
    }
    return nodes.groupBy("conv_id", "block").agg(
        *[
            F.sum(F.when(F.col("d") == k, value)).alias(f"{name}{k}")
            for name, value in values.items()
            for k in range(columns + 1)
        ]
    )


def _below(blocks: DataFrame, own: DataFrame, columns: int) -> DataFrame:
    """Per block and depth what its conversation counts for there and further down."""
    names = ("own", "leaf", "saved")
    met = blocks.join(own, ["conv_id", "block"], "left")
    filled = met.withColumns(
        {f"{n}{k}": F.coalesce(f"{n}{k}", F.lit(0)) for n in names for k in range(columns + 1)}
    )

    def total(name: str, first: int):
        return sum((F.col(f"{name}{k}") for k in range(first + 1, columns + 1)), F.col(f"{name}{first}"))

    up = Window.partitionBy("conv_id").orderBy(F.desc("block"))
    later = up.rowsBetween(Window.unboundedPreceding, -1)
    added = filled.withColumns(
        {f"later_{n}": F.coalesce(F.sum(total(n, 1)).over(later), F.lit(0)) for n in names[1:]}
    ).withColumn("next", F.coalesce(F.lag("own1").over(up), F.lit(0)))
    sums = [
        (total(n, k) + F.col(f"later_{n}")).alias(f"{n}{k}")
        for n in names[1:]
        for k in range(columns + 1)
    ]
    children = [F.col(f"own{k + 1}").alias(f"child{k}") for k in range(columns)]
    turns = [f"t{k}" for k in range(1, columns + 1)]
    return added.select(
        "conv_id", "block", "prior", *turns, *sums, *children, F.col("next").alias(f"child{columns}")
    )


# --- ends ------------------------------------------------------------------------------------


def _hash_runs(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One digest for each run of a key, over its texts with commas between them."""
    key, digest, rows = None, None, []
    for batch in batches:
        for at, ids in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            if at != key:
                if digest is not None:
                    rows.append((key, digest.hexdigest()))
                key, digest = at, hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(ids.as_py().encode())
        yield _ends_batch(rows)
        rows = []
    yield _ends_batch([(key, digest.hexdigest())] if digest is not None else [])


def _ends_batch(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [(), ()]
    arrays = [pa.array(columns[0], pa.binary()), pa.array(columns[1], pa.string())]
    return pa.RecordBatch.from_arrays(arrays, ["key", "ends_sha256"])


def _ends(blocks: DataFrame, columns: int) -> DataFrame:
    """For each node at which a conversation ends the digest of the ids of all that do.

    Ids are joined range by range first; a node's ranges, in order, are then read by one
    task, a row at a time.
    """
    key = F.expr(_key(columns))
    for k in range(columns, 0, -1):
        key = F.when(F.col(f"t{k}").isNull(), F.expr(_key(k - 1))).otherwise(key)
    ended = blocks.where("last").select(
        key.alias("key"), F.shiftright("conv_id", ENDS_BITS).alias("part"), "conv_id"
    )
    listed = F.sort_array(F.collect_list("conv_id")).cast("array<string>")
    parts = ended.groupBy("key", "part").agg(F.array_join(listed, ",").alias("ids"))
    ordered = parts.repartition("key").sortWithinPartitions("key", "part")
    return ordered.select("key", "ids").mapInArrow(_hash_runs, ENDS)


def prefix_tree(marks: DataFrame, columns: int = COLUMNS) -> DataFrame:
    """The tree of all prefixes of the conversations in ``marks`` (see :func:`turn_marks`).

    Each distinct sequence of the first d marks of a conversation is a node of depth d, the
    empty one the root; conversations that begin with it are its members. Rows per node:
    ``conv_id``, its smallest member; ``depth``; ``parent_conv_id``, its parent's smallest
    member, NULL at the root; ``n_convs``, its members; ``n_children``; ``n_leaves``, nodes
    without children at it and below; ``saved_tokens``, for it and all nodes below the sum of
    words in a node's last turn times the members but one; ``ends_sha256``, the SHA-256 of
    the ids of members that end there, as numbers in ascending order with commas between.

    Turns go side by side into rows of ``columns`` turns, each with a digest of all turns
    before, which stands for the node that the block before ends at. One ROLLUP over the
    turns of these rows gives all prefixes of all blocks: a number of jobs that does not
    grow with the length of conversations. Sums below a node come from a second ROLLUP: every
    node's value goes to the row of its smallest member, each row sums what lies further
    down its own conversation, and a node's total is the sum over its members' rows.

    Only digests, numbers and counts are shuffled, summed on the map side first, so a prefix
    that most conversations share is a row per task. A conversation's rows are put in order
    by one task, which holds one block of them. Nodes are told apart by 128 bits of SHA-256.

    A row with a NULL ``mark`` is no turn, but its conversation exists and ends at the root if
    it has no other. Equal conversations are members of the same nodes. Marks of one place
    and conversation are taken in order of marks. An empty table has no tree, hence no rows.
    """
    spark = marks.sparkSession
    rows = marks.where("conv_id IS NOT NULL").repartition("conv_id")
    rows = rows.sortWithinPartitions("conv_id", "place", "mark").select("conv_id", "mark", "words")
    schema = _block_schema(columns)
    blocks = stored(rows.mapInArrow(lambda it: _blocks(it, columns), schema), "blocks")
    below = _below(blocks, _own_values(spark, blocks, columns), columns)
    nodes = stored(
        _rolled_up(
            spark,
            below,
            columns,
            {
                "conv_id": "min(conv_id)",
                "n_convs": "count(*)",
                "n_children": "sum(child#)",
                "n_leaves": "sum(leaf#)",
                "saved_tokens": "sum(saved#)",
            },
        ),
        "nodes",
    )
    parents = nodes.select(F.col("key").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    met = nodes.join(parents, "parent", "left").join(_ends(blocks, columns), "key", "left")
    numbers = ("depth", "n_convs", "n_children", "n_leaves", "saved_tokens")
    longs = {n: F.col(n).cast("long").alias(n) for n in numbers}
    return met.select(
        "conv_id",
        longs["depth"],
        "parent_conv_id",
        *[longs[n] for n in numbers[1:]],
        F.coalesce("ends_sha256", F.sha2(F.lit(b""), 256)).alias("ends_sha256"),
    )
