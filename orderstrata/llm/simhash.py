"""Near duplicates by SimHash: fingerprints that share blocks of bits, then Hamming distance."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstrata.llm.common import stored
from orderstrata.llm.components import component_roots

BITS = 64
SHINGLES_AT_ONCE = 1 << 16
# Blocks beyond those that may differ: any pair within the distance agrees on this many.
AGREEING_BLOCKS = 3
# Fingerprints of one key that are compared pair by pair; more meet at midpoints instead.
COMPARED_AT_MOST = 64


def fingerprint(text: bytes, shingle: int = 3) -> bytes:
    """Eight bytes, highest bit first; all zero for a text without words."""
    words = text.lower().split()
    if not words:
        return bytes(8)
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    width = min(shingle, len(words))
    starts, ends = starts[: len(words) - width + 1], ends[width - 1 :]
    digest, ones = xxhash.xxh64_digest, np.zeros(BITS, np.int64)
    for at in range(0, len(starts), SHINGLES_AT_ONCE):
        cut = slice(at, at + SHINGLES_AT_ONCE)
        spans = zip(starts[cut].tolist(), ends[cut].tolist(), strict=True)
        raw = b"".join([digest(joined[a:b], 42) for a, b in spans])
        bits = np.unpackbits(np.frombuffer(raw, np.uint8).reshape(-1, 8), axis=1)
        ones += bits.sum(axis=0, dtype=np.uint32)
    return np.packbits(ones * 2 > len(starts)).tobytes()


def _fingerprints(
    batches: Iterable[pa.RecordBatch], shingle: int
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column(1).cast(pa.binary())
        raw = b"".join(fingerprint(t.as_py() or b"", shingle) for t in texts)
        prints = np.frombuffer(raw, ">u8").astype(np.uint64).view(np.int64)
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints)], ["doc_id", "print"])


def fingerprints(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", shingle: int = 3
) -> DataFrame:
    """``doc_id`` and its 64-bit ``print`` as a long, a row for each row of ``docs``.

    Lower-cases A-Z, takes words between blanks (space, 0x09-0x0D) and runs of
    ``shingle`` words, repeats included; a bit is set if it is in over half of the
    XXH64 values (seed 42). A shorter text is one shingle; NULL counts as empty, and
    a text without words has the print 0.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    return rows.mapInArrow(lambda it: _fingerprints(it, shingle), "doc_id long, print long")


def _block_masks(distance: int) -> list[int]:
    """Masks of every choice of agreeing blocks, as signed longs."""
    blocks = distance + AGREEING_BLOCKS
    edges = [BITS * k // blocks for k in range(blocks + 1)]
    parts = [((1 << b) - 1) ^ ((1 << a) - 1) for a, b in zip(edges, edges[1:], strict=False)]
    masks = [sum(chosen) for chosen in combinations(parts, AGREEING_BLOCKS)]
    return [m - (1 << BITS) if m >> (BITS - 1) else m for m in masks]


def _near_points(print_: Column, mask: int, radius: int) -> Column:
    """Values within ``radius`` bits of the print, differing outside of the mask only."""
    free = [1 << k for k in range(BITS) if not mask >> k & 1]
    flips = [sum(f) for n in range(radius + 1) for f in combinations(free, n)]
    signed = [f - (1 << BITS) if f >> (BITS - 1) else f for f in flips]
    return F.array(*[print_.bitwiseXOR(F.lit(f).cast("long")) for f in signed])


def links(classes: DataFrame, distance: int) -> DataFrame:
    """Pairs ``a < b`` of ids whose prints differ in at most ``distance`` bits.

    ``classes`` holds one row for each distinct ``print`` with an ``id``. The bits are
    cut into ``distance + 3`` blocks: two prints that are close agree on some three of
    them, so each choice of three is a key. Of a key with up to 64 prints the pairs are
    compared. The prints of a larger one go on to all points half the distance away:
    close prints have such a point in common, and at most a few prints share one, so
    work stays in proportion to the number of prints however many share a key. No pair
    is left out either way.
    """
    masks = _block_masks(distance)
    keys = F.array(
        *[
            F.struct(F.lit(n).alias("n"), F.col("print").bitwiseAND(F.lit(m)).alias("bits"))
            for n, m in enumerate(masks)
        ]
    )
    pieces = classes.select("id", "print", F.explode(keys).alias("key"))
    pieces = pieces.select("id", "print", "key.n", "key.bits")
    sizes = pieces.groupBy("n", "bits").agg(F.count("*").alias("members")).where("members > 1")
    radius = (distance + 1) // 2
    points = F.array(F.lit(0).cast("long"))
    for n, mask in enumerate(masks):
        crowded = (F.col("members") > COMPARED_AT_MOST) & (F.col("n") == n)
        points = F.when(crowded, _near_points(F.col("print"), mask, radius)).otherwise(points)
    met = pieces.join(sizes, ["n", "bits"]).withColumn("point", F.explode(points))
    groups = met.groupBy("n", "bits", "point").agg(
        F.collect_list(F.struct("id", "print")).alias("members")
    )

    def close(a: Column) -> Column:
        near = F.filter(
            "members",
            lambda b: (b["id"] > a["id"])
            & (F.bit_count(a["print"].bitwiseXOR(b["print"])) <= distance),
        )
        return F.transform(near, lambda b: F.struct(a["id"].alias("a"), b["id"].alias("b")))

    pairs = F.flatten(F.transform("members", close))
    found = groups.where(F.size("members") > 1).select(F.explode(pairs).alias("pair"))
    return found.select("pair.a", "pair.b").distinct()


def near_duplicates(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    shingle: int = 3,
    distance: int = 2,
) -> DataFrame:
    """``doc_id``, ``fingerprint`` (16 hex digits), ``component_id`` for each row of ``docs``.

    Documents whose fingerprints differ in at most ``distance`` bits are linked;
    ``component_id`` is the smallest id that can be reached over links. Equal
    fingerprints meet once, as one class, before any pair is looked for. A row without
    an id belongs to its component like any other, and links others, but lends it no id:
    a component without ids has the id NULL. Rows that repeat an id are each given a row. A long
    text is printed whole by one task. Other columns play no part. An empty table gives an empty one.
    """
    prints = stored(fingerprints(docs, id_column, text_column, shingle), "prints")
    # stored, so that the join below meets a print that very many rows share unsummed,
    # and the skew join can split it
    classes = stored(prints.groupBy("print").agg(F.min("doc_id").alias("id")), "classes")
    # prints are linked, not ids, as some have none
    roots = component_roots(links(classes.select(F.col("print").alias("id"), "print"), distance))
    reached = classes.join(roots, classes["print"] == roots["node"], "left").select(
        "print", "id", F.coalesce("root", "print").alias("root")
    )
    # stored, for the skew join to split a large component
    least = stored(reached.groupBy("root").agg(F.min("id").alias("component_id")), "components")
    rooted = reached.join(least, "root").select("print", "component_id")
    named = prints.join(rooted, "print", "left")
    text = F.lower(F.lpad(F.hex("print"), 16, "0"))
    return named.select("doc_id", text.alias("fingerprint"), "component_id")
