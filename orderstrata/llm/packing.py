"""Packing tokenised documents into sequences of equal length and balanced cost."""

from __future__ import annotations

import base64
import heapq
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

# Documents are packed together until they hold this many tokens: the memory of a task.
GROUP_TOKENS = 1 << 21
# Longer texts go to the second tokenizer, which takes any length; the first one fails on a
# run of a million blanks.
LONGEST_TEXT = 1 << 19
SPECIAL = "<|endoftext|>"

PIECES = (
    "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, "
    "sequence_id long, offset long, ids binary"
)


@dataclass(frozen=True)
class Cost:
    """Estimated cost of a piece: ``linear * n + quadratic * n * n`` for ``n`` tokens."""

    linear: float = 1.0
    quadratic: float = 1 / 2048

    def of(self, tokens: int) -> float:
        return tokens * (self.linear + self.quadratic * tokens)


class Ids:
    """Token ids of a text by a byte-level vocabulary, the end id after them.

    The vocabulary's rank file gives the ids; ``tokenizer`` is the same vocabulary for
    the ``tokenizers`` library and gives them for very long texts.
    """

    def __init__(self, ranks: str, tokenizer: str, special_id: int, end_id: int):
        with open(ranks, "rb") as lines:
            pairs = [line.split() for line in lines]
        self._encoding = tiktoken.Encoding(
            "ranks",
            pat_str=public_tokenizers.PATTERN,
            mergeable_ranks={base64.b64decode(token): int(rank) for token, rank in pairs},
            special_tokens={SPECIAL: special_id},
        )
        self._whole = Tokenizer.from_file(tokenizer)
        self._end = end_id

    def _of(self, text: str) -> list[int]:
        if len(text) > LONGEST_TEXT:
            return self._whole.encode(text, add_special_tokens=False).ids
        if SPECIAL in text:
            return self._encoding.encode(text, allowed_special="all")
        return self._encoding.encode_ordinary(text)

    def of(self, text: str) -> np.ndarray:
        return np.array([*self._of(text), self._end], "<u4")


def _capacities(tokens: int, length: int) -> list[int]:
    """Full sequences and, for what is over, powers of two: no place is left empty."""
    rest = tokens % length
    powers = [1 << k for k in range(rest.bit_length() - 1, -1, -1) if rest >> k & 1]
    return [length] * (tokens // length) + powers


def assign(
    lengths: list[int], length: int, cost: Cost
) -> list[tuple[int, int, int, int, int]]:
    """Pieces as (document, start, tokens, sequence, offset).

    Documents, the costliest first, go to the sequence that costs least so far and has
    places left; what it can't hold goes to the next such sequence.
    """
    capacities = _capacities(sum(lengths), length)
    used = [0] * len(capacities)
    waiting = [(0.0, k) for k in range(len(capacities))]
    pieces = []
    for document in sorted(range(len(lengths)), key=lambda d: (-lengths[d], d)):
        start = 0
        while start < lengths[document]:
            spent, k = heapq.heappop(waiting)
            size = min(lengths[document] - start, capacities[k] - used[k])
            pieces.append((document, start, size, k, used[k]))
            used[k] += size
            start += size
            if used[k] < capacities[k]:
                heapq.heappush(waiting, (spent + cost.of(size), k))
    return pieces


def _packed(ids, tokens, length, cost, first_sequence, with_ids) -> tuple[pa.RecordBatch, int]:
    rows = []
    for document, start, size, sequence, offset in assign([len(t) for t in tokens], length, cost):
        raw = tokens[document][start : start + size].tobytes()
        rows.append(
            (
                ids[document],
                start,
                size,
                zlib.crc32(raw),
                len(tokens[document]),
                first_sequence + sequence,
                offset,
                raw if with_ids else None,
            )
        )
    names = [field.split()[0] for field in PIECES.split(", ")]
    kinds = [pa.int64()] * 7 + [pa.binary()]
    arrays = [pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)]
    sequences = max(row[5] for row in rows) + 1 - first_sequence
    return pa.RecordBatch.from_arrays(arrays, names), sequences


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    length: int = 2048,
    cost: Cost | None = None,
    ranks: str | None = None,
    tokenizer: str | None = None,
    special_id: int = 50256,
    end_id: int = 1,
    with_ids: bool = True,
) -> DataFrame:
    """The pieces of all documents in sequences of ``length`` tokens.

    A document is its text's ids (NULL: none) and the end id, so that an empty text is
    one token; each token is in exactly one piece. Each row is a piece: ``doc_id``,
    ``start`` and ``length`` in the document, ``ids_crc32`` of the ids as little-endian
    unsigned 32-bit numbers, ``doc_tokens``, ``sequence_id``, ``offset`` in the
    sequence, and ``ids`` (NULL unless ``with_ids``). Sequences are full, but for a few
    per group of documents whose length is a power of two.

    Packed in groups of two million tokens or one longer document, in the task that
    read them: nothing is shuffled, and a task holds one group. Rows that repeat an id are
    packed each for itself, as are rows without one. Other columns play no part. An empty
    table gives an empty one. The vocabulary's files must be found at the same path on
    every executor.
    """
    cost = cost or Cost()
    ranks = ranks or public_tokenizers.path("byte_bpe_50k.tiktoken")
    tokenizer = tokenizer or public_tokenizers.path("byte_bpe_50k.json")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = Ids(ranks, tokenizer, special_id, end_id).of
        sequence = TaskContext.get().partitionId() << 40
        ids, tokens, held = [], [], 0
        for batch in batches:
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids.append(doc)
                tokens.append(encode(text.as_py() or ""))
                held += len(tokens[-1])
                if held >= GROUP_TOKENS:
                    packed, used = _packed(ids, tokens, length, cost, sequence, with_ids)
                    sequence += used
                    ids, tokens, held = [], [], 0
                    yield packed
        if tokens:
            yield _packed(ids, tokens, length, cost, sequence, with_ids)[0]

    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column))
    return rows.toDF("doc_id", "text").mapInArrow(run, PIECES)
