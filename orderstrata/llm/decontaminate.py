"""Benchmark items inside long documents: MinHash sketches by item size, then exact shingles."""

from __future__ import annotations

import hashlib
from collections import defaultdict
from collections.abc import Iterable, Iterator
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstrata.llm.common import new_folder

# Text of the items that are searched for in one pass over the documents.
PASS_BYTES = 4 << 20
WORDS_AT_ONCE = 1 << 18
LEAKS = "doc_id long, item_id long, item_shingles long, shared long, containment double"


def plain_words(text: Column) -> Column:
    """Lower-cased runs of letters and digits, one blank between them."""
    return F.trim(F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}]+", " "))


class Index:
    """Items by the least hashes of their shingles.

    Items are parted by size, a part for each power of two. An item of ``n`` shingles
    in a part of at most ``u`` is found by its sketch, the ``floor((1 - t) * u) + 1``
    shingles of least hash: a document that holds the share ``t`` of the item misses
    fewer shingles than that, so it always holds one of the sketch.
    """

    def __init__(self, items: Iterable[tuple[int | None, str]], width: int, share: float):
        self.width, self.share = width, share
        self.words: dict[str, int] = {}
        self.items: list[tuple[int | None, frozenset[tuple[int, ...]]]] = []
        sketches: dict[int, list[int]] = defaultdict(list)
        for item_id, text in items:
            known = [self.words.setdefault(w, len(self.words) + 1) for w in text.split()]
            shingles = frozenset(self._shingles(known))
            if not shingles:
                continue
            most = 1 << (len(shingles) - 1).bit_length()
            hashes = sorted((self._hash(s), s) for s in shingles)
            for _, shingle in hashes[: int((1 - share) * most + 1e-9) + 1]:
                sketches[self._code(shingle)].append(len(self.items))
            self.items.append((item_id, shingles))
        self.widths = sorted({len(s) for _, shingles in self.items for s in shingles})
        self.codes = np.array(sorted(sketches), np.uint64)
        self.owners = [sketches[c] for c in self.codes.tolist()]

    def _shingles(self, words: list[int]) -> list[tuple[int, ...]]:
        """All runs of ``width`` words; a shorter text is one shingle, an empty one none."""
        width = min(self.width, len(words))
        return [tuple(words[k : k + width]) for k in range(len(words) - width + 1)] if words else []

    @staticmethod
    def _hash(shingle: tuple[int, ...]) -> bytes:
        return hashlib.blake2b(repr(shingle).encode(), digest_size=8).digest()

    def _code(self, shingle: tuple[int, ...]) -> int:
        code = len(shingle)
        for word in shingle:
            code = (code * 0x9E3779B97F4A7C15 + word) % (1 << 64)
        return code

    def _codes(self, ids: np.ndarray, width: int) -> np.ndarray:
        """The code of each run of known words, 0 where a word is in no item."""
        count = len(ids) - width + 1
        codes = np.full(count, width, np.uint64)
        known = np.ones(count, bool)
        for k in range(width):
            part = ids[k : k + count]
            codes = codes * np.uint64(0x9E3779B97F4A7C15) + part
            known &= part != 0
        return codes[known]

    def found(self, text: str) -> Iterator[tuple[int | None, int, int]]:
        """Items that the text holds, with their number of shingles and the number shared."""
        words = text.split()
        get = self.words.get
        ids = np.fromiter((get(w, 0) for w in words), np.uint64, len(words))
        candidates: set[int] = set()
        for width in self.widths:
            for at in range(0, max(0, len(ids) - width + 1), WORDS_AT_ONCE):
                codes = self._codes(ids[at : at + WORDS_AT_ONCE + width - 1], width)
                at_code = np.searchsorted(self.codes, codes)
                at_code[at_code == len(self.codes)] = 0
                hits = np.unique(at_code[self.codes[at_code] == codes])
                candidates.update(k for h in hits.tolist() for k in self.owners[h])
        if not candidates:
            return
        wanted = frozenset().union(*(self.items[k][1] for k in candidates))
        held: set[tuple[int, ...]] = set()
        for width in {len(t) for t in wanted}:
            for at in range(0, max(0, len(ids) - width + 1), WORDS_AT_ONCE):
                listed = ids[at : at + WORDS_AT_ONCE + width - 1].tolist()
                runs = zip(*(listed[k:] for k in range(width)), strict=False)
                held.update(wanted.intersection(runs))
        for k in sorted(candidates):
            item_id, shingles = self.items[k]
            shared = len(shingles & held)
            if shared >= self.share * len(shingles) - 1e-9:
                yield item_id, len(shingles), shared


def _search(
    batches: Iterable[pa.RecordBatch], items: list[tuple[int | None, str]], width: int, share: float
) -> Iterator[pa.RecordBatch]:
    index = Index(items, width, share)
    kinds = [pa.int64()] * 4 + [pa.float64()]
    names = [f.split()[0] for f in LEAKS.split(", ")]
    for batch in batches:
        rows = [
            (doc_id, item_id, size, shared, shared / size)
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True)
            for item_id, size, shared in index.found(text.as_py() or "")
        ]
        columns = list(zip(*rows, strict=True)) or [()] * 5
        arrays = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names)


def leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
    width: int = 5,
    share: float = 0.8,
) -> DataFrame:
    """Documents that hold at least ``share`` of the distinct shingles of a benchmark item.

    Words are runs of letters and digits, lower-cased; a shingle is ``width`` words. A
    row for each such document and item: ``doc_id``, ``item_id``, ``item_shingles``,
    ``shared``, ``containment``. An item with fewer words is one shingle of all of
    them; one without words is never found. NULL texts count as empty; NULL ids are
    passed on; repeated rows and equal items are found each for itself. Other columns play
    no part. An empty table on either side gives an empty result.

    No document is shuffled. The items, of which their total size is counted first, are
    taken in blocks of about four megabytes of text, one pass over the documents for
    each, so that what a task holds of them is bounded whatever the benchmark's size.
    Of several blocks each one's result is written to the shared folder before the next
    is read, so that the driver holds one block as well.
    """
    items = benchmark.select(
        F.col(item_column).cast("long").alias("item_id"),
        plain_words(F.col(item_text_column)).alias("text"),
    ).where("text <> ''")
    size = items.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    passes = max(1, ceil(size / PASS_BYTES))
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        plain_words(F.col(text_column)).alias("text"),
    )
    spread = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))

    def one_pass(number: int) -> DataFrame:
        listed = [(r.item_id, r.text) for r in items.where(spread == number).collect()]
        return rows.mapInArrow(lambda it: _search(it, listed, width, share), LEAKS)

    if passes == 1:
        return one_pass(0)
    path = new_folder(docs.sparkSession, "leaks")
    for number in range(passes):
        one_pass(number).write.mode("append").parquet(path)
    return docs.sparkSession.read.schema(LEAKS).parquet(path)
