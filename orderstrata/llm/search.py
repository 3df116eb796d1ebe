"""Ranked lexical search: short posting lists summed first, long ones looked up document by document."""

from __future__ import annotations

import heapq
from collections.abc import Iterable, Iterator
from math import ceil, floor, log

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from orderstrata.llm.common import new_folder

# Text of the items that are searched for in one pass over the documents.
PASS_BYTES = 1 << 20
# Documents and bytes of text that are indexed together, documents looked at in one step.
BLOCK_DOCS = 1 << 14
BLOCK_BYTES = 8 << 20
STEP = 1 << 11
# A list of at most this share of a block's documents is short.
SHORT_SHARE = 1 / 16

COUNTS = "term long, docs long, terms long"
HITS = "number long, item_id long, doc_id long, score long"

# Letters, digits and whatever is not ASCII make terms, A-Z as a-z; all else parts them.
_FOLDED = bytes(
    c if c >= 128 else ord(chr(c).lower()) if chr(c).isalnum() else 32 for c in range(256)
)


def terms(text: bytes) -> list[bytes]:
    return text.translate(_FOLDED).split()


def _texts(column: pa.Array) -> Iterator[bytes]:
    return (value.as_py() or b"" for value in column.cast(pa.binary()))


def _count(
    batches: Iterable[pa.RecordBatch], known: dict[bytes, int]
) -> Iterator[pa.RecordBatch]:
    """Documents and terms of a task, at -1, and for each known term the documents with it."""
    held = np.zeros(len(known), np.int64)
    docs = total = 0
    for batch in batches:
        for text in _texts(batch.column(0)):
            words = terms(text)
            docs += bool(words)
            total += len(words)
            met = known.keys() & set(words)
            held[[known[w] for w in met]] += 1
    rows = np.flatnonzero(held)
    columns = ([-1, *rows], [docs, *held[rows]], [total, *[0] * len(rows)])
    yield pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["term", "docs", "terms"]
    )


class _Best:
    """The highest scores of one item so far; of equal ones those with the smaller ids."""

    def __init__(self, size: int):
        self.size = size
        self.heap: list[tuple[int, bool, int]] = []

    @property
    def least(self) -> int:
        """A document needs this score to get in; with it, its id decides."""
        return self.heap[0][0] if len(self.heap) == self.size else 1

    def offer(self, score: int, doc_id: int | None) -> None:
        entry = (score, doc_id is not None, -(doc_id or 0))
        if len(self.heap) < self.size:
            heapq.heappush(self.heap, entry)
        else:
            heapq.heappushpop(self.heap, entry)

    def rows(self) -> Iterator[tuple[int | None, int]]:
        for score, has_id, negated in self.heap:
            yield (-negated if has_id else None), score


class _Block:
    """Posting lists of some documents: the known terms, with what each adds to a score."""

    def __init__(self, ids: list, found: list[np.ndarray], damping: list[int], weights: np.ndarray):
        self.ids = ids
        count = len(ids)
        where = np.repeat(np.arange(count), [len(f) for f in found])
        pairs, uses = np.unique(np.concatenate(found) * count + where, return_counts=True)
        term, self.docs = pairs // count, pairs % count
        uses = uses.astype(np.int64)
        weakened = 1000 * uses + 8 * np.array(damping, np.int64)[self.docs]
        self.gains = weights[term] * (1_000_000_000 * uses // weakened)
        self.starts = np.searchsorted(term, np.arange(len(weights) + 1))

    def _lists(self, wanted: list[int]) -> tuple[list, list]:
        """Posting lists of an item, short and long, without those that add nothing."""
        short, long_ = [], []
        most = len(self.ids) * SHORT_SHARE
        for term in wanted:
            a, b = self.starts[term], self.starts[term + 1]
            if a < b and self.gains[a:b].any():
                (short if b - a <= most else long_).append((self.docs[a:b], self.gains[a:b]))
        return short, long_

    def search(self, wanted: list[int], best: _Best) -> None:
        """Offers every document whose score may be among the best.

        The short lists become one list of documents with summed gains. From there on that
        list and the long ones are followed document by document, some documents a step:
        one that stands only in lists whose greatest gains together stay below the least
        score wanted is not looked at, and one that is looked at is given up as soon as
        its sum and the greatest gains of the lists not yet asked stay below.
        """
        short, long_ = self._lists(wanted)
        summed = _summed(short)
        long_.sort(key=lambda one: -int(one[1].max()))
        greatest = [int(gains.max()) for _, gains in long_]
        rest = [sum(greatest[k:]) for k in range(len(long_) + 1)]
        if not len(summed[0]) and not long_:
            return
        for low in range(0, len(self.ids), STEP):
            high = low + STEP
            least = best.least
            leading = next((k for k, bound in enumerate(rest) if bound < least), len(long_))
            a, b = np.searchsorted(summed[0], (low, high))
            parts = [summed[0][a:b]]
            for docs, _ in long_[:leading]:
                c, d = np.searchsorted(docs, (low, high))
                parts.append(docs[c:d])
            looked_at = parts[0] if leading == 0 else np.unique(np.concatenate(parts))
            if not len(looked_at):
                continue
            score = np.zeros(len(looked_at), np.int64)
            score[np.searchsorted(looked_at, parts[0])] = summed[1][a:b]
            for k, (docs, gains) in enumerate(long_):
                alive = score + rest[k] >= least
                looked_at, score = looked_at[alive], score[alive]
                if not len(looked_at):
                    break
                at = np.minimum(np.searchsorted(docs, looked_at), len(docs) - 1)
                score += np.where(docs[at] == looked_at, gains[at], 0)
            for doc in np.flatnonzero(score >= least).tolist():
                if score[doc] >= best.least:
                    best.offer(int(score[doc]), self.ids[looked_at[doc]])


def _summed(lists: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    """Several posting lists as one, by document."""
    if not lists:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    docs = np.concatenate([docs for docs, _ in lists])
    gains = np.concatenate([gains for _, gains in lists])
    order = np.argsort(docs, kind="stable")
    docs, first = np.unique(docs[order], return_index=True)
    return docs, np.add.reduceat(gains[order], first)


def _blocks(
    batches: Iterable[pa.RecordBatch], known: dict[bytes, int], weights: np.ndarray, n: int, total: int
) -> Iterator[_Block]:
    ids, found, damping, size = [], [], [], 0
    for batch in batches:
        for doc_id, text in zip(batch.column(0).to_pylist(), _texts(batch.column(1)), strict=True):
            words = terms(text)
            at = np.fromiter((known.get(w, -1) for w in words), np.int64, len(words))
            at = at[at >= 0]
            if not len(at):
                continue
            ids.append(doc_id)
            found.append(at)
            damping.append(10 + 90 * len(words) * n // total)
            size += len(text)
            if len(ids) >= BLOCK_DOCS or size >= BLOCK_BYTES:
                yield _Block(ids, found, damping, weights)
                ids, found, damping, size = [], [], [], 0
    if ids:
        yield _Block(ids, found, damping, weights)


def _search(
    batches: Iterable[pa.RecordBatch],
    items: list[tuple[int, int | None, list[int]]],
    known: dict[bytes, int],
    weights: np.ndarray,
    n: int,
    total: int,
    k: int,
) -> Iterator[pa.RecordBatch]:
    best = [_Best(k) for _ in items]
    for block in _blocks(batches, known, weights, n, total):
        for (_, _, wanted), kept in zip(items, best, strict=True):
            block.search(wanted, kept)
    rows = [
        (number, item_id, doc_id, score)
        for (number, item_id, _), kept in zip(items, best, strict=True)
        for doc_id, score in kept.rows()
    ]
    columns = list(zip(*rows, strict=True)) or [()] * 4
    names = [f.split()[0] for f in HITS.split(", ")]
    yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)


def _weight(n: int, held: int) -> int:
    return floor(1000 * log((2 * n + 2) / (2 * held + 1)))


def _one_pass(docs: DataFrame, items: list[tuple[int, int | None, bytes]], k: int) -> DataFrame:
    """Each task's best documents for each item; counts over all documents come first."""
    known: dict[bytes, int] = {}
    wanted = []
    for number, item_id, text in items:
        own = [known.setdefault(w, len(known)) for w in dict.fromkeys(terms(text))]
        wanted.append((number, item_id, own))
    counted = docs.select("text").mapInArrow(lambda it: _count(it, known), COUNTS)
    sums = counted.groupBy("term").agg(F.sum("docs").alias("docs"), F.sum("terms").alias("terms"))
    counts = {row.term: row for row in sums.collect()}  # a row for each term of these items
    n, total = (counts[-1].docs, counts[-1].terms) if counts else (0, 0)
    held = (counts[t].docs if t in counts else 0 for t in range(len(known)))
    weights = np.array([_weight(n, h) for h in held], np.int64)
    return docs.select("doc_id", "text").mapInArrow(
        lambda it: _search(it, wanted, known, weights, n, total, k), HITS
    )


def ranked(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    id_column: str = "doc_id",
    text_column: str = "text",
    item_column: str = "item_id",
    item_text_column: str = "text",
) -> DataFrame:
    """The ``k`` documents that score highest for each item, by weighted and damped term counts.

    Terms are runs of ASCII letters and digits and of all characters beyond ASCII, with A-Z
    as a-z. With N documents that hold a term and L terms in all of them, a term in df
    documents weighs ``floor(1000 ln((2N + 2) / (2df + 1)))``; a document of n terms adds,
    for each distinct term of the item that it holds tf times, the weight times
    ``10**9 tf div (1000 tf + 8m)``, where m is ``10 + 90nN div L``. Returns ``item_id``,
    ``rank`` from 1, ``doc_id`` and ``score`` for scores above 0; equal ones by ascending id.

    Every task indexes the documents it reads, some thousand at a time, and keeps the best
    of each item across these blocks, so that later blocks are mostly skipped; no text is
    shuffled, only each task's best rows. An item's short posting lists of a block are
    summed term by term; that sum and the long lists are then followed document by document
    (:meth:`_Block.search`). Bounds are exact, so the result does not depend on blocks or
    tasks. Items are taken in blocks of about a megabyte of text, two passes over the
    documents each: one counts the terms of these items in all documents, one ranks.

    A NULL or empty text has no term: such a document counts for nothing and such an item
    finds nothing. A long text is one document of its block. Rows that repeat an id or a
    text are ranked each for itself, an item that comes twice is answered twice. A document
    without an id comes after those with one of the same score; an item's NULL id is passed
    on. Other columns play no part, whatever their names. An empty table on either side
    gives an empty result.
    """
    rows = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text"))
    asked = items.select(
        F.col(item_column).cast("long").alias("item_id"), F.col(item_text_column).alias("text")
    ).where("text <> ''")
    size = asked.agg(F.sum(F.octet_length("text"))).head()[0] or 0
    passes = max(1, ceil(size / PASS_BYTES))
    spread = F.pmod(F.xxhash64("item_id", "text"), F.lit(passes))

    def one_pass(at: int) -> DataFrame:
        listed = asked.where(spread == at).collect()
        numbered = [((at << 32) + i, r.item_id, r.text.encode()) for i, r in enumerate(listed)]
        return _one_pass(rows, numbered, k)

    if passes == 1:
        hits = one_pass(0)
    else:
        path = new_folder(docs.sparkSession, "hits")
        for at in range(passes):
            one_pass(at).write.mode("append").parquet(path)
        hits = docs.sparkSession.read.schema(HITS).parquet(path)
    first = Window.partitionBy("number").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    placed = hits.withColumn("rank", F.row_number().over(first)).where(F.col("rank") <= k)
    return placed.select("item_id", "rank", "doc_id", "score")
