"""Repeated spans of words, from a de Bruijn graph whose paths stay compact as long as they can.

An edge of the graph is a run of ``window`` words, from the node of all but its last word to
that of all but its first; a document is a path. What repeats are edges that stand at two
places or more. One row for each edge and place would be many times the corpus, so edges come
as paths: consecutive edges with the same anchor, the eight words of least hash among theirs,
are one row. Equal edges have equal anchors, hence

- a path whose anchor stands nowhere else repeats nothing;
- where all paths of an anchor are equal, none branches: they repeat as a whole;
- only where paths of an anchor differ, and so branch, each distinct one is taken apart into
  its edges, and these are joined with one another.

Each repeated edge has another place as its source. Paths and edges that go on where the one
before ends, in the document as in its source, become one span, and spans are held against
their sources word by word, by strong digests taken at both places.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import LongType, StringType, StructField, StructType

from orderstrata.llm.batches import batch_rows, store_batches
from orderstrata.llm.common import plainly_named, stored, unused_name

ANCHOR_WORDS = 8
# Words hashed at a time, and windows whose anchors are looked for at a time.
WORDS_AT_ONCE = 1 << 17
# Spans are compared with their sources in pieces that end at multiples of this.
PIECE = 64
# Other hashes are taken when a comparison fails; so often by chance as never to be seen.
SEEDS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)

PATHS = "anchor long, form long, batch_id long, start long, n long"
EDGES = "edge long, batch_id long, start long, times long"
DIGESTS = "batch_id long, start long, n long, digest binary"


# --- words of a batch -----------------------------------------------------------------


class _Words:
    """All words of a batch: where each is among the bytes, and where each document's end."""

    def __init__(self, rows: pa.RecordBatch, text: int):
        texts = [v.as_py() or b"" for v in rows.column(text).cast(pa.binary())]
        # a blank after each text, so that no word crosses documents
        self.data = np.frombuffer(b" ".join([*texts, b""]), np.uint8)
        blank = (self.data == 32) | ((self.data >= 9) & (self.data <= 13))
        steps = np.flatnonzero(np.diff(blank, prepend=True, append=True))
        self.starts, self.ends = steps[::2], steps[1::2]
        text_ends = np.cumsum(np.fromiter((len(t) + 1 for t in texts), np.int64, len(texts)))
        self.doc_ends = np.searchsorted(self.starts, text_ends)

    def hashes(self, seed: int) -> np.ndarray:
        """A number for each word, equal for equal ones: its bytes as digits, mixed."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        parts = []
        for at in range(0, len(self.starts), WORDS_AT_ONCE):
            starts, ends = self.starts[at : at + WORDS_AT_ONCE], self.ends[at : at + WORDS_AT_ONCE]
            digits = self.data[starts[0] : ends[-1]].astype(np.uint64) + np.uint64(1)
            sums = _Sums(digits, seed)
            parts.append(sums.between(starts - starts[0], ends - starts[0]))
        return np.concatenate(parts)

    def windows(self, window: int) -> np.ndarray:
        """First words of all windows that lie in one document."""
        inside = np.ones(len(self.starts), bool)
        for end in np.unique(self.doc_ends):
            inside[max(0, end - window + 1) : end] = False
        return np.flatnonzero(inside)

    def text(self, start: int, end: int) -> bytes:
        """Some words, at least one, with one blank between them."""
        return b" ".join(self.data[self.starts[start] : self.ends[end - 1]].tobytes().split())

    def kept(self, keep: np.ndarray, ends: np.ndarray) -> list[bytes]:
        """The words to keep, with one blank between them, up to each of the ends."""
        first, past = self.starts[keep], self.ends[keep]
        low, high = (first[0], past[-1] + 1) if len(first) else (0, 0)
        steps = np.zeros(high - low + 1, np.int8)
        steps[first - low] = 1
        np.add.at(steps, past + 1 - low, -1)  # each word with the blank behind it
        data = self.data[low:high].copy()
        data[past - low] = 32
        raw = data[np.cumsum(steps[:-1], dtype=np.int8) > 0].tobytes()
        sizes = np.concatenate(([0], np.cumsum(past - first + 1)))
        cuts = sizes[np.concatenate(([0], np.cumsum(keep)))[ends]]
        return [raw[a : max(a, b - 1)] for a, b in zip([0, *cuts[:-1]], cuts, strict=True)]


def _mixed(values: np.ndarray) -> np.ndarray:
    values = values ^ (values >> np.uint64(32))
    values *= np.uint64(SEEDS[1])
    values ^= values >> np.uint64(29)
    values *= np.uint64(SEEDS[2])
    return values ^ (values >> np.uint64(32))


def _powers(base: int, count: int) -> np.ndarray:
    out = np.full(count, base, np.uint64)
    out[:1] = 1
    return np.cumprod(out)


class _Sums:
    """Hashes of any runs of some numbers: differences of sums weighted with powers of a seed."""

    def __init__(self, numbers: np.ndarray, seed: int):
        self.seed = seed
        weighted = numbers * _powers(seed, len(numbers))
        self.sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(weighted)))

    def between(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        inverse = _powers(pow(self.seed, -1, 1 << 64), len(self.sums))
        moved = (self.sums[ends] - self.sums[starts]) * inverse[starts]
        return _mixed(moved + (ends - starts).astype(np.uint64))


# --- what tasks take from batches ---------------------------------------------------------


def _of_batches(
    batches: Iterable[pa.RecordBatch], text: int, schema: str, made: Callable
) -> Iterator[pa.RecordBatch]:
    """Rows that ``made`` gives for the words of each batch and what was sent to it."""
    names = [f.split()[0] for f in schema.split(", ")]
    for batch in batches:
        for number, raw, *sent in zip(
            batch.column(0).to_pylist(), *batch.columns[1:], strict=True
        ):
            words = _Words(batch_rows(raw.as_py()), text)
            columns = made(words, *[s.values for s in sent])
            size = len(columns[0])
            columns.insert(names.index("batch_id"), np.full(size, number, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in columns], names)


def _paths(words: _Words, window: int, seed: int) -> list[np.ndarray]:
    """Anchor, hash of all words, first window and number of windows of each path."""
    hashes = words.hashes(seed)
    firsts = words.windows(window)
    if not len(firsts):
        return [np.empty(0, np.int64)] * 4
    at = np.arange(len(hashes) - ANCHOR_WORDS + 1)
    grams = _Sums(hashes, seed).between(at, at + ANCHOR_WORDS)
    around = np.lib.stride_tricks.sliding_window_view(grams, window - ANCHOR_WORDS + 1)
    anchors = np.concatenate(
        [
            some + around[some].argmin(axis=1)
            for some in np.split(firsts, range(WORDS_AT_ONCE, len(firsts), WORDS_AT_ONCE))
        ]
    )
    new = (np.diff(anchors, prepend=-1) != 0) | (np.diff(firsts, prepend=-2) != 1)
    begins = np.flatnonzero(new)
    n = np.diff(np.append(begins, len(firsts)))
    starts, anchors = firsts[begins], anchors[begins]
    # with the anchor's place in the path, so that equal paths have it at the same one
    whole = _Sums(hashes, seed).between(starts, starts + n + window - 1)
    forms = _mixed(whole + (anchors - starts).astype(np.uint64))
    return [grams[anchors].view(np.int64), forms.view(np.int64), starts, n]


def _edges(words: _Words, opened: pa.StructArray, window: int, seed: int) -> list[np.ndarray]:
    """The edges of some paths: hash, first word, and how often the path is there."""
    starts, n, times = (opened.field(k).to_numpy() for k in ("start", "n", "times"))
    sums = _Sums(words.hashes(seed), seed)
    owner = np.repeat(np.arange(len(n)), n)
    at = starts[owner] + np.arange(len(owner)) - np.repeat(np.cumsum(n) - n, n)
    return [sums.between(at, at + window).view(np.int64), at, times[owner]]


def _digests(words: _Words, asked: pa.StructArray, window: int) -> list:
    """A strong digest of the words of each run of windows."""
    starts, n = asked.field("start").to_numpy(), asked.field("n").to_numpy()
    ends = starts + n + window - 1
    found = [
        hashlib.blake2b(words.text(a, b), digest_size=16).digest()
        for a, b in zip(starts.tolist(), ends.tolist(), strict=True)
    ]
    return [starts, n, pa.array(found, pa.binary())]


def _cut(batches: Iterable[pa.RecordBatch], text: int, window: int) -> Iterator[pa.RecordBatch]:
    """The rows of each batch with their number of words, of words to go, and what is left."""
    for batch in batches:
        for raw, sent in zip(batch.column(0), batch.column(1), strict=True):
            rows = batch_rows(raw.as_py())
            words = _Words(rows, text)
            steps = np.zeros(len(words.starts) + 1, np.int64)
            if sent.is_valid:
                starts, n = sent.values.field("start").to_numpy(), sent.values.field("n").to_numpy()
                np.add.at(steps, starts, 1)
                np.add.at(steps, starts + n + window - 1, -1)
            keep = np.cumsum(steps[:-1]) == 0
            kept = words.kept(keep, words.doc_ends)
            left = np.diff(np.concatenate(([0], np.cumsum(keep)))[words.doc_ends], prepend=0)
            sizes = np.diff(words.doc_ends, prepend=0)
            added = [sizes, sizes - left, pa.array(kept, pa.binary()).cast(pa.string())]
            yield pa.RecordBatch.from_arrays(
                [*rows.columns, *[pa.array(a) for a in added]],
                [*rows.schema.names, "n_words", "n_removed", "kept"],
            )


# --- the graph ---------------------------------------------------------------------------------


def _sent(rows: DataFrame, *columns: str) -> DataFrame:
    """For each batch the list of what concerns it; never more than its words give."""
    return rows.groupBy("batch_id").agg(F.collect_list(F.struct(*columns)).alias("sent"))


def _repeated_paths(batches: DataFrame, text: int, window: int, seed: int) -> DataFrame:
    """Paths and edges that stand elsewhere too: ``batch_id``, ``start``, ``n`` and their source."""

    def taken(given: DataFrame, schema: str, made: Callable) -> DataFrame:
        return given.mapInArrow(lambda it: _of_batches(it, text, schema, made), schema)

    paths = taken(batches.select("batch_id", "rows"), PATHS, lambda words: _paths(words, window, seed))
    anchors = paths.groupBy("anchor").agg(
        F.count("*").alias("places"), (F.min("form") != F.max("form")).alias("branches")
    )
    # stored, so that the join has a plain shuffle on both sides, which can be split
    met = stored(anchors.where("places > 1").select("anchor", "branches"), "anchors")
    paths = stored(paths.join(met, "anchor"), "paths")

    place = F.struct("batch_id", "start")
    forms = paths.groupBy("anchor", "form", "n", "branches").agg(
        F.count("*").alias("times"), F.min(place).alias("first"), F.max(place).alias("last")
    )
    forms = stored(forms, "forms")

    def sources(rows: DataFrame) -> DataFrame:
        """The first place of the kind; that one's own source is the last."""
        source = F.when(F.col("first") == place, F.col("last")).otherwise(F.col("first"))
        return rows.select(
            "batch_id",
            "start",
            "n",
            source["batch_id"].alias("from_batch"),
            source["start"].alias("from_start"),
        )

    whole = forms.where("times > 1").select("anchor", "form", "n", "first", "last")
    as_a_whole = sources(paths.select("anchor", "form", "n", "batch_id", "start").join(
        whole, ["anchor", "form", "n"]
    ))

    opened = forms.where("branches").select("first.*", "n", F.least("times", F.lit(2)).alias("times"))
    given = batches.select("batch_id", "rows").join(_sent(opened, "start", "n", "times"), "batch_id")
    edges = taken(given, EDGES, lambda words, sent: _edges(words, sent, window, seed))
    edges = stored(edges, "edges")
    several = edges.groupBy("edge").agg(
        F.sum("times").alias("all"), F.min(place).alias("first"), F.max(place).alias("last")
    )
    several = stored(several.where(F.col("all") > 1).select("edge", "first", "last"), "several")
    # paths that are there twice are known to repeat; of the others it is asked edge by edge
    single = edges.where("times = 1").select("edge", "batch_id", "start", F.lit(1).cast("long").alias("n"))
    return as_a_whole.unionByName(sources(single.join(several, "edge")))


def _joined_up(steps: DataFrame) -> DataFrame:
    """Steps that follow one another in the document and in their source, as one span."""
    order = Window.partitionBy("batch_id").orderBy("start")
    before = {c: F.lag(c).over(order) for c in ("start", "n", "from_batch", "from_start")}
    goes_on = (
        (F.col("start") == before["start"] + before["n"])
        & (F.col("from_batch") == before["from_batch"])
        & (F.col("from_start") == before["from_start"] + before["n"])
    )
    opens = steps.withColumn("opens", (~F.coalesce(goes_on, F.lit(False))).cast("int"))
    spans = opens.withColumn("span", F.sum("opens").over(order))
    return spans.groupBy("batch_id", "span").agg(
        F.min("start").alias("start"),
        F.sum("n").alias("n"),
        F.min("from_batch").alias("from_batch"),
        F.min("from_start").alias("from_start"),
    )


def _all_equal(batches: DataFrame, spans: DataFrame, text: int, window: int) -> bool:
    """Whether the words of every span are those of its source.

    Spans are cut at fixed places of their sources, so that what is asked of a batch has a
    bound even if very many spans have their source there.
    """
    last = F.expr(f"(from_start + n - 1) div {PIECE}")
    cells = spans.withColumn("cell", F.explode(F.sequence(F.expr(f"from_start div {PIECE}"), last)))
    low = F.greatest("from_start", F.col("cell") * PIECE)
    high = F.least(F.col("from_start") + F.col("n"), (F.col("cell") + 1) * PIECE)
    pieces = cells.select(
        "batch_id",
        (F.col("start") + low - F.col("from_start")).alias("start"),
        "from_batch",
        low.alias("from_start"),
        (high - low).alias("n"),
    )
    asked = pieces.select("batch_id", "start", "n").unionAll(
        pieces.select("from_batch", "from_start", "n")
    )
    given = batches.select("batch_id", "rows").join(
        _sent(asked.distinct(), "start", "n"), "batch_id"
    )
    digests = given.mapInArrow(
        lambda it: _of_batches(it, text, DIGESTS, lambda words, sent: _digests(words, sent, window)),
        DIGESTS,
    )
    digests = stored(digests, "digests")
    of_source = digests.toDF("from_batch", "from_start", "n", "of_source")
    met = pieces.join(digests, ["batch_id", "start", "n"])
    met = met.join(of_source, ["from_batch", "from_start", "n"])
    return met.where("digest <> of_source").isEmpty()


def mark_repeated_spans(docs: DataFrame, text_column: str = "text", window: int = 35) -> DataFrame:
    """``docs`` without the words of all ``window``-word runs that also start elsewhere.

    Words are runs of anything but blanks, tabs, line feeds, vertical tabs, form feeds and
    carriage returns, and are compared as they are. A word goes if it is covered by a run of
    ``window`` words of its document whose words also start at any other place, in the same
    document or another; runs are judged on the texts as given. Adds ``n_words``,
    ``n_removed`` and ``kept``, the words that stay with one blank between them; under
    these names with underscores before, where ``docs`` has such a column.

    Every row is a document of its own, whatever its id: rows that repeat a text remove one
    another's runs, the first one's too. A NULL or empty text has no words. A text longer
    than a batch is a batch of its own, of which a task holds some forty bytes for each word.
    All rows and columns stay. An empty table gives an empty one.

    Texts are moved once, into batches. A row for each path of edges is grouped by its
    anchor (see the module), those of anchors that stand alone end there; single edges are
    taken only from one of each of the differing paths of an anchor. Sums come before every
    shuffle, and joins on anchors, paths and edges that very many documents share are split
    by adaptive execution. Hashes choose, digests of 128 bits taken at both places decide:
    should any span differ from its source, all is done again with other hashes.
    """
    if window <= ANCHOR_WORDS:
        raise ValueError(f"window: more than {ANCHOR_WORDS} words")
    names, plain = docs.columns, plainly_named(docs)
    text = names.index(text_column)
    batches = store_batches(plain, text)
    for seed in SEEDS:
        spans = stored(_joined_up(_repeated_paths(batches, text, window, seed)), "spans")
        if _all_equal(batches, spans, text, window):
            break
    else:
        raise RuntimeError("differing words under equal hashes, whatever the seed")
    found = batches.join(_sent(spans, "start", "n"), "batch_id", "left").select("rows", "sent")
    added = [("n_words", LongType()), ("n_removed", LongType()), ("kept", StringType())]
    schema = StructType([*plain.schema.fields, *[StructField(n, t) for n, t in added]])
    cut = found.mapInArrow(lambda it: _cut(it, text, window), schema)
    return cut.toDF(*names, *[unused_name(docs, n) for n, _ in added])
