"""A quality classifier whose evidence on a document is weighed against its site's record."""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from orderstrata.llm.common import stored

# Labelled documents that the classifier is fitted on, at most; chosen by hash.
FITTED_AT_MOST = 10_000
BUCKETS = 1 << 24
# Bytes of a part of a word, and bytes of a text whose parts are listed at a time.
GRAM = 5
BYTES_AT_ONCE = 1 << 20
# Documents of the fit that must hold a word or a part before it counts.
LEAST_DOCUMENTS = 5
# Words and parts of a label's classifier: so many standard deviations off what chance
# gives, the farthest ones if there are more.
LEAST_Z = 4.5
WORDS_AT_MOST = 512
RIDGE = 0.5
NEWTON_STEPS = 12
ROWS_AT_ONCE = 1024
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())
EVIDENCE = "good double, toxic double"
STATISTICS = 9
LABELS = ("quality", "toxic")
FEATURED = "buckets binary, statistics binary, quality int, toxic int"
HELD = "quality_held binary, toxic_held binary, statistics binary, quality int, toxic int"

_WORD = re.compile(rb"[0-9a-z\x80-\xff]+")


def _parts(words: list[bytes]) -> np.ndarray:
    """Buckets of the runs of five bytes in words, a blank before and after each word."""
    spaced = np.frombuffer(b" ".join([b"", *words, b""]), np.uint8)
    found = [np.empty(0, np.int64)]
    for at in range(0, len(spaced) - GRAM + 1, BYTES_AT_ONCE):
        cut = spaced[at : at + BYTES_AT_ONCE + GRAM - 1]
        count = len(cut) - GRAM + 1
        value, whole = np.zeros(count, np.uint64), np.ones(count, bool)
        for k in range(GRAM):
            value = (value << np.uint64(8)) | cut[k : k + count]
            if 0 < k < GRAM - 1:
                whole &= cut[k : k + count] != 32
        spread = np.unique(value[whole]) * np.uint64(0x9E3779B97F4A7C15)
        found.append((spread >> np.uint64(40)).astype(np.int64))
    return np.concatenate(found)


def features(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of the distinct words and parts of words, and statistics of the whole text."""
    plain = text.lower()
    words = _WORD.findall(plain)
    distinct = set(words)
    buckets = np.fromiter((zlib.crc32(w) % BUCKETS for w in distinct), np.int64, len(distinct))
    buckets = np.concatenate((buckets, _parts(words)))
    tokens = plain.split()
    size, count = max(1, len(text)), max(1, len(tokens))
    letters = len(text) - len(text.translate(None, bytes(range(65, 91))))
    marks = len(text) - len(text.translate(None, MARKS))
    digits = len(text) - len(text.translate(None, b"0123456789"))
    repeated = sum(map(bytes.__eq__, tokens, tokens[1:]))
    marked = sum(not t[-1:].isalnum() and t[-1] < 128 for t in tokens)
    bars = sum(t in (b"|", b"-", b"*") for t in tokens)
    statistics = np.array(
        [
            np.log(count),
            len(distinct) / count,
            len(plain) / count,
            letters / size,
            marks / size,
            digits / size,
            repeated / count,
            marked / count,
            bars / count,
        ]
    )
    return np.unique(buckets).astype(np.int32), statistics


@dataclass
class Head:
    """Logistic regression for one label: words and parts that are there, and statistics."""

    buckets: np.ndarray
    words: np.ndarray
    statistics: np.ndarray
    means: np.ndarray
    scales: np.ndarray
    odds: float

    def chance(self, buckets: np.ndarray, statistics: np.ndarray) -> float:
        held = self.words[_held_of(self.buckets, buckets)].sum()
        z = np.clip((statistics - self.means) / self.scales, -5, 5)
        return 1 / (1 + np.exp(-np.clip(self.odds + held + z @ self.statistics, -30, 30)))


def _held_of(wanted: np.ndarray, buckets: np.ndarray) -> np.ndarray:
    """For each wanted bucket whether it is among a document's sorted ones."""
    if not len(buckets):
        return np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(buckets, wanted), len(buckets) - 1)
    return buckets[at] == wanted


def _fitted(
    chosen: np.ndarray, held: np.ndarray, statistics: np.ndarray, labels: np.ndarray, unknown: float
) -> Head:
    """Newton's method with a ridge penalty on words and statistics.

    ``held`` says which documents hold which of the chosen buckets. Without labels every
    document has the log odds ``unknown``.
    """
    count = len(labels)
    if not count:
        zeros, ones = np.zeros(STATISTICS), np.ones(STATISTICS)
        return Head(np.empty(0, np.int32), np.empty(0), zeros, zeros, ones, unknown)
    means, scales = statistics.mean(axis=0), statistics.std(axis=0) + 1e-6
    x = np.zeros((count, len(chosen) + STATISTICS + 1), np.float32)
    x[:, : len(chosen)] = held
    x[:, len(chosen) : -1] = np.clip((statistics - means) / scales, -5, 5)
    x[:, -1] = 1
    penalty = np.full(x.shape[1], RIDGE)
    w = np.zeros(x.shape[1])
    w[-1] = np.log((labels.sum() + 1) / (count - labels.sum() + 1))
    penalty[-1] = 1e-6
    for _ in range(NEWTON_STEPS):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        gradient = x.T @ (p - labels) + penalty * np.append(w[:-1], 0)
        curvature = np.diag(penalty)
        for at in range(0, count, ROWS_AT_ONCE):
            part = x[at : at + ROWS_AT_ONCE].astype(np.float64)
            curvature += (part * (p * (1 - p))[at : at + ROWS_AT_ONCE, None]).T @ part
        step = np.linalg.solve(curvature, gradient)
        w -= step * min(1.0, 5 / max(1e-9, np.abs(step).max()))
    return Head(chosen, w[: len(chosen)], w[len(chosen) : -1], means, scales, float(w[-1]))


def _featured(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        both = [features(t.as_py() or b"") for t in batch.column(0).cast(pa.binary())]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array([b.astype("<i4").tobytes() for b, _ in both], pa.binary()),
                pa.array([s.astype("<f8").tobytes() for _, s in both], pa.binary()),
                batch.column(1),
                batch.column(2),
            ],
            ["buckets", "statistics", "quality", "toxic"],
        )


def _tallied(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """For each bucket the documents that hold it, and those of them with the label."""
    for batch in batches:
        lists = [np.frombuffer(b.as_py(), "<i4") for b in batch.column(0)]
        marked = batch.column(1).to_numpy(zero_copy_only=False) > 0
        flat = np.concatenate([np.empty(0, np.int32), *lists])
        buckets, place = np.unique(flat, return_inverse=True)
        owner = np.repeat(marked, [len(b) for b in lists])
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(buckets, pa.int32()),
                pa.array(np.bincount(place, minlength=len(buckets)), pa.int64()),
                pa.array(np.bincount(place, owner, len(buckets)).astype(np.int64), pa.int64()),
            ],
            ["bucket", "n", "marked"],
        )


def _telling(given: DataFrame, label: str) -> np.ndarray:
    """Buckets that go with the label, or against it, by far more than chance allows."""
    known = given.where(F.col(label) >= 0).select("buckets", label)
    total = known.agg(F.count("*").alias("n"), F.count_if(F.col(label) > 0).alias("m")).head()
    if not total.n:
        return np.empty(0, np.int32)
    share, n = total.m / total.n, F.col("n")
    tallies = known.mapInArrow(_tallied, "bucket int, n long, marked long")
    tallies = tallies.groupBy("bucket").agg(F.sum("n").alias("n"), F.sum("marked").alias("marked"))
    chance = F.sqrt(F.greatest(n * (share * (1 - share)) * (1 - n / total.n), F.lit(1e-9)))
    z = F.abs(F.col("marked") - n * share) / chance
    far = tallies.where(n >= LEAST_DOCUMENTS).withColumn("z", z).where(F.col("z") >= LEAST_Z)
    most = far.orderBy(F.desc("z"), "bucket").limit(WORDS_AT_MOST).collect()
    return np.sort(np.array([r.bucket for r in most], np.int32))


def _held(
    batches: Iterable[pa.RecordBatch], chosen: dict[str, np.ndarray]
) -> Iterator[pa.RecordBatch]:
    """In place of its buckets, which of the chosen ones a document holds, as bits."""
    for batch in batches:
        lists = [np.frombuffer(b.as_py(), "<i4") for b in batch.column(0)]
        bits = [
            pa.array([np.packbits(_held_of(chosen[c], b)).tobytes() for b in lists], pa.binary())
            for c in LABELS
        ]
        yield pa.RecordBatch.from_arrays(
            [*bits, *batch.columns[1:]], [f.split()[0] for f in HELD.split(", ")]
        )


def _sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """At most 10,000 labels of documents at hand: one of each id, by hash, before any second."""
    ids = docs.select(F.col("doc_id").alias("at_hand"))
    known = labels.where(" OR ".join(f"{c} >= 0" for c in LABELS))
    known = known.join(ids, known["doc_id"] == ids["at_hand"], "left_semi")
    nth = F.row_number().over(Window.partitionBy("doc_id").orderBy(*LABELS))
    known = known.withColumn("nth", nth).where(F.col("nth") <= FITTED_AT_MOST)
    ordered = known.orderBy("nth", F.xxhash64("doc_id"), "doc_id")
    return ordered.limit(FITTED_AT_MOST)


def train(docs: DataFrame, labels: DataFrame) -> tuple[Head, Head]:
    """Heads for quality and toxicity, fitted on at most 10,000 labelled documents.

    Their features are written to the shared folder; tasks count in how many each word or
    part stands. Three numbers for each document are broadcast, and 64 bytes a head and
    its statistics come to the driver, whatever the corpus.
    """
    given = docs.join(F.broadcast(_sampled(docs, labels)), "doc_id")
    # of many rows with a sampled id one goes on; each task sends one at most
    first = Window.partitionBy("doc_id", "nth").orderBy(F.xxhash64("text"))
    given = given.withColumn("of_id", F.row_number().over(first)).where("of_id = 1")
    given = given.limit(FITTED_AT_MOST).select("text", *LABELS)
    given = stored(given.mapInArrow(_featured, FEATURED), "sample")
    chosen = {label: _telling(given, label) for label in LABELS}
    rows = given.mapInArrow(lambda it: _held(it, chosen), HELD).collect()
    heads = []
    # without labels all count as good, none as toxic
    for label, unknown in zip(LABELS, (30.0, -30.0), strict=True):
        known = [r for r in rows if r[label] >= 0]
        size = len(chosen[label])
        bits = np.frombuffer(b"".join(r[f"{label}_held"] for r in known), np.uint8)
        held = np.unpackbits(bits.reshape(len(known), (size + 7) // 8), axis=1)[:, :size]
        statistics = np.frombuffer(b"".join(r.statistics for r in known), "<f8")
        marked = np.array([min(r[label], 1) for r in known], np.float64)
        heads.append(
            _fitted(chosen[label], held, statistics.reshape(-1, STATISTICS), marked, unknown)
        )
    return heads[0], heads[1]


def _weighed(
    batches: Iterable[pa.RecordBatch], quality: Head, toxic: Head
) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        chances = []
        for text in batch.columns[-1].cast(pa.binary()):
            both = features(text.as_py() or b"")
            chances.append((quality.chance(*both), toxic.chance(*both)))
        good, bad = np.array(chances).reshape(-1, 2).T
        yield pa.RecordBatch.from_arrays(
            [*batch.columns[:-1], pa.array(good), pa.array(bad)],
            [*batch.schema.names[:-1], "good", "toxic"],
        )


def _strength(groups: DataFrame, mean: str) -> Column:
    """How many documents a prior is worth: by how much groups differ beyond chance.

    From the variance of group means about their prior (method of moments): with share
    m and variance t between groups the worth is m(1-m)/t - 1, from 1 to a million.
    """
    m, n = F.col(mean), F.col("n")
    chance = F.sum(m * (1 - m))
    spread = F.sum(n * F.pow(F.col("s") / n - m, 2)) - chance
    between = F.greatest(spread / F.sum("n"), F.lit(1e-9))
    worth = F.sum(n * m * (1 - m)) / F.sum("n") / between - 1
    return F.least(F.greatest(worth, F.lit(1.0)), F.lit(1e6))


def _mean(s: Column, n: Column, prior: Column, worth: Column) -> Column:
    return (s + worth * prior) / (n + worth)


def _logit(p: Column) -> Column:
    inside = F.least(F.greatest(p, F.lit(1e-9)), F.lit(1 - 1e-9))
    return F.log(inside / (1 - inside))


def judge(
    docs: DataFrame,
    labels: DataFrame,
    id_column: str = "doc_id",
    text_column: str = "text",
    host: str | Column = "source",
    path: str | Column = "lang",
    threshold: float = 0.5,
    row_column: str | None = None,
) -> DataFrame:
    """Each document's probability of being good, and whether to keep it.

    ``labels`` holds ``doc_id``, ``quality`` and ``toxic`` (0, 1 or NULL). Good is a
    document of quality that isn't toxic. Columns: ``doc_id``, ``host``, ``path``,
    ``good`` and ``toxic`` (by the classifier alone), ``site`` (the site's share of good
    documents, this one left out), ``posterior``, ``keep``; last ``row_column``, a long that
    tells rows apart, if one is named.

    The classifier is fitted on a bounded sample of labelled documents and applied to all.
    A site is a path of a host. Its share of good documents is taken from all of its
    documents, shrunk to its host's, that to the share of all documents: the fewer
    documents and the less sites differ beyond chance, the more. In log odds, the
    posterior is the classifier's evidence, the odds of all documents taken out, on top
    of the site's share.

    NULL texts count as empty, long ones are read whole; NULL hosts and paths are hosts and paths like others, NULL ids
    are passed on; rows that repeat an id are judged each for itself. Labels of unknown
    documents and rows without any are ignored before the sample is taken; of a document
    labelled twice each row counts, once every labelled document has its first. Without labels
    of a kind every document passes for good by it. Other columns play no part. An empty
    table gives an empty one. What is shuffled holds no text, and sites are summed in the
    tasks first, so that a host with most documents is no hot spot.
    """
    host = F.col(host) if isinstance(host, str) else host
    path = F.col(path) if isinstance(path, str) else path
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"),
        host.cast("string").alias("host"),
        path.cast("string").alias("path"),
        *[F.col(c).cast("long").alias("row") for c in [row_column] if c],
        F.col(text_column).alias("text"),
    )
    number = [F.coalesce(F.col(c).cast("int"), F.lit(-1)).alias(c) for c in ("quality", "toxic")]
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), *number)
    quality, toxic = train(rows.select("doc_id", "text"), known)
    row = "row long, " if row_column else ""
    schema = f"doc_id long, host string, path string, {row}{EVIDENCE}"
    weighed = rows.mapInArrow(lambda it: _weighed(it, quality, toxic), schema)
    evidence = stored(weighed.withColumn("fine", F.expr("good * (1 - toxic)")), "evidence")
    judged = _with_sites(evidence, threshold)
    return judged.withColumnRenamed("row", row_column) if row_column else judged


def _with_sites(evidence: DataFrame, threshold: float) -> DataFrame:
    sites = stored(
        evidence.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("fine").alias("s")),
        "sites",
    )
    hosts = sites.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    total = sites.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).head()
    overall = min(max((total.s or 0.0) / (total.n or 1), 1e-6), 1 - 1e-6)
    hosts = hosts.withColumn("prior", F.lit(overall))
    worth = hosts.agg(_strength(hosts, "prior").alias("w")).head().w or 1.0
    hosts = hosts.select(
        "host", _mean(F.col("s"), F.col("n"), F.col("prior"), F.lit(worth)).alias("host_share")
    )
    near = sites.withColumnRenamed("host", "site_host").join(
        hosts, F.col("site_host").eqNullSafe(F.col("host"))
    )
    near = near.select("host", "path", "n", "s", "host_share")
    worth = near.agg(_strength(near, "host_share").alias("w")).head().w or 1.0
    near = near.toDF("site_host", "site_path", "n", "s", "host_share")
    same = F.col("host").eqNullSafe(F.col("site_host")) & F.col("path").eqNullSafe(
        F.col("site_path")
    )
    others = _mean(F.col("s") - F.col("fine"), F.col("n") - 1, F.col("host_share"), F.lit(worth))
    joined = evidence.join(near, same).withColumn("site", others)
    log_odds = _logit(F.col("fine")) - _logit(F.lit(overall)) + _logit(F.col("site"))
    posterior = (1 / (1 + F.exp(-log_odds))).alias("posterior")
    judged = joined.select(
        "doc_id", "host", "path", "good", "toxic", "site", posterior,
        *[c for c in evidence.columns if c == "row"],
    )
    keep = F.col("posterior") >= threshold - 1e-9
    columns = ["doc_id", "host", "path", "good", "toxic", "site", "posterior"]
    return judged.select(*columns, keep.alias("keep"), *judged.columns[len(columns) :])
