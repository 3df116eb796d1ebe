"""A log-bilinear language model, trained by noise-contrastive estimation."""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstrata.llm.common import new_folder, stored

# Words that the model predicts one by one; the others are one class, shared out by count.
CLASSES = 1024
# Most frequent words, at most, of which every task holds the counts; the others' come by a join.
LISTED_WORDS = 1 << 18
# Bytes of a word that can be listed: what tasks hold is 64 MB at most, however long words are.
LISTED_BYTES = 256
# Distinct words that a task counts before it sends them on.
COUNTED_AT_ONCE = 1 << 19
PARTS_OF_MEANS = 16
# Rounds of training, each on so many times the texts of the one before, all of them once.
ROUNDS = 12
GROWTH = 1.4
# Texts, and bytes of each at most, that only tell how far a round's moves are followed.
STEP_TEXTS = 256
STEP_BYTES = 1 << 15

REST, EDGE = 0, 1
END = b""  # the token after a text; no word is empty
NOISE = 24
BATCH = 1024


@dataclass
class Model:
    """log p(w | u, v) = r_u . (near * q_w) + r_v . (far * q_w) + b_w - log z(u, v).

    ``u`` is the word before, ``v`` the one before that. ``near`` and ``far`` scale the
    components by the word's place.
    """

    context: np.ndarray
    target: np.ndarray
    places: np.ndarray
    bias: np.ndarray

    @classmethod
    def start(cls, counts: np.ndarray, size: int, seed: int) -> Model:
        rng = np.random.default_rng(seed)
        shape = (len(counts), size)
        return cls(
            rng.normal(0, 0.3, shape),
            rng.normal(0, 0.05, shape),
            np.array([np.ones(size), np.full(size, 0.7)]),
            np.log(counts / counts.sum()),
        )

    def flat(self) -> np.ndarray:
        return np.concatenate([a.reshape(-1) for a in vars(self).values()])

    def filled(self, flat: np.ndarray) -> Model:
        parts, at = [], 0
        for array in vars(self).values():
            parts.append(flat[at : at + array.size].reshape(array.shape))
            at += array.size
        return Model(*parts)

    def tables(self) -> tuple[np.ndarray, np.ndarray]:
        """Scores by word before and word, by word before that and word; log z by both.

        z(u, v) sums exp(near score) * exp(far score + bias) over all words: a product of
        two matrices gives it for every pair of words at once.
        """
        near = (self.context * self.places[0]) @ self.target.T
        far = (self.context * self.places[1]) @ self.target.T + self.bias
        tops = near.max(axis=1, keepdims=True), far.max(axis=1, keepdims=True)
        z = np.exp(near - tops[0]) @ np.exp(far - tops[1]).T
        return np.stack([near, far]), np.log(z) + tops[0] + tops[1].T


class Trainer:
    """Noise-contrastive estimation by AdaGrad, with the noise words shared in a batch."""

    def __init__(
        self, model: Model, counts: np.ndarray, rate: float, seed: int, squares: np.ndarray | None = None
    ):
        self.model, self.rate = model, rate
        self.noise = counts / counts.sum()
        self.log_noise = np.log(self.noise * NOISE)
        self.rng = np.random.default_rng(seed)
        if squares is None:
            squares = np.full(len(model.flat()), 1e-8)
        self.squares = [a.copy() for a in vars(model.filled(squares)).values()]

    def _step(self, k: int, array: np.ndarray, gradient: np.ndarray) -> None:
        self.squares[k] += gradient * gradient
        array -= self.rate * gradient / np.sqrt(self.squares[k])

    def batch(self, before: np.ndarray, u: np.ndarray, w: np.ndarray) -> None:
        m, n = self.model, len(w)
        drawn = self.rng.choice(len(self.noise), NOISE, p=self.noise)
        ru, rv, qw, qn = m.context[u], m.context[before], m.target[w], m.target[drawn]
        guess = ru * m.places[0] + rv * m.places[1]
        # chance that the word, or a drawn one, is no noise; its error is the gradient
        hit = _sigmoid((guess * qw).sum(axis=1) + m.bias[w] - self.log_noise[w]) - 1
        miss = _sigmoid(guess @ qn.T + m.bias[drawn] - self.log_noise[drawn])
        d_guess = hit[:, None] * qw + miss @ qn
        d_target = _summed(w, hit[:, None] * guess, len(m.bias))
        np.add.at(d_target, drawn, miss.T @ guess)
        d_bias = np.bincount(w, hit, len(m.bias))
        np.add.at(d_bias, drawn, miss.sum(axis=0))
        d_context = _summed(
            np.concatenate((u, before)),
            np.concatenate((d_guess * m.places[0], d_guess * m.places[1])),
            len(m.bias),
        )
        d_places = np.array([(d_guess * ru).sum(axis=0), (d_guess * rv).sum(axis=0)])
        gradients = (d_context, d_target, d_places, d_bias)
        for k, (array, gradient) in enumerate(zip(vars(m).values(), gradients, strict=True)):
            self._step(k, array, gradient / n)


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -30, 30)))


def _summed(rows: np.ndarray, values: np.ndarray, size: int) -> np.ndarray:
    """Values added up by row."""
    return np.stack([np.bincount(rows, column, size) for column in values.T], axis=1)


def held_out(id_: Column) -> Column:
    """Documents kept from training: crc32 of the id as text leaves 2 when divided by 7."""
    return F.coalesce(F.crc32(id_.cast("string").cast("binary")) % 7 == 2, F.lit(False))


def _words(text: pa.Scalar) -> list[bytes]:
    return (text.as_py() or b"").lower().split()


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    def rows(counts: Counter) -> pa.RecordBatch:
        arrays = [pa.array(counts.keys(), pa.binary()), pa.array(counts.values(), pa.int64())]
        return pa.RecordBatch.from_arrays(arrays, ["word", "n"])

    counts: Counter = Counter()
    for batch in batches:
        for text in batch.column(0).cast(pa.binary()):
            counts.update(_words(text))
            counts[END] += 1
            if len(counts) >= COUNTED_AT_ONCE:
                yield rows(counts)
                counts = Counter()
    if counts:
        yield rows(counts)


@dataclass
class Vocabulary:
    """Counts of the listed words, and totals over all words."""

    words: list[bytes]
    counts: np.ndarray
    tokens: int
    distinct: int

    def classes(self) -> np.ndarray:
        """The class of each listed word: the most frequent have one of their own."""
        classes = np.full(len(self.words), REST, np.int64)
        own = min(CLASSES - 2, sum(w != END for w in self.words))
        classes[:own] = np.arange(2, own + 2)
        if END in self.words:
            classes[self.words.index(END)] = EDGE
        return classes

    def class_counts(self) -> np.ndarray:
        counts = np.bincount(self.classes(), self.counts, CLASSES)
        counts[REST] = self.tokens - counts[1:].sum()
        return counts + 1  # the class of unseen words, and classes without a word

    def rest_size(self) -> float:
        """What (count + 1) is divided by within the class of all other words."""
        own = self.classes() != REST
        return self.tokens - self.counts[own].sum() + self.distinct - own.sum() + 1


def _least_listed(counts: DataFrame) -> float:
    """The least count with at most ``LISTED_WORDS`` words of as many or more.

    From the numbers of words by count, counts over 64 in steps of a 64th of a power of
    two: a few thousand rows at most, whatever the corpus.
    """
    power = F.pow(F.lit(2.0), F.greatest(F.floor(F.log2(F.col("c") + 0.5)) - 6, F.lit(0)))
    steps = counts.withColumn("step", F.floor(F.col("c") / power) * power)
    least, words = float("inf"), 0
    for row in sorted(steps.groupBy("step").count().collect(), key=lambda r: -r.step):
        words += row["count"]
        if words > LISTED_WORDS:
            break
        least = row.step
    return least


def vocabulary(texts: DataFrame) -> tuple[DataFrame, Vocabulary]:
    """Counts of every word over all texts, as a stored table; the listed ones at hand."""
    partial = texts.mapInArrow(_counted, "word binary, n long")
    counts = stored(partial.groupBy("word").agg(F.sum("n").alias("c")), "counts")
    total = counts.agg(F.sum("c").alias("c"), F.count("*").alias("n")).head()
    frequent = F.col("c") >= _least_listed(counts)
    wanted = (frequent & (F.octet_length("word") <= LISTED_BYTES)) | (F.col("word") == END)
    rows = [(bytes(r.word), r.c) for r in counts.where(wanted).collect()]
    rows.sort(key=lambda row: (row[0] == END, -row[1], row[0]))
    words, numbers = [w for w, _ in rows], np.array([c for _, c in rows], np.float64)
    return counts, Vocabulary(words, numbers, total.c or 0, total.n)


def _trained(
    batches: Iterable[pa.RecordBatch],
    vocabulary: Vocabulary,
    start: Model,
    squares: np.ndarray,
    rate: float,
    seed: int,
) -> Iterator[pa.RecordBatch]:
    """How far this task's texts move the model, with their squared gradients and tokens."""
    class_of = dict(zip(vocabulary.words, vocabulary.classes().tolist(), strict=True))
    own = {w: c for w, c in class_of.items() if c != REST}
    counts = vocabulary.class_counts()
    number = TaskContext.get().partitionId()
    trainer = Trainer(start.filled(start.flat()), counts, rate, seed + number, squares)
    held: list[np.ndarray] = []
    seen = 0

    def learn(last: bool) -> None:
        nonlocal held
        if not held:
            return
        tokens = np.concatenate(held)
        # a text is its two edges before it, its words, and the edge that ends it
        places = np.flatnonzero(_predicted(tokens))
        for at in range(0, len(places), BATCH):
            p = places[at : at + BATCH]
            trainer.batch(tokens[p - 2], tokens[p - 1], tokens[p])
        held = []

    waiting = 0
    for batch in batches:
        for text in batch.column(0).cast(pa.binary()):
            words = _words(text)
            classes = [own.get(w, REST) for w in words]
            held.append(np.array([-1, EDGE, *classes, EDGE], np.int64))
            waiting += len(words) + 1
            seen += len(words) + 1
            if waiting >= 64 * BATCH:
                learn(False)
                waiting = 0
    learn(True)
    if seen:
        moved = trainer.model.flat() - start.flat()
        added = np.concatenate([a.reshape(-1) for a in trainer.squares]) - squares
        yield _moves(number % PARTS_OF_MEANS, 1, moved, added)


def _moves(part: int, tasks: int, moved: np.ndarray, added: np.ndarray) -> pa.RecordBatch:
    arrays = [pa.array([part], pa.int64()), pa.array([tasks], pa.int64())]
    arrays += [pa.array([a.astype("<f8").tobytes()], pa.binary()) for a in (moved, added)]
    return pa.RecordBatch.from_arrays(arrays, ["part", "tasks", "moved", "added"])


def _predicted(tokens: np.ndarray) -> np.ndarray:
    """Where a token is to be predicted: not at the mark before a text or its first edge."""
    marks = tokens == -1
    predicted = ~marks
    predicted[1:] &= ~marks[:-1]
    tokens[marks] = EDGE
    return predicted


MOVES = "part long, tasks long, moved binary, added binary"


def _weight(squares: np.ndarray, added: np.ndarray) -> np.ndarray:
    """What AdaGrad divided a task's moves by, at its end."""
    return np.sqrt(squares + added)


def _sum_of_moves(batches: Iterable[pa.RecordBatch], squares: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The sums of what comes in, moves as plain gradients again; one after another."""
    moved, added, tasks = 0.0, 0.0, 0
    for batch in batches:
        for n, move, add in zip(batch.column(1).to_pylist(), *batch.columns[2:], strict=True):
            move, add = (np.frombuffer(a.as_py(), "<f8") for a in (move, add))
            moved, added, tasks = moved + move * _weight(squares, add), added + add, tasks + n
    if tasks:
        yield _moves(0, tasks, moved, added)


def _classes(text: bytes, class_of: dict[bytes, int]) -> np.ndarray:
    """A text as classes: its two edges before it, its words, and the edge that ends it."""
    words = text.lower().split()
    return np.array([EDGE, EDGE, *[class_of.get(w, REST) for w in words], EDGE], np.int64)


def _likelihood(model: Model, texts: list[np.ndarray]) -> float:
    """The sum of the normalised log probabilities of some texts' classes."""
    (near, far), log_z = model.tables()
    total = 0.0
    for c in texts:
        v, u, w = c[:-2], c[1:-1], c[2:]
        total += float((near[u, w] + far[v, w] - log_z[u, v]).sum())
    return total


def _by_round(texts: DataFrame, rounds: int) -> DataFrame:
    """Texts and the round they belong to, by hash; a folder for each, read only in its round."""
    sizes = GROWTH ** np.arange(rounds)
    ends = np.cumsum(sizes / sizes.sum())[:-1]
    place = F.pmod(F.xxhash64("text"), F.lit(1 << 20)) / float(1 << 20)
    number = sum((F.when(place >= end, 1).otherwise(0) for end in ends.tolist()), F.lit(0))
    path = new_folder(texts.sparkSession, "rounds")
    texts.withColumn("round", number).write.partitionBy("round").parquet(path)
    return texts.sparkSession.read.schema("text string, round int").parquet(path)


def train(
    texts: DataFrame, words: Vocabulary, size: int = 16, rate: float = 0.04, rounds: int = ROUNDS
) -> Model:
    """Tasks train side by side in rounds, each round from what the last one came to.

    Every text is learnt from once: a round takes, by hash, some more than the one before. At
    its end the moves of all tasks are added up as if one task had made them, each divided by
    the squared gradients of all (AdaGrad). Many long ways in the same direction lead too
    far together, so that the sum is followed all the way, half, a quarter of it and so on,
    down to one task's share, whichever makes the texts of a small sample likeliest, or not at
    all. So a model that many tasks make comes near that of one that reads everything.

    Sums are taken in 16 tasks first; the driver adds up 16 of them at most.
    """
    counts = words.class_counts()
    class_of = dict(zip(words.words, words.classes().tolist(), strict=True))
    short = texts.where(F.octet_length("text") <= STEP_BYTES)
    sample = short.orderBy(F.xxhash64("text"), "text").limit(STEP_TEXTS).collect()
    sample = [_classes(r.text.encode(), class_of) for r in sample]
    model = Model.start(counts, size, seed=0)
    squares = np.full(len(model.flat()), 1e-8)
    given = _by_round(texts, rounds)
    likely = _likelihood(model, sample)
    for number in range(rounds):
        moves = given.where(F.col("round") == number).select("text").mapInArrow(
            lambda it, at=(model, squares, rate, number << 32): _trained(it, words, *at), MOVES
        )
        sums = moves.repartition(PARTS_OF_MEANS, "part").mapInArrow(
            lambda it, at=squares: _sum_of_moves(it, at), MOVES
        )
        rows = sums.collect()
        if not rows:
            continue
        tasks = sum(r.tasks for r in rows)
        added = sum(np.frombuffer(bytes(r.added), "<f8") for r in rows)
        moved = sum(np.frombuffer(bytes(r.moved), "<f8") for r in rows) / _weight(squares, added)
        shares = [2.0**-k for k in range(max(1, tasks).bit_length())]
        tried = [model.filled(model.flat() + share * moved) for share in shares]
        likelihoods = [_likelihood(m, sample) for m in tried]
        best = int(np.argmax(likelihoods))
        if likelihoods[best] > likely or not sample:
            model, likely = tried[best], likelihoods[best]
        squares = squares + added
    return model


SCORED = (
    "word binary, doc_id long, held_out boolean, times long, n_tokens long, n_known long, "
    "base double, model double"
)


def _scored(
    batches: Iterable[pa.RecordBatch], vocabulary: Vocabulary, model: Model
) -> Iterator[pa.RecordBatch]:
    """A row for each document with what listed words add, and one for each other word.

    The word of a document's own row starts with a blank, as no word does.
    """
    place = {w: k for k, w in enumerate(vocabulary.words)}
    # listed words, then what stands for any other
    logs = np.append(np.log10(vocabulary.counts + 1), 0.0)
    classes = np.append(vocabulary.classes(), REST)
    other, end = len(vocabulary.words), place.get(END, len(vocabulary.words))
    scores, log_z = model.tables()
    size = np.log10(vocabulary.tokens + vocabulary.distinct + 1)
    rest = np.log10(vocabulary.rest_size())
    names = [f.split()[0] for f in SCORED.split(", ")]
    kinds = [pa.binary(), pa.int64(), pa.bool_(), *[pa.int64()] * 3, *[pa.float64()] * 2]
    for batch in batches:
        rows = []
        for doc, out, text in zip(
            batch.column(0).to_pylist(),
            batch.column(1).to_pylist(),
            batch.column(2).cast(pa.binary()),
            strict=True,
        ):
            words = _words(text)
            at = np.array([place.get(w, other) for w in words] + [end], np.int64)
            c = classes[at]
            if end == other:
                c[-1] = EDGE
            edged = np.concatenate(([EDGE, EDGE], c))
            v, u = edged[:-2], edged[1:-1]
            log_p = scores[0][u, c] + scores[1][v, c] - log_z[u, v]
            in_rest = c == REST
            by_model = log_p.sum() / np.log(10) + logs[at][in_rest].sum() - in_rest.sum() * rest
            known = int((at != other).sum())
            mark = b" %d" % (doc or 0)
            base = logs[at].sum() - len(at) * size
            rows.append((mark, doc, out, 0, len(at), known, base, by_model))
            unlisted = Counter(w for w, k in zip(words, at.tolist(), strict=False) if k == other)
            rows += [(w, doc, out, n, 0, 0, 0.0, 0.0) for w, n in unlisted.items()]
        columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
        arrays = [pa.array(col, k) for col, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(arrays, names)


def score(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", size: int = 16
) -> DataFrame:
    """Every document's log10 probability by the model and by word counts.

    Words are runs between blanks (space, 0x09-0x0D) with A-Z lower-cased; a text is its
    words and an end. ``held_out`` documents are scored, never learnt from. Columns:
    ``doc_id``, ``held_out``, ``n_tokens``, ``n_known`` (seen in training),
    ``train_tokens``, ``base_score`` (word counts with one added to each), ``score``
    (the log-bilinear model).

    The model predicts one of 1024 classes from the two words before, by normalised
    probabilities: frequent words, the end, and all other words together, which share
    their class's probability by count plus one, a place for unseen words included.

    NULL texts count as empty; long ones are learnt from and scored whole, each by one task.
    Rows that share an id, or have none, are one document:
    its numbers are the sums over their texts. Other columns play no part. An empty
    table gives an empty one; without texts to learn from every count is 0.

    Counts and training cover all training texts, which are written once more, parted by the
    round of training they belong to. The counts of up to 262,144 most frequent
    words, but for those of over 256 bytes, go to every task; all other words, a row per
    document, meet their counts in a join, so that nothing that grows with the corpus is
    broadcast.
    """
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).alias("text")
    )
    texts = rows.where(~held_out(F.col("doc_id"))).select("text")
    counts, words = vocabulary(texts)
    model = train(texts, words, size)
    asked = rows.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "text")
    parts = asked.mapInArrow(lambda it: _scored(it, words, model), SCORED)
    joined = parts.join(counts, "word", "left")
    unlisted = F.col("times") * F.log10(F.coalesce("c", F.lit(0)) + 1.0)
    known = F.when(F.col("c").isNotNull(), F.col("times")).otherwise(0)
    return joined.groupBy("doc_id").agg(
        F.first("held_out").alias("held_out"),
        F.sum("n_tokens").alias("n_tokens"),
        F.sum(F.col("n_known") + known).alias("n_known"),
        F.lit(words.tokens).cast("long").alias("train_tokens"),
        F.sum(F.col("base") + unlisted).alias("base_score"),
        F.sum(F.col("model") + unlisted).alias("score"),
    )
