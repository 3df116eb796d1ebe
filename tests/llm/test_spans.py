"""Repeated runs of words against a dictionary of all runs."""

import random
import re
from collections import Counter

import pytest

from orderstrata.llm import spans
from orderstrata.llm.batches import store_batches
from orderstrata.llm.common import plainly_named


def _words(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def _brute(texts, window):
    """For each text its words, and those that stay."""
    docs = [_words(t) for t in texts]
    runs = Counter(
        tuple(w[k : k + window]) for w in docs for k in range(len(w) - window + 1)
    )
    out = []
    for words in docs:
        gone = set()
        for k in range(len(words) - window + 1):
            if runs[tuple(words[k : k + window])] > 1:
                gone.update(range(k, k + window))
        out.append((len(words), len(gone), " ".join(w for k, w in enumerate(words) if k not in gone)))
    return out


def _texts(seed, window):
    """Passages in differing surroundings, near and exact copies, runs within one text."""
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(2000)] + ["é x", " ", "a\x1cb", "-"]

    def some(n):
        return [rng.choice(vocabulary) for _ in range(n)]

    passages = [some(rng.choice([window - 1, window, window + 1, 3 * window])) for _ in range(6)]
    texts = []
    for _ in range(60):
        words = some(rng.randint(0, 30))
        for _ in range(rng.randint(0, 3)):
            piece = list(rng.choice(passages))
            if rng.random() < 0.3:
                piece[rng.randrange(len(piece))] = "changed"
            words += piece[rng.choice([0, 0, 1, 5]) :] + some(rng.randint(0, 9))
        texts.append(rng.choice([" ", "\n", " \t\x0b\x0c\r "]).join(words))
    base = some(4 * window)
    for _ in range(20):  # near copies
        copy = list(base)
        copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
        texts.append(" ".join(copy))
    texts += [" ".join(base)] * 3 + [" ".join(["same"] * 3 * window), " ".join(["same"] * window)]
    texts += [" ".join(["x", "y"] * window), None, "", " \n", "word", " ".join(some(30_000) + passages[0])]
    texts += ["z" * 300_000 + " " + " ".join(passages[3])]
    return texts


def _found(df):
    return [(r.place, (r.n_words, r.n_removed, r.kept)) for r in df.sort("place").collect()]


@pytest.mark.parametrize(("seed", "window"), [(1, 35), (2, 9), (3, 12)])
def test_against_all_runs(spark, seed, window):
    texts = _texts(seed, window)
    rows = [(k, k % 7 or None, t) for k, t in enumerate(texts)]
    table = spark.createDataFrame(rows, "place long, doc_id long, text string").repartition(5)
    found = _found(spans.mark_repeated_spans(table, window=window))
    expected = _brute(texts, window)
    assert [f for _, f in found] == expected
    assert any(n for _, n, _ in expected)


def test_many_differing_surroundings(spark):
    """One passage of just a run, at 3,000 places; only its own run is there twice."""
    rng = random.Random(4)
    passage = [f"p{k}" for k in range(35)]
    texts = [
        " ".join([f"a{rng.random()}" for _ in range(12)] + passage + [f"b{rng.random()}" for _ in range(12)])
        for _ in range(3000)
    ]
    table = spark.createDataFrame(list(enumerate(texts)), "place long, text string").repartition(7)
    found = _found(spans.mark_repeated_spans(table))
    assert [f for _, f in found] == _brute(texts, 35)
    assert {n for _, (_, n, _) in found} == {35}


def test_other_columns_and_empty_tables(spark):
    text = " ".join(f"w{k}" for k in range(40))
    rows = [(1, text, 5, "x", b"r", 3), (1, text, 6, "y", None, 4)]
    columns = "n_words int, text string, `kept.it` int, kept string, rows binary, Batch_ID int"
    table = spark.createDataFrame(rows, columns)
    marked = spans.mark_repeated_spans(table)
    assert marked.columns == [*table.columns, "_n_words", "n_removed", "_kept"]
    assert sorted(tuple(r) for r in marked.collect()) == [
        (*rows[0], 40, 40, ""),
        (*rows[1], 40, 40, ""),
    ]
    assert spans.mark_repeated_spans(table.limit(0)).collect() == []
    with pytest.raises(ValueError, match="window"):
        spans.mark_repeated_spans(table, window=8)


def test_differing_words_under_equal_hashes_are_noticed(spark, monkeypatch):
    """A span whose source has other words fails; then all is done again with other hashes."""
    texts = [" ".join(f"{c}{k}" for k in range(200)) for c in "ab"] * 2
    table = spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)
    batches = store_batches(plainly_named(table), 0)
    batch = batches.head().batch_id
    schema = "batch_id long, start long, n long, from_batch long, from_start long"
    right = spark.createDataFrame([(batch, 400, 150, batch, 0), (batch, 630, 3, batch, 230)], schema)
    wrong = spark.createDataFrame([(batch, 400, 150, batch, 0), (batch, 630, 3, batch, 231)], schema)
    assert spans._all_equal(batches, right, 0, 35)
    assert not spans._all_equal(batches, wrong, 0, 35)

    used = []
    paths = spans._repeated_paths
    monkeypatch.setattr(
        spans, "_repeated_paths", lambda b, t, w, seed: used.append(seed) or paths(b, t, w, seed)
    )
    monkeypatch.setattr(spans, "_all_equal", lambda *a: len(used) > 1)
    marked = spans.mark_repeated_spans(table)
    assert used == list(spans.SEEDS[:2])
    assert [r.n_removed for r in marked.collect()] == [200] * 4
