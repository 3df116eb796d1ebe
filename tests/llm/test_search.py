"""Ranked search against scores of every document."""

import math
import random
import re
from collections import Counter

import pytest

from orderstrata.llm import search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")
ASCII_LOWER = {c: c + 32 for c in range(65, 91)}


def _terms(text):
    return TERM.findall((text or "").translate(ASCII_LOWER))


def _brute(docs, items, k=10):
    """(item, rank, doc, score) for each item row."""
    counts = [(doc_id, Counter(_terms(text))) for doc_id, text in docs if _terms(text)]
    n, total = len(counts), sum(sum(c.values()) for _, c in counts)
    held = Counter(t for _, c in counts for t in c)
    rows = []
    for item_id, text in items:
        scores = []
        for doc_id, c in counts:
            m = 100 - 90 + (90 * sum(c.values()) * n) // total
            score = 0
            for term in set(_terms(text)) & set(c):
                weight = math.floor(1000 * math.log((2 * n + 2) / (2 * held[term] + 1)))
                score += weight * ((1000000000 * c[term]) // (1000 * c[term] + 8 * m))
            if score > 0:
                scores.append((-score, doc_id is None, doc_id or 0))
        for rank, (score, none, doc_id) in enumerate(sorted(scores)[:k], 1):
            rows.append((item_id, rank, None if none else doc_id, -score))
    return sorted(rows, key=repr)


def _texts(seed):
    """Terms from very common to rare, so that items have short and long lists."""
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(300)] + ["Été", "ÉTÉ", "straße", "a\u0085b", "X1"]
    shares = [1 / (1 + k) for k in range(len(words))]
    docs = [
        (k, rng.choice([" ", ", ", "\n"]).join(rng.choices(words, shares, k=rng.randint(0, 60))))
        for k in range(400)
    ]
    docs += [(500 + k, docs[7][1]) for k in range(30)]  # more ties than places
    docs += [(7, docs[7][1]), (None, docs[7][1]), (None, docs[9][1]), (600, None), (601, "")]
    docs += [(602, "..."), (603, " ".join(rng.choices(words, k=20_000)))]
    rng.shuffle(docs)
    items = [(k, " ".join(rng.choices(words, k=rng.randint(1, 12)))) for k in range(40)]
    items += [(50, docs[3][1]), (51, ""), (52, None), (53, "nowhere"), (None, "w1 w250")]
    items += [(54, "w3 W3 w200 w3"), (55, dict(docs)[7]), (0, items[0][1]), (0, "w17")]
    return docs, items


@pytest.mark.parametrize("small", [False, True])
def test_against_all_scores(spark, small, monkeypatch):
    if small:  # many blocks, steps and passes
        monkeypatch.setattr(search, "BLOCK_DOCS", 50)
        monkeypatch.setattr(search, "STEP", 8)
        monkeypatch.setattr(search, "PASS_BYTES", 600)
    docs, items = _texts(3)
    table = spark.createDataFrame([(*d, 0, "x") for d in docs], "doc_id long, text string, score int, rank string")
    listed = spark.createDataFrame([(*i, 1) for i in items], "item_id long, text string, doc_id int")
    found = [tuple(r) for r in search.ranked(table.repartition(3), listed).collect()]
    assert sorted(found, key=repr) == _brute(docs, items) and found


def test_what_cannot_get_in_is_not_looked_at(monkeypatch):
    """The step of the common list is skipped once rarer terms have filled the places."""
    docs = [(k, f"common filler{k}" + (" rare" if k < 20 else "")) for k in range(4000)]
    known = {b"common": 0, b"rare": 1}
    weights = search.np.array([1, 8000])
    found = [search.np.array([0, 1] if k < 20 else [0]) for k in range(len(docs))]
    block = search._Block([d for d, _ in docs], found, [100] * len(docs), weights)
    best, offered = search._Best(10), []
    monkeypatch.setattr(search, "STEP", 100)
    offer = best.offer
    best.offer = lambda score, doc: (offered.append(doc), offer(score, doc))
    block.search([known[b"common"], known[b"rare"]], best)
    assert max(offered) < 100 and sorted(d for d, _ in best.rows()) == list(range(10))


def test_nothing_to_rank(spark):
    docs = spark.createDataFrame([(1, "a b"), (2, None)], "doc_id long, text string")
    items = spark.createDataFrame([(1, "a"), (2, "?")], "item_id long, text string")
    assert [tuple(r)[:3] for r in search.ranked(docs, items).collect()] == [(1, 1, 1)]
    assert search.ranked(docs.limit(0), items).collect() == []
    assert search.ranked(docs, items.limit(0)).collect() == []
    assert search.ranked(docs.where("text IS NULL"), items).collect() == []
