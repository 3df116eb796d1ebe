"""SimHash near duplicates against brute force."""

import random

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from orderstrata.llm import simhash
from orderstrata.llm.components import component_roots


def _print(text, n=3):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    runs = [b" ".join(words[k : k + n]) for k in range(max(1, len(words) - n + 1))]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def _components(prints, distance):
    """Smallest id reachable, from a list of (id, print)."""
    parent = {i: i for i, _ in prints}

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for k, (i, a) in enumerate(prints):
        for j, b in prints[k + 1 :]:
            if (a ^ b).bit_count() <= distance:
                x, y = sorted((top(i), top(j)))
                parent[y] = x
    return {i: top(i) for i, _ in prints}


TEXTS = [
    (5, "One two three four five six"),
    (2, "one TWO three\tfour five six"),
    (9, "quite another text of some words"),
    (7, ""),
    (1, None),
    (4, "two words"),
    (3, " \n "),
    (9, "quite another text of some words"),
    (11, "É é " * 400),
    (12, "  no-break space is no blank"),
]


def test_documents(spark):
    docs = spark.createDataFrame(
        [(i, t, "x", 0) for i, t in TEXTS],
        "doc_id long, text string, component_id string, print int",
    )
    found = simhash.near_duplicates(docs)
    assert found.columns == ["doc_id", "fingerprint", "component_id"]
    wanted = _components(sorted({(i, _print(t)) for i, t in TEXTS}), 2)
    rows = sorted((r.doc_id, r.fingerprint, r.component_id) for r in found.collect())
    assert rows == sorted((i, f"{_print(t):016x}", wanted[i]) for i, t in TEXTS)


def test_no_rows_and_no_ids(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert simhash.near_duplicates(docs).collect() == []
    docs = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (None, "d"), (3, "d")],
                                 "doc_id long, text string")
    rows = [(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs).collect()]
    assert sorted(rows, key=repr) == sorted([(None, None), (None, None), (None, 3), (3, 3)], key=repr)


@pytest.mark.parametrize("distance", [1, 2])
def test_row_without_id_links_others(spark, distance, monkeypatch):
    """A chain of prints so far apart, every other one of a row without an id."""
    bits = [0, (1 << distance) - 1, (1 << 2 * distance) - 1, (1 << 3 * distance) - 1, 15 << 60]
    rows = list(zip([8, None, 5, None, 4], bits, strict=True)) + [(None, 15 << 40)]
    signed = [(i, int(np.uint64(p).astype(np.int64))) for i, p in rows]
    prints = spark.createDataFrame(signed, "doc_id long, print long")
    monkeypatch.setattr(simhash, "fingerprints", lambda *_: prints)
    found = simhash.near_duplicates(prints, distance=distance)
    got = sorted((r.fingerprint, r.doc_id, r.component_id) for r in found.collect())
    near = {p: 5 for p in bits[:4]} | {15 << 60: 4, 15 << 40: None}
    assert got == sorted((f"{p:016x}", i, near[p]) for i, p in rows)


@pytest.mark.parametrize("distance,compared", [(1, 2), (2, 2), (2, 64), (3, 2)])
def test_links_lose_no_pair(spark, distance, compared, monkeypatch):
    """Crowded keys and others give the same components as all pairs."""
    monkeypatch.setattr(simhash, "COMPARED_AT_MOST", compared)
    rng = random.Random(distance)
    prints = set()
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            value = centre
            for bit in rng.sample(range(64), rng.randint(0, 4)):
                value ^= 1 << bit
            prints.add(value)
    prints = list(enumerate(sorted(prints)))
    signed = [(k, int(np.uint64(p).astype(np.int64))) for k, p in prints]
    classes = spark.createDataFrame(signed, "id long, print long")
    links = simhash.links(classes, distance)
    by_id = dict(prints)
    pairs = [(r.a, r.b) for r in links.collect()]
    assert all((by_id[a] ^ by_id[b]).bit_count() <= distance for a, b in pairs)
    everyone = classes.select(F.col("id").alias("node"))
    roots = {r.node: r.root for r in component_roots(links).collect()}
    found = {r.node: roots.get(r.node, r.node) for r in everyone.collect()}
    assert found == _components(prints, distance)


def test_components_of_chain_star_and_loops(spark):
    chain = [(k, k + 1) for k in range(100, 140)]
    star = [(7, k) for k in range(8, 60)]
    odd = [(3, 3), (None, 4), (200, 199), (200, 199), (-5, 200)]
    links = spark.createDataFrame(chain + star + odd, "a long, b long")
    roots = {r.node: r.root for r in component_roots(links).collect()}
    wanted = {k: 100 for k in range(101, 141)} | {k: 7 for k in range(8, 60)} | {200: -5, 199: -5}
    assert roots == wanted
    none = spark.createDataFrame([], "a long, b long")
    assert component_roots(none).collect() == []
