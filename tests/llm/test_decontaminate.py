"""Benchmark items and licences in documents, against all shingles of everything."""

import random

import pytest
import regex

from orderstrata.llm import decontaminate, licenses


def _words(text):
    return regex.sub(r"[^\p{L}\p{N}]+", " ", (text or "").lower()).split()


def _shingles(words, width=5):
    n = min(width, len(words))
    return {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if words else set()


def _brute(docs, items):
    found = set()
    for doc, text in docs:
        words = _words(text)
        for item, item_text in items:
            wanted = _shingles(_words(item_text))
            width = len(next(iter(wanted))) if wanted else 1
            held = {tuple(words[k : k + width]) for k in range(len(words) - width + 1)}
            shared = len(wanted & held)
            if wanted and shared >= 0.8 * len(wanted) - 1e-9:
                found.add((doc, item, len(wanted), shared))
    return found


def _texts(seed):
    rng = random.Random(seed)
    words = [f"w{k}" for k in range(40)] + ["Été", "straße", "été"]
    items = [(k, " ".join(rng.choice(words) for _ in range(rng.choice([2, 4, 5, 6, 9, 30, 64]))))
             for k in range(60)]
    items += [(60, ""), (61, None), (62, "..."), (5, "Same id, other text!"), (70, items[0][1])]
    docs = []
    for k in range(80):
        text = [rng.choice(words) for _ in range(rng.randint(0, 120))]
        for _ in range(rng.randint(0, 2)):
            piece = _words(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 1, 2])):
                if piece:
                    piece[rng.randrange(len(piece))] = "changed"
            at = rng.randint(0, len(text))
            text[at:at] = piece
        docs.append((k, ", ".join(text)))
    docs += [(200, None), (201, ""), (None, items[3][1]), (3, items[8][1])]
    return docs, items


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("pass_bytes", [1 << 22, 2000])
def test_leaks(spark, seed, pass_bytes, monkeypatch):
    monkeypatch.setattr(decontaminate, "PASS_BYTES", pass_bytes)
    docs, items = _texts(seed)
    table = spark.createDataFrame([(*d, 0) for d in docs], "doc_id long, text string, item_id int")
    listed = spark.createDataFrame(items, "item_id long, text string")
    rows = decontaminate.leaks(table, listed).collect()
    found = {(r.doc_id, r.item_id, r.item_shingles, r.shared) for r in rows}
    assert found == _brute(docs, items) and found
    assert all(r.containment == r.shared / r.item_shingles for r in rows)


def test_long_documents_are_looked_at_in_parts(monkeypatch):
    monkeypatch.setattr(decontaminate, "WORDS_AT_ONCE", 7)
    docs, items = _texts(4)
    index = decontaminate.Index([(k, " ".join(_words(t))) for k, t in items], 5, 0.8)
    found = {(d, *hit) for d, text in docs for hit in index.found(" ".join(_words(text)))}
    assert found == _brute(docs, items)


def test_nothing_to_find(spark):
    docs = spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")
    none = spark.createDataFrame([], "item_id long, text string")
    assert decontaminate.leaks(docs, none).collect() == []
    some = spark.createDataFrame([(1, "a b c d e f")], none.schema)
    assert decontaminate.leaks(docs.limit(0), some).collect() == []
    assert decontaminate.leaks(docs, some).count() == 1


def test_licenses(spark):
    """Copies whole, changed, in two halves far apart, and next to one another."""
    rng = random.Random(9)
    texts = dict(licenses.TEMPLATES)
    docs = []
    for k, (_, text) in enumerate(licenses.TEMPLATES):
        words = text.split()
        changed = words[:-1] + ["otherwise"]
        half = len(words) // 2 + 2
        filler = " ".join(f"x{rng.randrange(50)}" for _ in range(500))
        docs += [(10 * k, f"{filler} {text.upper()} {filler}"), (10 * k + 1, " ".join(changed))]
        docs.append((10 * k + 2, f"{' '.join(words[:half])} {filler} {' '.join(words[half - 4 :])}"))
        docs.append((10 * k + 3, filler))
    docs += [(900, " ".join(texts.values())), (901, None), (902, "too short"), (None, texts["mit-notice"])]
    docs.append((10, docs[4][1]))
    table = spark.createDataFrame(
        [(*d, "s") for d in docs], "doc_id long, text string, license_id string"
    )
    rows = licenses.scan(table).collect()
    found = {(r.doc_id, r.license_id, r.template_shingles, r.shared) for r in rows}
    assert found == _brute(docs, licenses.TEMPLATES) and len(rows) == len(found)
    assert {r.first_word for r in rows if r.doc_id == 0} == {500}
    assert licenses.scan(table.limit(0)).collect() == []
    with pytest.raises(ValueError, match="too short"):
        licenses.scan(table, templates=(("a", "few words"),))
    plan = licenses.scan(table)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan


def test_many_templates_are_joined_without_the_documents_words(spark, monkeypatch):
    rng = random.Random(1)
    rows = [(k, " ".join([f"x{rng.randrange(60)}" for _ in range(80)] + t.split())) for k, (_, t) in enumerate(licenses.TEMPLATES)]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    kept = licenses.stored
    plans = []

    def watched(df, name):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        return kept(df, name)

    monkeypatch.setattr(licenses, "stored", watched)
    few = sorted(tuple(r) for r in licenses.scan(table).collect())
    monkeypatch.setattr(licenses, "BROADCAST_BYTES", 0)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        many = sorted(tuple(r) for r in licenses.scan(table).collect())
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert many == few and len(few) >= len(rows)
    lines = plans[1].splitlines()
    below = [lines[k + 1] for k, line in enumerate(lines) if "Exchange hashpartitioning(hash" in line]
    assert below and not any("words#" in line.split("AS run")[0] and "AS run" not in line for line in below)
