"""Texts of some megabytes through the operators, beside short ones."""

import hashlib
import random

import pytest

from orderstrata.llm import chat, language_model, licenses, quality, repeats, simhash

WORDS = 400_000


@pytest.fixture(scope="module")
def long():
    rng = random.Random(12)
    return " ".join(f"word{rng.randrange(50_000)}" for _ in range(WORDS))


def docs_of(spark, *texts):
    return spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(2)


def test_conversation(spark, long):
    turns = spark.createDataFrame(
        [(1, 0, "user", long), (1, 1, "assistant", f"{long}<|im_end|>")],
        "conv_id long, turn long, role string, text string",
    )
    (row,) = chat.conversation_digests(turns).collect()
    assert row.loss_chars == len(long) + len("<|im_end|>")
    assert row.loss_sha256 == hashlib.sha256(f"{long}<|im_end|>".encode()).hexdigest()


def test_repeats(spark, long):
    found = {
        r.doc_id: r
        for r in repeats.mark_repeats(docs_of(spark, long, f"before {long[1000:]}", "short")).collect()
    }
    assert not found[0].repeats and bytes(found[0].kept) == long.encode()
    ((start, end),) = found[1].repeats
    assert end == len("before ") + len(long) - 1000 and start <= len("before ")


def test_near_duplicates(spark, long):
    changed = long.replace(" ", "  ", 1).upper()
    found = {r.doc_id: r for r in simhash.near_duplicates(docs_of(spark, long, changed, "x y z")).collect()}
    assert found[0].fingerprint == found[1].fingerprint and found[1].component_id == 0
    assert found[2].component_id == 2


def test_licence_at_the_end(spark, long):
    key, text = licenses.TEMPLATES[0]
    (row,) = licenses.scan(docs_of(spark, f"{long} {text}", long)).collect()
    assert (row.doc_id, row.license_id) == (0, key) and row.first_word == WORDS


def test_judged(spark, long):
    labels = spark.createDataFrame([(0, 1, 0), (1, 0, 0)], "doc_id long, quality int, toxic int")
    docs = docs_of(spark, long, "short").selectExpr("*", "'s' AS source", "'en' AS lang")
    assert quality.judge(docs, labels).count() == 2


def test_scored(spark, long):
    found = {r.doc_id: r for r in language_model.score(docs_of(spark, long, "short")).collect()}
    assert found[0].n_tokens == WORDS + 1 and found[1].n_tokens == 2
