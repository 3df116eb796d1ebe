"""Packing: every token in one place, no gaps, padding only where it is allowed."""

import random
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from orderstrata.llm import packing


def _check(lengths, length=64):
    pieces = packing.assign(lengths, length, packing.Cost())
    used, seen = {}, {}
    for document, start, size, sequence, offset in pieces:
        assert size > 0
        assert used.get(sequence, 0) == offset and seen.get(document, 0) == start
        used[sequence], seen[document] = offset + size, start + size
    assert [seen.get(k, 0) for k in range(len(lengths))] == lengths
    over = [n for n in used.values() if n != length]
    assert all(n < length and n & (n - 1) == 0 for n in over) and len(set(over)) == len(over)
    return pieces


def test_assign():
    rng = random.Random(0)
    _check([])
    _check([1])
    _check([64, 64, 1])
    _check([1000])
    for _ in range(50):
        _check([rng.choice([1, 3, 64, 65, 200, rng.randint(1, 90)]) for _ in range(rng.randint(1, 80))])


def test_costs_are_balanced():
    """Long pieces are spread over sequences before short ones fill them."""
    pieces = _check([40] * 8 + [24] * 8)
    cost = packing.Cost()
    totals = {}
    for _, _, size, sequence, _ in pieces:
        totals[sequence] = totals.get(sequence, 0) + cost.of(size)
    assert max(totals.values()) - min(totals.values()) < 1e-9


def test_very_long_runs():
    path = public_tokenizers.path
    tokenizer = path("byte_bpe_50k.json")
    ids = packing.Ids(path("byte_bpe_50k.tiktoken"), tokenizer, 50256, 1)
    whole = Tokenizer.from_file(tokenizer)
    for piece in (" ", "\n", "x", "7", "!?", "<|endoftext|>"):
        for size in (packing.LONGEST_TEXT, 1_048_000):
            text = piece * (size // len(piece))
            expected = whole.encode(text, add_special_tokens=False).ids
            assert ids.of(text).tolist() == [*expected, 1]


def test_documents(spark):
    rng = random.Random(5)
    words = ["tree", "Haus", "été", "  ", "\n", "123", "<|endoftext|>", "'ll", "!?", "𝄞", "‍"]
    texts = [" ".join(rng.choice(words) for _ in range(rng.randint(0, 900))) for _ in range(40)]
    rows = [(k, t) for k, t in enumerate(texts)] + [(50, None), (51, ""), (None, "x"), (0, "y")]
    rows.append((60, "ab " * 400_000))
    docs = spark.createDataFrame([(*r, 1) for r in rows], "doc_id long, text string, length int")
    found = packing.pack(docs.coalesce(2)).collect()
    whole = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    given = {}
    for doc, text in rows:
        given.setdefault(doc, []).append([*whole.encode(text or "", add_special_tokens=False).ids, 1])
    sequences, taken = {}, {}
    for r in found:
        ids = np.frombuffer(r.ids, "<u4").tolist()
        assert r.length == len(ids) and r.ids_crc32 == zlib.crc32(bytes(r.ids))
        sequences.setdefault(r.sequence_id, []).append((r.offset, r.length))
        taken.setdefault((r.doc_id, r.doc_tokens), []).append((r.start, ids))
    for parts in sequences.values():
        at = 0
        for offset, size in sorted(parts):
            assert offset == at
            at += size
        assert at == 2048 or (at < 2048 and at & (at - 1) == 0)
    got = {}
    for (doc, tokens), parts in taken.items():
        joined = [i for _, ids in sorted(parts) for i in ids]
        assert len(joined) == tokens
        got.setdefault(doc, []).append(joined)
    assert {d: sorted(v) for d, v in got.items()} == {d: sorted(v) for d, v in given.items()}
    none = spark.createDataFrame([], "doc_id long, text string")
    assert packing.pack(none).collect() == []
    assert packing.pack(docs, with_ids=False).where("ids IS NOT NULL").count() == 0
