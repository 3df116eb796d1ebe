"""Repeated passages against a brute-force search of all strings."""

import random

import pytest

from orderstrata.llm import repeats


def _brute(texts, window=50):
    first = {}
    for i, text in sorted(texts, key=lambda t: t[0]):
        for p in range(len(text) - window + 1):
            first.setdefault(text[p : p + window], i)
    out = []
    for i, text in texts:
        gone = bytearray(len(text))
        for p in range(len(text) - window + 1):
            if first[text[p : p + window]] < i:
                gone[p : p + window] = b"\1" * window
        spans, at = [], None
        for k in range(len(text) + 1):
            cut = k < len(text) and gone[k]
            if cut and at is None:
                at = k
            elif not cut and at is not None:
                spans.append((at, k))
                at = None
        out.append((i, spans, bytes(c for c, g in zip(text, gone, strict=True) if not g)))
    return out


def _passages():
    rng = random.Random(3)

    def word():
        return "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))

    pool = [" ".join(word() for _ in range(rng.randint(4, 40))) for _ in range(12)]
    texts = []
    for k in range(60):
        parts = [rng.choice(pool) if rng.random() < 0.5 else " ".join(word() for _ in range(20))
                 for _ in range(rng.randint(0, 6))]
        texts.append((k, " ".join(parts)))
    texts += [(100, "Ed " * 300), (101, "x" * 49), (102, "x" * 50), (103, "x" * 400)]
    texts += [(99, "x" * 51), (104, texts[3][1]), (105, "Ed " * 17 + "Ef " * 60), (106, "")]
    texts += [(107, "a" * 49 + "b"), (108, "b" + "a" * 49), (109, "a" * 99)]
    rng.shuffle(texts)
    return texts


@pytest.mark.parametrize("pieces", [1 << 20, 3000])
@pytest.mark.parametrize("hot", [repeats.HOT_PLACES, (2, 1 << 30), (2, 2), (1, 8)])
def test_same_as_brute_force(spark, pieces, hot, monkeypatch):
    # the workers take the module's own sizes; what is small here is what the driver sends
    monkeypatch.setattr(repeats, "BUCKET_BYTES", pieces)
    monkeypatch.setattr(repeats, "HOT_PLACES", hot)
    texts = _passages()
    docs = spark.createDataFrame([(t, i) for i, t in texts], "text string, doc_id long")
    rows = repeats.mark_repeats(docs.repartition(5)).collect()
    found = {r.doc_id: ([(s.start, s.end) for s in r.repeats], bytes(r.kept)) for r in rows}
    wanted = {i: (spans, kept) for i, spans, kept in _brute([(i, t.encode()) for i, t in texts])}
    assert found == wanted
    assert any(spans for spans, _ in wanted.values())


def test_long_texts_are_looked_at_in_parts():
    rng = random.Random(1)
    text = bytes(rng.choice(b"abc ") for _ in range(5000))
    import numpy as np

    data, ends = np.frombuffer(text, np.uint8), np.array([1200, 1200, 5000])
    whole = repeats._all_anchors(data, ends, 50)

    def windows(parts):
        return {
            (place, w) for _, place, a, b in zip(*parts, strict=True) for w in range(a, b + 1)
        }

    size = repeats.WINDOWS_AT_ONCE
    try:
        repeats.WINDOWS_AT_ONCE = 333
        parts = repeats._all_anchors(data, ends, 50)
    finally:
        repeats.WINDOWS_AT_ONCE = size
    assert windows(whole) == windows(parts)
    covered = {w for _, w in windows(whole)}
    assert covered == {*range(1200 - 49), *range(1200, 5000 - 49)}


def test_a_batch_sends_each_context_once_however_it_is_chunked(monkeypatch):
    import numpy as np
    import pyarrow as pa

    passage = "".join(random.Random(5).choices("abcdefgh ", k=300))
    texts = [t for _, t in _passages()] + [passage] * 400
    rows = pa.record_batch([pa.array(range(len(texts))), pa.array(texts)], ["id", "text"])
    found = repeats._found(rows, 0, 1, 50)
    buckets = 37
    marks = {
        bucket: np.packbits(np.ones(b - a, bool)).tobytes()
        for bucket, a, b in repeats._parts(found.hashes[found.starts], buckets)
    }

    def contexts(at_once):
        monkeypatch.setattr(repeats, "ANCHORS_AT_ONCE", at_once)
        out, anchors = {}, 0
        for listed, cuts, sent, least, at, which in repeats._shared_contexts(
            found, marks, 50, buckets
        ):
            assert (least[which] <= found.ids[at]).all()
            anchors += len(at)
            for k, bucket in enumerate(listed):
                cut = slice(cuts[k], cuts[k + 1])
                out[bucket] = (sent[cut].tobytes(), least[cut].tolist())
        assert anchors == len(found.hashes)
        return out

    whole = contexts(1 << 16)
    assert contexts(50) == whole == contexts(1)
    assert sum(len(ids) for _, ids in whole.values()) < len(found.hashes) / 3


@pytest.mark.parametrize("width", [1, 7, 8, 9, 16, 34, 50, 100])
def test_pointers_sort_suffixes(width):
    import numpy as np

    rng = random.Random(width)
    texts = [bytes(rng.choices(b"ab\x00\xff", k=width)) for _ in range(300)]
    for _ in range(300):  # long common prefixes, and copies
        text = bytearray(rng.choice(texts))
        if rng.random() < 0.7:
            text[rng.randrange(width)] = rng.choice(b"ab")
        texts.append(bytes(text))
    suffixes = np.frombuffer(b"".join(texts), np.uint8).reshape(-1, width)
    buckets = np.array([rng.randrange(3) for _ in texts])
    order, common = repeats._sorted_suffixes(buckets, suffixes)
    rows = [(int(buckets[k]), texts[k]) for k in order]
    assert rows == sorted(rows)
    for (b, one), (c, two), prefix in zip(rows, rows[1:], common[1:].tolist(), strict=False):
        shared = next((k for k in range(width) if one[k] != two[k]), width)
        assert prefix == (shared if b == c else -1)
    assert common[0] == -1
    none = repeats._sorted_suffixes(buckets[:0], suffixes[:0])
    assert len(none[0]) == 0


def test_one_phrase_in_very_many_surroundings(spark, monkeypatch):
    """A phrase shorter than a window at 100,000 places: what is sent for it goes to many groups."""
    rng = random.Random(6)
    phrase = "a phrase that these texts hold"
    texts = [
        f"{rng.randrange(10**12)} {rng.randrange(10**12)} {phrase} {rng.randrange(10**12)} {k}"
        for k in range(100_000)
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(8)
    sizes = []
    refine = repeats._batches_with_ranges

    def watched(*args):
        found, cover = refine(*args)
        sizes.append(found)
        return found, cover

    monkeypatch.setattr(repeats, "_batches_with_ranges", watched)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 1 << 17)
    marked = repeats.mark_repeats(docs)
    assert marked.where("size(repeats) > 0").isEmpty()
    replies = sizes[0].selectExpr("explode(replies) AS r").selectExpr("r.bucket", "length(r.blob) AS n")
    by_bucket = [r.n for r in replies.groupBy("bucket").sum("n").toDF("bucket", "n").collect()]
    assert len(by_bucket) > 5 and max(by_bucket) < 0.5 * sum(by_bucket)


def test_odd_rows_and_names(spark):
    passage = "A passage of more than fifty bytes, which several rows hold: é."
    rows = [(1, None, 0), (None, passage, 1), (2, passage, 2), (2, passage, 3), (3, "", 4),
            (None, passage, 5)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `ranges.c0` int")
    found = repeats.mark_repeats(docs)
    assert found.columns == ["doc_id", "text", "ranges.c0", "repeats", "kept"]
    kept = {r[2]: r.kept for r in found.collect()}
    assert {k: None if v is None else bytes(v) for k, v in kept.items()} == {
        0: None, 1: b"", 2: passage.encode(), 3: passage.encode(), 4: b"", 5: b"",
    }
    cut = repeats.without_repeats(docs)
    assert cut.schema == docs.schema and cut.count() == 6
    with pytest.raises(ValueError, match="column"):
        repeats.mark_repeats(docs.withColumnRenamed("ranges.c0", "Kept"))
    with pytest.raises(ValueError, match="window"):
        repeats.mark_repeats(docs, window=20)
    empty = spark.createDataFrame([], "doc_id long, text string")
    assert repeats.mark_repeats(empty).collect() == []


def test_cut_text_has_whole_characters(spark):
    shared = "z" * 60
    # the same passage after bytes that end alike: é and ã have the second byte in common
    docs = spark.createDataFrame(
        [(1, "é" + shared), (2, "ĩ" + shared)], "doc_id long, text string"
    )
    assert "é".encode()[-1] == "ĩ".encode()[-1]
    found = {r.doc_id: r.text for r in repeats.without_repeats(docs).collect()}
    assert found == {1: "é" + shared, 2: ""}
