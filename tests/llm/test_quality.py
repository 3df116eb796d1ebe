"""The quality classifier: sites against a plain computation, labels held out, odd rows."""

import math
import random

import numpy as np
import pytest

from orderstrata.llm import quality

SF_DIR = "/root/testdata/sf0.1"


def test_held_out_labels(spark):
    """Learns from half of the labels; the other half says how well."""
    docs = spark.read.parquet(f"{SF_DIR}/documents.parquet")
    labels = spark.read.parquet(f"{SF_DIR}/labels.parquet")
    half = labels.where("doc_id % 2 = 0")
    judged = quality.judge(docs, half).select("doc_id", "keep")
    rest = labels.where("doc_id % 2 = 1").join(judged, "doc_id").collect()
    clean = [r.keep for r in rest if r.quality == 1 and r.toxic == 0]
    poor = [r.keep for r in rest if r.quality == 0]
    toxic = [r.keep for r in rest if r.toxic == 1]
    assert len(clean) > 1000 and np.mean(clean) > 0.99
    assert np.mean(poor) < 0.05
    assert np.mean(toxic) < 0.1


def test_parts_of_words(monkeypatch):
    """Runs of five bytes with at most the first and the last outside of the word, however cut."""
    text = b"Worte w\xc3\xb6rtlich, a b abcde" * 3

    def plain(words):
        runs = set()
        for word in words:
            spaced = b" " + word + b" "
            runs |= {spaced[k : k + 5] for k in range(len(spaced) - 4)}
        return {int.from_bytes(r) * 0x9E3779B97F4A7C15 % (1 << 64) >> 40 for r in runs}

    words = quality._WORD.findall(text.lower())
    for size in (1 << 20, 7, 1):
        monkeypatch.setattr(quality, "BYTES_AT_ONCE", size)
        assert set(quality._parts(words).tolist()) == plain(words)
    assert len(quality._parts([])) == len(quality._parts([b"a"])) == 0


def _logit(p):
    return math.log(p / (1 - p))


def test_sites_against_plain_sums(spark):
    rng = random.Random(2)
    rows = []
    for host in ("a", "b", None):
        for path in ("x", "y", None):
            share = rng.random()
            for _ in range(rng.choice([1, 3, 80])):
                good = min(max(rng.gauss(share, 0.2), 0.01), 0.99)
                rows.append((len(rows), host, path, good, 0.1, good * 0.9))
    schema = "doc_id long, host string, path string, good double, toxic double, fine double"
    found = quality._with_sites(spark.createDataFrame(rows, schema), 0.5).collect()

    def worth(groups):
        total = sum(n for n, _, _ in groups)
        chance = sum(m * (1 - m) for _, _, m in groups)
        spread = sum(n * (s / n - m) ** 2 for n, s, m in groups) - chance
        between = max(spread / total, 1e-9)
        inner = sum(n * m * (1 - m) for n, _, m in groups) / total / between - 1
        return min(max(inner, 1.0), 1e6)

    hosts, sites = {}, {}
    for _, host, path, _, _, fine in rows:
        for key, sums in ((host, hosts), ((host, path), sites)):
            n, s = sums.get(key, (0, 0.0))
            sums[key] = (n + 1, s + fine)
    overall = sum(r[5] for r in rows) / len(rows)
    k = worth([(n, s, overall) for n, s in hosts.values()])
    host_share = {h: (s + k * overall) / (n + k) for h, (n, s) in hosts.items()}
    k = worth([(n, s, host_share[h]) for (h, _), (n, s) in sites.items()])
    assert len(found) == len(rows)
    for r in found:
        fine = rows[r.doc_id][5]
        n, s = sites[(r.host, r.path)]
        site = (s - fine + k * host_share[r.host]) / (n - 1 + k)
        assert r.site == pytest.approx(site, abs=1e-9)
        log_odds = _logit(fine) - _logit(overall) + _logit(site)
        assert r.posterior == pytest.approx(1 / (1 + math.exp(-log_odds)), abs=1e-9)
        assert r.keep == (r.posterior >= 0.5 - 1e-9)


def test_odd_rows(spark):
    schema = "doc_id long, text string, source string, lang string, toxic int, host int"
    rows = [(1, None, None, None, 1, 1), (None, "a b", "s", None, 0, 1), (2, "", "s", "en", 0, 1),
            (2, "", "s", "en", 0, 1)]
    docs = spark.createDataFrame(rows, schema)
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    found = quality.judge(docs, labels).collect()
    assert len(found) == 4 and all(r.keep for r in found)
    some = spark.createDataFrame([(1, 1, None), (2, None, 0), (2, 0, 0), (9, 0, 1)], labels.schema)
    assert quality.judge(docs, some).count() == 4
    assert quality.judge(docs.limit(0), some).collect() == []


def test_sample_holds_documents_at_hand(spark, monkeypatch):
    """Labels of others, empty ones and repeats don't use up the bounded sample."""
    monkeypatch.setattr(quality, "FITTED_AT_MOST", 100)
    texts = ["fine words of a good text", "spam spam buy now cheap"]
    docs = spark.createDataFrame(
        [(k, f"{texts[k % 2]} {k}", "s", "en") for k in range(100)],
        "doc_id long, text string, source string, lang string",
    )
    labels = [(k, 1 - k % 2, 0) for k in range(100)]
    labels += [(3, 0, 0)] * 3000 + [(k, None, None) for k in range(100)] * 3
    labels += [(k, k % 2, 0) for k in range(1000, 6000)]
    given = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    seen = []
    real = quality._telling
    monkeypatch.setattr(quality, "_telling", lambda f, c: seen.append(f.collect()) or real(f, c))
    found = {r.doc_id: r.good for r in quality.judge(docs, given).collect()}
    assert [len(rows) for rows in seen] == [100, 100]
    assert sum(r.quality for r in seen[0]) == 50
    assert all((found[k] > 0.5) == (k % 2 == 0) for k in range(100))


def test_one_labelled_id_on_many_rows_fits_no_more_than_the_bound(spark, monkeypatch):
    monkeypatch.setattr(quality, "FITTED_AT_MOST", 10)
    docs = [(7, f"copy number {k} of many") for k in range(500)] + [(k, f"text {k}") for k in range(100, 120)]
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(6)
    labels = spark.createDataFrame(
        [(7, 1, 0)] * 3 + [(k, k % 2, 0) for k in range(100, 120)], "doc_id long, quality int, toxic int"
    )
    fitted = []
    kept = quality.stored
    monkeypatch.setattr(quality, "stored", lambda df, name: fitted.append(kept(df, name)) or fitted[-1])
    quality.train(table, labels)
    assert fitted[0].count() <= 10
