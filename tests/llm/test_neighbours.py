"""Nearest rows against all inner products; the SQL of every query against its rows."""

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import oracle_sql, queries
from orderstrata.llm import neighbours
from orderstrata.llm.queries import QUERIES

SF_DIR = "/root/testdata/sf0.001"


def _wanted(rows, k):
    usable = {(i, tuple(v)) for i, v in rows
              if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}
    answers = {}
    for i, q in usable:
        if i % 3:
            continue
        scored = []
        for j, x in usable:
            if j != i and len(x) == len(q):
                total = 0.0
                for a, b in zip(q, x, strict=True):
                    total += float(a) * float(b)
                scored.append((-total, j))
        answers.setdefault(i, []).extend(sorted(scored))
    return {(i, n + 1, j, -s) for i, a in answers.items() for n, (s, j) in enumerate(sorted(a)[:k])}


@pytest.mark.parametrize("kind", ["float", "double"])
def test_nearest(spark, kind, monkeypatch):
    monkeypatch.setattr(neighbours, "QUERIES_PER_BLOCK", 16)
    monkeypatch.setattr(neighbours, "ROWS_PER_BLOCK", 40)
    monkeypatch.setattr(neighbours, "BLOCKS_PER_TASK", 2)
    monkeypatch.setattr(neighbours, "ASKED_TOGETHER", 3)
    rng = np.random.default_rng(0)
    vectors = rng.normal(size=(300, 6)).astype(np.float32)
    vectors[50:90] = vectors[10]  # ties
    vectors[200:230] = np.round(vectors[200:230])
    rows = [(k, [float(x) for x in v]) for k, v in enumerate(vectors)]
    rows += [(300, None), (301, [0.0] * 6), (302, [1.0, None] + [0.0] * 4), (303, [float("nan")] * 6),
             (None, [1.0] * 6), (306, [float("inf")] + [1.0] * 5), (309, [1.0, 2.0]), (310, [3.0, 1.0]),
             (312, [1e-30] * 6), rows[5], rows[6]]
    table = spark.createDataFrame([(*r, 1) for r in rows], f"vec_id long, embedding array<{kind}>, rank int")
    asked = [(i, None if v is None else [None if x is None else (np.float32(x) if kind == "float" else x) for x in v]) for i, v in rows]
    found = neighbours.nearest(table, F.col("vec_id") % 3 == 0, k=5).collect()
    assert {tuple(r) for r in found} == _wanted(asked, 5) and len(found) == len({tuple(r) for r in found})
    assert neighbours.nearest(table.limit(0), F.lit(True)).collect() == []
    alone = table.where("vec_id = 3")
    assert neighbours.nearest(alone, F.lit(True)).collect() == []


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    yield connection
    connection.close()


@pytest.mark.parametrize("name", [*QUERIES, "pipeline"])
def test_registered_query(spark, duck, name):
    frame = queries()[name](spark, SF_DIR)
    rows = [tuple(r) for r in frame.collect()]
    assert rows
    if name not in oracle_sql():
        return
    wanted = duck.execute(oracle_sql()[name])
    columns = [c[0] for c in wanted.description]
    assert sorted(columns) == sorted(frame.columns)
    order = [columns.index(c) for c in frame.columns]
    expected = [tuple(r[k] for k in order) for r in wanted.fetchall()]
    assert sorted(rows, key=repr) == sorted(expected, key=repr)
