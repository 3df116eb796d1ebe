"""Rows shuffled once and cast once, tables and sample files packed, only files that are read."""

import random
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderstrata.contracts import SALES
from orderstrata.operators import dedupe, integrity
from orderstrata.plans import ingest, migrate
from orderstrata.samples import queries
from orderstrata.sources import ParquetTables
from test_layers import DETAILS, write_files

SCHEMA = "k int, a int, b int, fits boolean, note string"


def bag(df):
    return Counter(tuple(row) for row in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def some_rows(count=400):
    """Keys that stand under several values of ``a``; NULLs in all that decide; equal rows."""
    draw = random.Random(7)
    few = [None, 1, 2, 3]
    return [
        (draw.choice([None, *range(60)]), draw.choice(few), draw.choice(few), draw.random() < 0.8, "x")
        for _ in range(count)
    ]


@pytest.mark.parametrize("column", ["a", "k"])
def test_rows_in_place_are_marked_as_by_key(spark, column):
    df = spark.createDataFrame(some_rows(), SCHEMA).repartition(5)
    deciding = ["k", "a", "b"]
    by_key = dedupe.marked(df, "k", (), deciding, F.col("fits"))
    in_place = dedupe.marked_in_place(df, "k", column, 4, deciding, F.col("fits"))
    assert in_place.columns == by_key.columns
    assert bag(in_place) == bag(by_key)
    task = in_place.withColumn("task", F.spark_partition_id())
    assert task.groupBy(column).agg(F.count_distinct("task").alias("n")).where("n > 1").isEmpty()


def test_keys_of_several_values(spark):
    rows = [(1, 1), (1, 1), (2, 1), (2, 2), (3, None), (3, 4), (4, None), (None, 5), (None, 6)]
    df = spark.createDataFrame(rows, "k int, a int")
    torn = {r.k: (r._least, r._missing) for r in dedupe.torn_keys(df, "k", "a").collect()}
    assert torn == {2: (1, False), 3: (4, True), None: (5, False)}


def test_rows_in_place_need_a_deciding_column(spark):
    df = spark.createDataFrame(some_rows(3), SCHEMA)
    with pytest.raises(ValueError, match="not the first column"):
        dedupe.marked_in_place(df, "k", "b", 4)


def test_rows_without_torn_keys_are_shuffled_once(spark):
    df = spark.createDataFrame(some_rows(3), SCHEMA)
    told = dedupe.marked_in_place(df, "k", "a", 4, ["k", "a", "b"], F.col("fits"), torn=False)
    assert plan_of(told).count("Exchange") == 1


@pytest.fixture
def tables(spark, tmp_path):
    return ParquetTables(spark, str(tmp_path / "tables"))


def loaded(tables, folder):
    ingest.create_tables(tables, SALES.all())
    for load in (ingest.load_products, ingest.load_order_headers, ingest.load_order_details):
        load(tables, folder)
    return migrate.migrate_all(tables)


def test_migrated_rows_are_shuffled_once(spark, tmp_path, tables, monkeypatch):
    plans = {}
    write_parts = ParquetTables.write_parts

    def watched(self, contract, df, layout=None, *placed):
        plans[contract.name] = (layout, placed, plan_of(df))
        return write_parts(self, contract, df, layout, *placed)

    monkeypatch.setattr(ParquetTables, "write_parts", watched)
    assert all(m.success for m in loaded(tables, write_files(tmp_path / "in")))
    for name in ("store_sales_order_header", "store_sales_order_detail"):
        layout, placed, plan = plans[name]
        shuffles = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line]
        assert layout and placed == (True,) and len(shuffles) == 1


def test_a_line_number_of_two_orders(spark, tmp_path, tables):
    details = DETAILS + "101,1,1,1,1,0\n99,2,9,2,5,0\n99,2,8,2,5,0\n"
    outcome = loaded(tables, write_files(tmp_path / "in", details=details))[2]
    stored = tables.read(SALES.order_details).select("SalesOrderDetailID", "SalesOrderID", "OrderQty")
    assert bag(stored.where("SalesOrderDetailID < 3")) == Counter([(1, 100, 2), (2, 99, 8)])
    left = outcome.duplicates.select("SalesOrderDetailID", "SalesOrderID", "OrderQty")
    assert bag(left) == Counter([(1, 100, 2), (1, 101, 1), (2, 100, 1), (2, 99, 9)])
    assert outcome.counts == {"kept": 4, "duplicate": 4, "rejected": 2, "malformed": 0}


def test_values_are_cast_once_where_rows_are_sorted_out(spark):
    contract = SALES.order_details
    raw = spark.createDataFrame([("1",) * 6], ", ".join(f"{c} string" for c in contract.columns))
    plan = integrity.sort_out(raw, contract)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("cast(UnitPrice#") == 1


def test_tables_are_packed(spark, tables):
    tables.write_raw("numbers", spark.range(10))
    assert list(Path(tables.path("numbers")).glob("*.zstd.parquet"))
    assert tables.read_raw("numbers").count() == 10


def test_only_the_file_that_is_loaded_is_made(spark, tmp_path, monkeypatch):
    spark.createDataFrame(
        [(1, 2, "F", 3.0, "1995-01-04", "1-URGENT")],
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate string, o_orderpriority string",
    ).withColumn("o_orderdate", F.to_timestamp("o_orderdate")).write.parquet(
        str(tmp_path / "orders.parquet")
    )
    # neither products nor lines are there to be read
    assert queries.bronze_order_headers(spark, str(tmp_path)).count() == 2
    folder = Path(queries.input_files(spark, str(tmp_path), []).removeprefix("file:"))
    assert [f.name for f in folder.iterdir()] == [ingest.ORDER_HEADERS_FILE]
    assert all(f.suffix == ".gz" for f in folder.glob("*/part-*"))
