"""Rows sorted out in one scan, tables replaced at once, counts taken while writing, buckets."""

import subprocess
import sys
import textwrap
from collections import Counter
from decimal import Decimal
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from orderstrata.contracts import SALES, STORE_ORDER_DETAILS, STORE_PRODUCTS
from orderstrata.operators import dedupe, enrich, integrity
from orderstrata.plans import ingest, migrate, publish, sizing
from orderstrata.plans.layers import run_layers
from orderstrata.plans.outcomes import StageFailed
from orderstrata.sources import ParquetTables
from orderstrata.sources.parts import Layout
from test_dedupe import KEPT, ROWS, SCHEMA
from test_layers import DETAILS, PRODUCTS, rows, write_files


@pytest.fixture
def tables(spark, tmp_path):
    return ParquetTables(spark, str(tmp_path / "tables"))


def bag(df):
    return Counter(tuple(row) for row in df.collect())


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


# --- one numbering for rows kept and rows left over --------------------------------------


@pytest.mark.parametrize("heavy", [[], [1], [1, None], [None], [1, 2, 3, None, 99]])
def test_marked_rows(spark, heavy):
    df = spark.createDataFrame(ROWS, SCHEMA).repartition(4)
    told = dedupe.marked(df, "k", heavy)
    assert told.columns == ["k", "a", "b", "kept"]
    assert bag(told.where("kept").drop("kept")) == Counter(KEPT)
    assert bag(told.where("NOT kept").drop("kept")) == Counter(ROWS) - Counter(KEPT)


@pytest.mark.parametrize("heavy", [[], [1, None]])
def test_rows_that_take_no_part_are_not_kept(spark, heavy):
    df = spark.createDataFrame([(*r, "x") for r in ROWS], f"{SCHEMA}, note string")
    told = dedupe.marked(df, "k", heavy, columns=["k", "a", "b"], among=F.col("a").isNotNull())
    assert told.columns == ["k", "a", "b", "note", "kept"]
    assert bag(told.where("kept").select("k", "a", "b")) == Counter(
        [(1, "x", 3), (2, "y", None), (3, "z", 1), (None, "n", 1)]
    )
    assert told.count() == len(ROWS)
    # NULL says neither
    nothing = dedupe.marked(df, "k", heavy, ["k", "a", "b"], F.lit(None).cast("boolean"))
    assert nothing.where("kept").isEmpty() and nothing.count() == len(ROWS)


def test_marking_shuffles_once(spark):
    df = spark.createDataFrame(ROWS, SCHEMA)
    assert plan_of(dedupe.marked(df, "k")).count("Exchange") == 1
    apart = [line for line in plan_of(dedupe.marked(df, "k", [1])).splitlines() if "Exchange" in line]
    # rows of other keys go by their key, those of heavy ones by task, and then their first ones
    assert len(apart) == 3 and sum("_task" in line for line in apart) == 2


def test_heavy_keys(spark):
    df = spark.range(30_000).select(
        F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("k"),
        F.when(F.col("id") % 4 > 0, F.col("id").cast("string")).alias("t"),
    )
    assert sizing.heavy_keys(df, ["k", "t"], rows=5000) == {"k": [7], "t": [None]}
    assert sizing.heavy_keys(df, ["k"]) == {"k": []}
    assert sizing.heavy_keys(df.limit(0), ["k", "t"], rows=1) == {"k": [], "t": []}


# --- reasons -------------------------------------------------------------------------------


def raw_details(spark, *given):
    names = ", ".join(f"{c} string" for c in STORE_ORDER_DETAILS.columns)
    return spark.createDataFrame([(*g, "more") for g in given], f"{names}, Extra string")


BAD = [
    ("1", None, " x ", "5", "1", "0"),
    (None, "2", "1", "3000000000", "1234567890123456", ""),
    ("1", "3", "1.5", "5", "1.23456", None),
]
GOOD = [(" 1 ", "4", "1", None, " 1.23456 ", "-0"), ("1", "4", None, "6", "999999999999999.9999", "0")]


def test_reasons(spark):
    found = integrity.misfits(raw_details(spark, *BAD, *GOOD), STORE_ORDER_DETAILS)
    assert found.columns == [*STORE_ORDER_DETAILS.columns, "Extra", "reasons"]
    assert [tuple(r) for r in found.collect()] == [
        (*BAD[0], "more", ["SalesOrderDetailID is empty", "OrderQty does not take  x "]),
        (
            *BAD[1],
            "more",
            [
                "SalesOrderID is empty",
                "ProductID does not take 3000000000",
                "UnitPrice does not take 1234567890123456",
                "UnitPriceDiscount does not take ",
            ],
        ),
        (*BAD[2], "more", ["OrderQty does not take 1.5"]),
    ]


def test_reasons_of_domains(spark):
    row = dict.fromkeys(STORE_PRODUCTS.columns) | {"ProductID": "1", "Weight": "no"}
    units = [(" CM ", "LB"), ("cm", None), ("", "KG"), (None, " G")]
    given = [tuple((row | {"SizeUnitMeasureCode": s, "WeightUnitMeasureCode": w}).values()) for s, w in units]
    df = spark.createDataFrame(given, ", ".join(f"{c} string" for c in row))
    weight = "Weight does not take no"
    assert [r.reasons for r in integrity.misfits(df, STORE_PRODUCTS).collect()] == [
        [weight],
        ["SizeUnitMeasureCode does not allow cm", weight],
        ["SizeUnitMeasureCode does not allow ", weight, "WeightUnitMeasureCode does not allow KG"],
        [weight],
    ]


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_good_and_bad_in_one_scan(spark, tmp_path, ansi):
    raw_details(spark, *BAD, *GOOD).write.parquet(str(tmp_path / "raw"))
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        told = integrity.sort_out(spark.read.parquet(str(tmp_path / "raw")), STORE_ORDER_DETAILS)
        assert plan_of(told).count("FileScan") == 1
        good = told.where("given IS NULL").drop("reasons", "given")
        assert rows(good) == [
            (1, 4, 1, None, Decimal("1.2346"), Decimal("0.0000")),
            (1, 4, None, 6, Decimal("999999999999999.9999"), Decimal("0.0000")),
        ]
        assert rows(told.where("size(reasons) > 0").select("given.*")) == sorted(
            [(*b, "more") for b in BAD], key=repr
        )
    finally:
        spark.conf.unset("spark.sql.ansi.enabled")


MIXED = DETAILS + "101,7,many,3,1,0\n101,,1,99,1,0\n,7,1,1,1,0\n"


def test_malformed_rows_are_held(spark, tmp_path, tables):
    folder = write_files(
        tmp_path / "in", products=PRODUCTS.replace(" CM ", "MM"), details=MIXED
    )
    with pytest.raises(StageFailed, match="MM"):
        run_layers(tables, folder)
    run = run_layers(tables, folder, hold=True)
    products, headers, details = run.migrated
    assert products.counts == {"kept": 2, "duplicate": 1, "rejected": 0, "malformed": 1}
    assert headers.counts == {"kept": 2, "duplicate": 1, "rejected": 0, "malformed": 0}
    # with product 1 held its lines are turned away
    assert details.counts == {"kept": 2, "duplicate": 0, "rejected": 5, "malformed": 3}
    assert [r.reasons for r in products.malformed.collect()] == [
        ["SizeUnitMeasureCode does not allow MM"]
    ]
    held = details.malformed.sort("OrderQty", "SalesOrderID").collect()
    assert [(r.SalesOrderID, r.SalesOrderDetailID, r.reasons) for r in held] == [
        (None, "7", ["SalesOrderID is empty"]),
        ("101", None, ["SalesOrderDetailID is empty"]),
        ("101", "7", ["OrderQty does not take many"]),
    ]
    assert run.orders.rows == 2


def test_command_line_holds(spark, tmp_path, monkeypatch, capsys):
    from orderstrata.__main__ import main

    folder = write_files(tmp_path / "in", details=MIXED)
    store = str(tmp_path / "tables")
    given = ["orderstrata", folder, store, "--hold-malformed", "--keep-until-replaced"]
    monkeypatch.setattr("sys.argv", given)
    try:
        main()
    finally:
        for name in ("files.maxPartitionBytes", "adaptive.advisoryPartitionSizeInBytes"):
            spark.conf.unset(f"spark.sql.{name}")
        spark.conf.set("spark.sql.shuffle.partitions", "8")
    assert "3 malformed rows, with the reasons, in held_store_sales_order_detail" in capsys.readouterr().out
    held = ParquetTables(spark, store).read_raw("held_store_sales_order_detail")
    assert "OrderQty does not take many" in {r.reasons for r in held.collect()}


# --- tables replaced at once -----------------------------------------------------------------


def files_of(tables, name):
    return sorted(p.name for p in Path(tables.root, name).iterdir() if not p.name.startswith("."))


def numbers(spark, count, fails_at=None):
    """Rows in four tasks; one of them fails in the middle of the write."""
    value = F.col("id").cast("string")
    if fails_at is not None:
        value = F.when(F.col("id") == fails_at, F.raise_error(F.lit("out of paper"))).otherwise(value)
    return spark.range(0, count, 1, 4).select(value.alias("n"))


def test_a_write_that_fails_leaves_the_old_rows(spark, tables):
    assert tables.write_raw("numbers", numbers(spark, 100)) == 100
    before, seen = tables.read_raw("numbers"), files_of(tables, "numbers")
    with pytest.raises(Exception, match="out of paper"):
        tables.write_raw("numbers", numbers(spark, 2000, fails_at=1999))
    assert before.count() == tables.read_raw("numbers").count() == 100
    assert files_of(tables, "numbers") == seen  # nothing of the failed write stays


def test_readers_keep_what_they_read_for_a_while(spark, tables):
    frames = []
    for count in (10, 20, 30, 40):
        tables.write_raw("numbers", numbers(spark, count))
        frames.append(tables.read_raw("numbers"))
    assert [frames[2].count(), frames[3].count()] == [30, 40]
    assert len(files_of(tables, "numbers")) == 1 + tables.versions_kept
    one = ParquetTables(spark, tables.root, versions_kept=1)
    one.write_raw("numbers", numbers(spark, 50))
    assert len(files_of(tables, "numbers")) == 2 and tables.read_raw("numbers").count() == 50


def test_a_manifest_not_written_to_its_end_is_not_there(spark, tables):
    tables.write_raw("numbers", numbers(spark, 10))
    torn = Path(tables.root, "numbers", "_manifests", "000000000002.json")
    torn.write_text('{"folder": "v-0')
    assert tables.read_raw("numbers").count() == 10
    tables.write_raw("numbers", numbers(spark, 20))
    assert tables.read_raw("numbers").count() == 20


def test_of_two_writers_one_fails(spark, tables, monkeypatch):
    tables.write_raw("numbers", numbers(spark, 10))
    before = tables._versions("numbers")
    tables.write_raw("numbers", numbers(spark, 20))
    monkeypatch.setattr(tables, "_versions", lambda name: before)
    with pytest.raises(Exception, match="exists"):
        tables.write_raw("numbers", numbers(spark, 30))
    monkeypatch.undo()
    assert tables.read_raw("numbers").count() == 20


def test_folders_of_others_are_tables(spark, tables):
    empty = spark.createDataFrame([], SALES.products.schema)
    empty.write.parquet(f"{tables.root}/{SALES.products.name}")
    assert tables.exists(SALES.products) and not tables.exists(SALES.order_headers)
    assert tables.read(SALES.products).isEmpty() and tables.count(SALES.products) == 0


def test_old_rows_outlive_a_run_that_fails(spark, tmp_path, tables):
    run_layers(tables, write_files(tmp_path / "in"))
    bad = write_files(tmp_path / "bad", details=DETAILS + "1,9,x,1,1,0\n")
    with pytest.raises(StageFailed, match="x"):
        run_layers(tables, bad, recreate=False)
    assert tables.count(SALES.order_details) == 4
    assert tables.read(SALES.published_orders).count() == 3
    with pytest.raises(StageFailed, match="x"):
        run_layers(tables, bad)
    assert tables.read(SALES.published_orders).isEmpty()


# --- counts ----------------------------------------------------------------------------------


def test_counts_come_from_the_write_itself(spark, tmp_path, tables):
    ingest.create_tables(tables, SALES.all())
    folder = write_files(tmp_path / "in")
    ingest.load_products(tables, folder)
    ingest.load_order_details(tables, folder)
    group = "counted-while-written"
    migrate.migrate_products(tables)
    spark.sparkContext.setJobGroup(group, group)
    try:
        assert tables.write(SALES.published_products, tables.read(SALES.products)) == 3
        assert tables.count(SALES.published_products) == 3
        jobs = spark.sparkContext.statusTracker().getJobIdsForGroup(group)
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert len(jobs) == 1


RETRIED = """
import sys, tempfile
sys.path.insert(0, {repo!r})
from pyspark import TaskContext
from pyspark.sql import SparkSession, functions as F
from orderstrata.sources import ParquetTables
spark = (SparkSession.builder.master("local[2,3]").config("spark.ui.enabled", "false")
    .config("spark.sql.shuffle.partitions", "3").getOrCreate())

@F.udf("long")
def once(n):
    context = TaskContext.get()
    if context.attemptNumber() == 0 and n % 1000 == 999:
        raise OSError("lost")
    return n

tables = ParquetTables(spark, {root!r})
rows = spark.range(0, 5000, 1, 4).select(once("id").alias("id"))
print("COUNTED", tables.write_raw("plain", rows), tables.read_raw("plain").count())
shuffled = rows.repartition(3).select(once("id").alias("id"))
print("COUNTED", tables.write_raw("shuffled", shuffled), tables.read_raw("shuffled").count())
"""


def test_rows_of_a_task_tried_again_count_once(tmp_path):
    code = RETRIED.format(repo=str(Path(__file__).parents[1]), root=str(tmp_path / "tables"))
    run = subprocess.run(
        [sys.executable, "-c", textwrap.dedent(code)], capture_output=True, text=True, timeout=240
    )
    told = [line for line in run.stdout.splitlines() if line.startswith("COUNTED")]
    assert told == ["COUNTED 5000 5000"] * 2, run.stderr[-2000:]
    assert "lost" in run.stderr


# --- buckets ----------------------------------------------------------------------------------


@pytest.fixture
def shuffled_joins(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def loaded(tables, folder):
    ingest.create_tables(tables, SALES.all())
    for load in (ingest.load_products, ingest.load_order_headers, ingest.load_order_details):
        load(tables, folder)
    assert all(m.success for m in migrate.migrate_all(tables))


def test_orders_are_joined_where_they_lie(spark, tmp_path, tables, shuffled_joins):
    loaded(tables, write_files(tmp_path / "in"))
    assert tables.version("store_sales_order_detail").layout == Layout("SalesOrderID", 8)
    lines = enrich.order_lines(*tables.read_for_join(SALES.order_details, SALES.order_headers))
    plan = plan_of(lines)
    assert "SortMergeJoin" in plan and "Exchange" not in plan and plan.count("Bucketed: true") == 2
    assert publish.publish_orders(tables).rows == 3
    # each bucket of each part is one file
    folder = Path(tables.path("store_sales_order_detail"))
    buckets = [f.name.rsplit("_", 1)[1] for f in folder.glob("*.parquet")]
    assert len(buckets) == len(set(buckets))


def test_lines_of_a_heavy_order_are_not_put_into_one_bucket(
    spark, tmp_path, tables, monkeypatch, shuffled_joins
):
    find = sizing.heavy_keys
    monkeypatch.setattr(migrate, "heavy_keys", lambda df, columns: find(df, columns, rows=3))
    loaded(tables, write_files(tmp_path / "in"))
    assert tables.version("store_sales_order_detail").layout is None
    assert tables.version("store_sales_order_header").layout is not None
    lines = enrich.order_lines(*tables.read_for_join(SALES.order_details, SALES.order_headers))
    assert plan_of(lines).count("Exchange hashpartitioning(SalesOrderID") == 2
    assert publish.publish_orders(tables).rows == 3
