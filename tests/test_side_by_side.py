"""Migrations that overlap, and database tables read in parts that the database names."""

import threading
import time
from decimal import Decimal

import pytest
from pyspark.sql import DataFrameReader

from orderstrata.contracts import SALES
from orderstrata.plans import ingest, migrate
from orderstrata.plans.outcomes import Migrated
from orderstrata.sources import JdbcTables, ParquetTables, Split
from test_layers import DETAILS, HEADERS, PRODUCTS, write_files


def test_products_and_headers_overlap_and_details_come_last(spark, monkeypatch, tmp_path):
    both, log = threading.Barrier(2, timeout=20), []

    def step(name, meets):
        def run(tables, layers, hold):
            log.append((name, "begins"))
            if meets:
                both.wait()  # neither would get here alone
                time.sleep(0.1)
            pool = spark.sparkContext.getLocalProperty("spark.scheduler.pool")
            log.append((name, "ends"))
            return Migrated(name, counts={"pool": pool, "hold": hold})

        return run

    for name, meets in (("products", True), ("order_headers", True), ("order_details", False)):
        monkeypatch.setattr(migrate, f"migrate_{name}", step(name, meets))
    outcomes = migrate.migrate_all(ParquetTables(spark, str(tmp_path)), hold=True)
    assert [m.table for m in outcomes] == ["products", "order_headers", "order_details"]
    assert [m.counts["pool"] for m in outcomes] == [
        "store_products",
        "store_sales_order_header",
        "store_sales_order_detail",
    ]
    assert all(m.counts["hold"] for m in outcomes)
    assert log.index(("order_details", "begins")) > log.index(("products", "ends"))
    assert spark.sparkContext.getLocalProperty("spark.scheduler.pool") is None


@pytest.mark.parametrize(
    ("files", "failed"),
    [
        ({"products": PRODUCTS.replace("x,3", "x,three")}, 0),
        ({"headers": HEADERS.replace("2022-06-03", "soon")}, 1),
        ({"details": DETAILS.replace("999,6", "999,six")}, 2),
    ],
)
def test_one_that_fails_does_not_stop_the_others(spark, tmp_path, files, failed):
    tables = ParquetTables(spark, str(tmp_path / "tables"))
    folder = write_files(tmp_path / "in", **files)
    ingest.create_tables(tables, SALES.all())
    for load in (ingest.load_products, ingest.load_order_headers, ingest.load_order_details):
        load(tables, folder)
    outcomes = migrate.migrate_all(tables)
    assert [m.success for m in outcomes] == [k != failed for k in range(3)]
    # without products no detail is one of a known product
    assert outcomes[2].rows == (0 if failed in (0, 2) else 4)


@pytest.fixture
def asked(spark, monkeypatch):
    """What is asked of Spark's JDBC source, and answers from frames."""
    log, answers = [], {}

    def options(self, **given):
        log.append(given)
        return self

    def load(self):
        given = log[-1]
        return answers.get(given.get("query") or given["dbtable"], "frame")

    monkeypatch.setattr(DataFrameReader, "options", options)
    monkeypatch.setattr(DataFrameReader, "load", load)
    monkeypatch.setattr(
        DataFrameReader, "jdbc", lambda self, *a, **k: log.append(k["predicates"]) or "frame"
    )
    return log, answers


URL = "jdbc:postgresql://host/db"


def test_ranges_of_numbers_are_asked_for(spark, asked):
    log, answers = asked
    tables = JdbcTables(spark, URL, keys=ingest.keys_of(SALES), parts=8)
    name = SALES.products.name
    answers[name] = spark.createDataFrame([], SALES.products.schema)
    query = f'SELECT min("ProductID") AS lower_end, max("ProductID") AS upper_end FROM {name}'
    answers[query] = spark.createDataFrame([(3, 999)], "a int, b int")
    assert tables.planned(name) == Split("ProductID", 3, 999, 8)
    tables.read(SALES.products)
    assert log[-1] == {
        "url": URL,
        "dbtable": name,
        "partitionColumn": "ProductID",
        "lowerBound": "3",
        "upperBound": "999",
        "numPartitions": "8",
    }
    answers[query] = spark.createDataFrame([(None, None)], "a int, b int")
    tables.read(SALES.products)
    assert log[-1] == {"url": URL, "dbtable": name}


def test_parts_of_texts_are_asked_for(spark, asked):
    log, answers = asked
    tables = JdbcTables(spark, URL, keys=ingest.keys_of(SALES), parts=4)
    name = ingest.RAW_PRODUCTS
    answers[name] = spark.createDataFrame([], "ProductID string")
    query = (
        'SELECT part, min(k) AS least FROM (SELECT "ProductID" AS k, ntile(4) OVER'
        f' (ORDER BY "ProductID") AS part FROM {name} WHERE "ProductID" IS NOT NULL) t GROUP BY part'
    )
    # the database's order of texts is its own; equal keys can begin two parts
    answers[query] = spark.createDataFrame(
        [(3, "B"), (1, "a"), (2, "it's"), (4, "B")], "part int, least string"
    )
    tables.read_raw(name)
    assert log[-1] == [
        """"ProductID" < 'it''s' OR "ProductID" IS NULL""",
        """"ProductID" >= 'it''s' AND "ProductID" < 'B'""",
        """"ProductID" >= 'B'""",
    ]
    for few in ([], [(1, "a")], [(1, "a"), (2, "a")]):
        answers[query] = spark.createDataFrame(few, "part int, least string")
        tables.read_raw(name)
        assert log[-1] == {"url": URL, "dbtable": name}


def test_what_is_given_is_not_asked_for(spark, asked):
    log, _ = asked
    keys = ingest.keys_of(SALES)
    given = JdbcTables(spark, URL, keys=keys, predicates={ingest.RAW_PRODUCTS: ["TRUE"]})
    given.read_raw(ingest.RAW_PRODUCTS)
    split = JdbcTables(spark, URL, keys=keys, splits={"store_products": Split("ProductID", 0, 9, 2)})
    split.read(SALES.products)
    alone = JdbcTables(spark, URL, keys=keys, parts=1)
    alone.read(SALES.products)
    assert log[0] == ["TRUE"] and log[1]["upperBound"] == "9" and len(log) == 3


def test_keys_of_all_tables():
    keys = ingest.keys_of(SALES)
    assert len(keys) == 8 and keys[ingest.RAW_ORDER_DETAILS] == "SalesOrderDetailID"


def test_command_line_names_keys_and_parts(monkeypatch, spark):
    from orderstrata import __main__ as command

    class Stop(Exception):
        pass

    def run(tables, folder, layers, **how):
        raise Stop(tables, how)

    monkeypatch.setattr(command, "run_layers", run)
    monkeypatch.setattr(command, "size_for", lambda *a: None)
    given = ["orderstrata", "/nowhere", URL, "--jdbc-option", "user=u=1", "--jdbc-parts", "40"]
    monkeypatch.setattr("sys.argv", given)
    with pytest.raises(Stop) as told:
        command.main()
    tables, how = told.value.args
    assert (tables.parts, tables.properties) == (40, {"user": "u=1"})
    assert tables.keys == ingest.keys_of(SALES) and how == {"hold": False, "recreate": True}


def test_money_and_days_are_ranges(spark, asked):
    _, answers = asked
    tables = JdbcTables(spark, URL, keys={"t": "d"}, parts=3)
    answers["t"] = spark.createDataFrame([], "d decimal(19,4)")
    answers['SELECT min("d") AS lower_end, max("d") AS upper_end FROM t'] = spark.createDataFrame(
        [(Decimal("1.5000"), Decimal("9.0000"))], "a decimal(19,4), b decimal(19,4)"
    )
    assert tables.planned("t").options()["lowerBound"] == "1.5000"
