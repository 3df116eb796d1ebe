"""Derived columns and report queries."""

import datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderstrata.operators import enrich, reports
from orderstrata.plans import sizing
from orderstrata.plans.reporting import sections

ORDERS = (
    "ProductID int, OrderDate date, TotalLineExtendedPrice decimal(19,4), "
    "LeadTimeInBusinessDays int"
)
PRODUCTS = "ProductID int, Color string, ProductCategoryName string"


def order(product, year, price, lead):
    date = datetime.date(year, 5, 1) if year else None
    return product, date, None if price is None else Decimal(price), lead


@pytest.fixture
def orders(spark):
    return spark.createDataFrame(
        [
            order(1, 2021, "10.0000", 1),
            order(2, 2021, "4.0000", 2),
            order(3, 2021, "6.0000", 4),
            order(1, 2022, "5.0000", None),
            order(2, 2022, "5.0000", 3),
            order(4, 2022, None, None),
            order(2, None, "1.0000", 3),
            order(4, 2023, None, None),
            order(9, 2021, "99.0000", 9),
            order(None, 2021, "99.0000", 9),
        ],
        ORDERS,
    )


@pytest.fixture
def products(spark):
    return spark.createDataFrame(
        [(1, "Red", "Bikes"), (2, "Blue", "Bikes"), (3, "Blue", None), (4, "N/A", "Racks")],
        PRODUCTS,
    )


TOP = [
    (None, "Blue", Decimal("1.0000")),
    # equal revenue: first by name
    (2021, "Blue", Decimal("10.0000")),
    (2022, "Blue", Decimal("5.0000")),
    # no revenue at all
    (2023, "N/A", None),
]
LEAD = [("Racks", None), ("Bikes", 2.25), (None, 4.0)]


@pytest.mark.parametrize("limit", [sizing.BROADCAST_BYTES, 0], ids=["broadcast", "summed"])
def test_sections(orders, products, limit):
    colors, lead_times = sections(orders, products, limit)
    assert [tuple(r) for r in colors.result.collect()] == TOP
    assert [tuple(r) for r in lead_times.result.collect()] == LEAD
    assert colors.question.endswith("each year?")


def test_both_ways_agree_on_columns_and_types(orders, products):
    joined = orders.join(products, "ProductID")
    assert (
        reports.color_revenue(joined).dtypes == reports.color_revenue_of(orders, products).dtypes
    )
    assert (
        reports.average_lead_times(joined).dtypes
        == reports.average_lead_times_of(orders, products).dtypes
    )


def test_measured_bytes(spark):
    df = spark.createDataFrame([(1, "abc"), (2, None)], "n int, t string")
    assert sizing.measured_bytes(df) == 2 * 2 * sizing.FIXED_WIDTH + 3
    assert sizing.measured_bytes(df.limit(0)) == 0
    assert sizing.small_enough(df, 67) and not sizing.small_enough(df, 66)


DETAILS = (
    "SalesOrderID int, SalesOrderDetailID int, OrderQty int, ProductID int, "
    "UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4)"
)
HEADERS = "SalesOrderID int, OrderDate date, ShipDate date, Freight decimal(19,4)"


def test_order_lines(spark):
    details = spark.createDataFrame(
        [
            (1, 10, 2, 5, Decimal("3.0000"), Decimal("0.5000")),
            (7, 11, 1, 5, Decimal("3.0000"), Decimal("0.0000")),
            (None, 12, 1, 5, Decimal("3.0000"), Decimal("0.0000")),
        ],
        DETAILS,
    )
    headers = spark.createDataFrame(
        [
            (1, datetime.date(2024, 1, 5), datetime.date(2024, 1, 9), Decimal("8.0000")),
            (None, None, None, None),
        ],
        HEADERS,
    )
    (line,) = enrich.order_lines(details, headers).collect()
    assert line.LeadTimeInBusinessDays == 2
    assert line.TotalLineExtendedPrice == Decimal("5.0000")
    assert line.TotalOrderFreight == Decimal("8.0000")
    assert "Freight" not in line


def test_one_order_with_very_many_lines_is_split(spark):
    """A third of the lines in one order: adaptive execution splits its partition."""
    lines = 300_000
    details = spark.range(0, lines, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).cast("int").alias("SalesOrderID"),
        F.col("id").cast("int").alias("SalesOrderDetailID"),
        F.lit(1).alias("OrderQty"),
        F.lit(5).alias("ProductID"),
        F.lit(2).cast("decimal(19,4)").alias("UnitPrice"),
        F.lit(0).cast("decimal(19,4)").alias("UnitPriceDiscount"),
    )
    headers = spark.range(0, lines, 1, 8).select(
        F.col("id").cast("int").alias("SalesOrderID"),
        F.lit(datetime.date(2024, 1, 5)).alias("OrderDate"),
        F.lit(datetime.date(2024, 1, 9)).alias("ShipDate"),
        F.lit(1).cast("decimal(19,4)").alias("Freight"),
    )
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        joined = enrich.order_lines(details, headers)
        joined.write.format("noop").mode("overwrite").save()
        rows = joined.collect()
        plan = joined._jdf.queryExecution().executedPlan().toString()
    finally:
        for name in small:
            spark.conf.unset(name)
    assert len(rows) == lines
    assert "SortMergeJoin(skew=true)" in plan


def test_products(spark):
    df = spark.createDataFrame(
        [
            (3, None, None, "Chains"),
            (1, "Red", None, "Chains"),
            (2, "Red", None, "Socks"),
            (4, "Red", None, None),
            (5, "Red", "Bikes", "Chains"),
        ],
        "ProductID int, Color string, ProductCategoryName string, ProductSubCategoryName string",
    )
    master = enrich.product_master(df)
    assert master.columns == df.columns
    assert {r.ProductID: r.Color for r in master.collect()}[3] == "N/A"
    left_over = enrich.without_category(master)
    assert sorted(r.ProductID for r in left_over.collect()) == [1, 3, 4]
    assert {tuple(r) for r in enrich.one_per_subcategory(left_over).collect()} == {
        ("Chains", 1),
        (None, 4),
    }


def test_top_color_cuts_rows_before_the_shuffle(orders, products):
    frame = reports.top_color_per_year(reports.color_revenue_of(orders, products))
    assert "WindowGroupLimit" in frame._jdf.queryExecution().executedPlan().toString()
