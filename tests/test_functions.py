"""Column expressions on inline rows."""

import datetime
import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderstrata.functions import (
    CategoryRule,
    business_days,
    categorised,
    extended_price,
    known_color,
)

DATES = "OrderDate date, ShipDate date"


def day(text):
    return text and datetime.date.fromisoformat(text)


@pytest.mark.parametrize(
    ("start", "end", "expected"),
    [
        ("2024-01-08", "2024-01-12", 4),
        ("2024-01-08", "2024-01-08", 0),
        ("2024-01-05", "2024-01-09", 2),
        (None, "2024-01-09", None),
        ("2024-01-08", None, None),
        (None, None, None),
        # no weekday in the range
        ("2024-01-06", "2024-01-07", -1),
        ("2024-01-06", "2024-01-06", -1),
        # weekend at one end
        ("2024-01-06", "2024-01-08", 0),
        ("2024-01-05", "2024-01-06", 0),
        ("2024-01-08", "2024-01-15", 5),
        # shipped before ordered
        ("2024-01-09", "2024-01-08", 1),
        ("2024-01-08", "2024-01-05", 1),
    ],
)
def test_business_days(spark, start, end, expected):
    df = spark.createDataFrame([(day(start), day(end))], DATES)
    assert df.select(business_days("OrderDate", "ShipDate")).first()[0] == expected


def test_business_days_counts_as_a_listing_of_the_days_does(spark):
    pick = random.Random(7)
    first, span = datetime.date(1931, 1, 1).toordinal(), 55_000
    rows = []
    for _ in range(3000):
        start = first + pick.randrange(span)
        end = start + pick.randrange(-400, 400)
        rows.append((datetime.date.fromordinal(start), datetime.date.fromordinal(end)))
    counted = spark.createDataFrame(rows, DATES).select(
        "OrderDate", "ShipDate", business_days("OrderDate", "ShipDate").alias("days")
    )
    assert counted.schema["days"].dataType.simpleString() == "int"
    for row in counted.collect():
        low, high = sorted((row.OrderDate.toordinal(), row.ShipDate.toordinal()))
        listed = [datetime.date.fromordinal(d).weekday() for d in range(low, high + 1)]
        assert row.days == sum(weekday < 5 for weekday in listed) - 1


def test_business_days_takes_columns(spark):
    df = spark.createDataFrame([(day("2024-01-08"), day("2024-01-12"))], DATES)
    assert df.select(business_days(F.col("OrderDate"), F.col("ShipDate"))).first()[0] == 4


@pytest.mark.parametrize(
    ("category", "subcategory", "expected"),
    [
        (None, "Shorts", "Clothing"),
        (None, "Helmets", "Accessories"),
        (None, "Road Frames", "Components"),
        (None, "Wheels", "Components"),
        (None, "UnknownProduct", None),
        (None, None, None),
        (None, "shorts", None),
        (None, "road frames", None),
        ("ExistingCategory", "Shorts", "ExistingCategory"),
        ("", "Shorts", ""),
        ("Bikes", None, "Bikes"),
    ],
)
def test_categorised(spark, category, subcategory, expected):
    df = spark.createDataFrame(
        [(category, subcategory)], "ProductCategoryName string, ProductSubCategoryName string"
    )
    assert df.select(categorised()).first()[0] == expected


def test_first_matching_rule_wins(spark):
    rules = (CategoryRule("A", ("x",)), CategoryRule("B", ("x", "y"), containing="z"))
    df = spark.createDataFrame(
        [(None, "x"), (None, "y"), (None, "uzu")],
        "ProductCategoryName string, ProductSubCategoryName string",
    )
    assert [r[0] for r in df.select(categorised(rules=rules)).collect()] == ["A", "B", "B"]


def test_known_color(spark):
    df = spark.createDataFrame([("Red",), (None,), ("",)], "Color string")
    assert [r[0] for r in df.select(known_color()).collect()] == ["Red", "N/A", ""]


def test_extended_price(spark):
    df = spark.createDataFrame(
        [
            (3, Decimal("10.5000"), Decimal("0.2500")),
            (None, Decimal("10.5000"), Decimal("0.2500")),
            (3, None, Decimal("0.2500")),
            (3, Decimal("10.5000"), None),
            (-1, Decimal("0.0001"), Decimal("0.0003")),
        ],
        "OrderQty int, UnitPrice decimal(19,4), UnitPriceDiscount decimal(19,4)",
    ).select(extended_price().alias("amount"))
    assert df.schema["amount"].dataType.simpleString() == "decimal(19,4)"
    assert [r.amount for r in df.collect()] == [
        Decimal("30.7500"),
        None,
        None,
        None,
        Decimal("0.0002"),
    ]
