"""Raw text to typed columns."""

import datetime
from decimal import Decimal

import pytest
from pyspark.errors import AnalysisException
from pyspark.sql.types import IntegerType, StringType, StructField, StructType

from orderstrata.contracts import STORE_ORDER_HEADERS, STORE_PRODUCTS, MONEY
from orderstrata.operators.clean import clean

HEADER = STORE_ORDER_HEADERS.columns


def header(spark, **values):
    row = dict.fromkeys(HEADER)
    row.update(SalesOrderID="1", **values)
    schema = ", ".join(f"{c} string" for c in row)
    return spark.createDataFrame([tuple(row.values())], schema)


def test_texts_are_trimmed_and_typed(spark):
    raw = header(
        spark,
        OrderDate=" 2021-01-05 ",
        ShipDate="2021-6-1",
        OnlineOrderFlag=" true ",
        AccountNumber="  10-4020  ",
        CustomerID=" 12 ",
        Freight=" 1.23456 ",
    )
    cleaned = clean(raw, STORE_ORDER_HEADERS.schema)
    assert [f.dataType for f in cleaned.schema] == [
        f.dataType for f in STORE_ORDER_HEADERS.schema
    ]
    assert tuple(cleaned.first()) == (
        1,
        datetime.date(2021, 1, 5),
        datetime.date(2021, 6, 1),
        True,
        "10-4020",
        12,
        None,
        Decimal("1.2346"),
    )


def test_only_spaces_are_trimmed(spark):
    raw = spark.createDataFrame([("\ta ",), ("   ",), ("",), (None,)], "t string")
    schema = StructType([StructField("t", StringType())])
    assert [r.t for r in clean(raw, schema).collect()] == ["\ta", "", "", None]


@pytest.mark.parametrize(("text", "flag"), [("yes", True), ("1", True), ("no", False)])
def test_words_for_flags(spark, text, flag):
    cleaned = clean(header(spark, OnlineOrderFlag=text), STORE_ORDER_HEADERS.schema)
    assert cleaned.first().OnlineOrderFlag is flag


def test_contract_decides_columns_their_order_and_case(spark):
    raw = spark.createDataFrame([("x", "7", "y")], "extra string, NUMBER string, Name string")
    schema = StructType([StructField("name", StringType()), StructField("Number", IntegerType())])
    cleaned = clean(raw, schema)
    assert cleaned.columns == ["name", "Number"]
    assert tuple(cleaned.first()) == ("y", 7)


def test_missing_column_is_an_error(spark):
    raw = spark.createDataFrame([("1",)], "ProductID string")
    with pytest.raises(AnalysisException):
        clean(raw, STORE_PRODUCTS.schema)


@pytest.mark.parametrize(
    ("column", "text"),
    [
        ("CustomerID", ""),
        ("CustomerID", "abc"),
        ("CustomerID", "1.0"),
        ("CustomerID", "3000000000"),
        ("OrderDate", "6/1/2021"),
        ("Freight", "1,5"),
        ("Freight", "1" * 16),
        ("OnlineOrderFlag", "maybe"),
    ],
)
def test_malformed_text_fails(spark, column, text):
    cleaned = clean(header(spark, **{column: text}), STORE_ORDER_HEADERS.schema)
    with pytest.raises(Exception, match="CAST_INVALID_INPUT|NUMERIC_VALUE_OUT_OF_RANGE"):
        cleaned.collect()


def test_one_projection_over_the_scan(spark, tmp_path):
    path = str(tmp_path / "raw")
    header(spark, Freight="1").write.parquet(path)
    narrow = StructType([StructField("Freight", MONEY)])
    plan = clean(spark.read.parquet(path), narrow)._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<Freight:string>" in plan
    assert plan.count("Project") == 1
