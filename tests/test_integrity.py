"""Checks of what a contract declares."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from orderstrata.contracts import SALES, STORE_ORDER_DETAILS, STORE_PRODUCTS
from orderstrata.operators import integrity
from orderstrata.plans import migrate

DETAIL = "SalesOrderID int, SalesOrderDetailID int, ProductID int"


def details(spark):
    return spark.createDataFrame(
        [(1, 10, 5), (1, 11, 6), (2, 12, None), (None, 13, 5), (2, None, 5), (2, 11, 9)], DETAIL
    )


def products(spark):
    rows = [("a", 5), ("b", 5), ("c", 6), ("d", None)]
    return spark.createDataFrame(rows, "n string, ProductID int")


def keys(df):
    return sorted(str(row.SalesOrderDetailID) for row in df.collect())


def test_referenced(spark):
    found = integrity.referenced(details(spark), products(spark), "ProductID")
    assert found.columns == details(spark).columns
    assert keys(found) == ["10", "11", "13", "None"]


def test_orphans_allow_null(spark):
    assert keys(integrity.orphans(details(spark), products(spark), "ProductID")) == ["11"]


def test_missing_required(spark):
    assert keys(integrity.missing_required(details(spark), STORE_ORDER_DETAILS)) == ["13", "None"]


def test_repeated_keys(spark):
    rows = integrity.repeated_keys(details(spark), STORE_ORDER_DETAILS).collect()
    assert [tuple(r) for r in rows] == [(11, 2)]


def product_rows(spark, *units):
    schema = "SizeUnitMeasureCode string, WeightUnitMeasureCode string"
    return spark.createDataFrame(list(units), schema)


def test_outside_domain(spark):
    df = product_rows(spark, ("CM", "LB"), (None, None), ("cm", "LB"), ("FT", "KG"), ("", "G"))
    bad = integrity.outside_domain(df, STORE_PRODUCTS).collect()
    assert [tuple(r) for r in bad] == [("cm", "LB"), ("FT", "KG"), ("", "G")]


def test_contract_without_domains_has_no_offenders(spark):
    assert integrity.outside_domain(details(spark), STORE_ORDER_DETAILS).isEmpty()


def full_product(spark, **values):
    row = spark.range(1).select(
        [F.lit(None).cast(f.dataType).alias(f.name) for f in STORE_PRODUCTS.schema]
    )
    return row.withColumns({"ProductID": F.lit(1), **{k: F.lit(v) for k, v in values.items()}})


def test_conform_passes_allowed_rows(spark):
    df = full_product(spark, SizeUnitMeasureCode="CM", Weight=Decimal("1.23455"))
    row = integrity.conform(df, STORE_PRODUCTS).first()
    assert (row.ProductID, row.SizeUnitMeasureCode) == (1, "CM")
    assert row.Weight == Decimal("1.2346")


@pytest.mark.parametrize(
    ("column", "value", "message"),
    [
        ("ProductID", None, "store_products.ProductID is empty"),
        ("SizeUnitMeasureCode", "MM", "store_products.SizeUnitMeasureCode does not allow MM"),
        ("WeightUnitMeasureCode", "", "store_products.WeightUnitMeasureCode does not allow"),
    ],
)
def test_conform_fails_on_other_rows(spark, column, value, message):
    df = full_product(spark, **{column: value})
    with pytest.raises(Exception, match=message):
        integrity.conform(df, STORE_PRODUCTS).collect()


def test_widened_contracts_change_identifiers_only():
    for narrow, wide in zip(SALES.all(), SALES.widened().all()):
        for before, after in zip(narrow.schema, wide.schema):
            assert (before.name, before.nullable) == (after.name, after.nullable)
            if before.name.endswith("ID"):
                assert after.dataType.simpleString() == "bigint"
            else:
                assert before.dataType == after.dataType


def test_rows_without_a_key_stay_out_of_the_shuffle(spark, tmp_path):
    """Many NULL keys must not meet in one task."""
    details(spark).write.parquet(str(tmp_path / "details"))
    products(spark).write.parquet(str(tmp_path / "products"))
    lines = spark.read.parquet(str(tmp_path / "details"))
    parents = spark.read.parquet(str(tmp_path / "products"))
    for check in (integrity.referenced, integrity.orphans):
        plan = check(lines, parents, "ProductID")._jdf.queryExecution().executedPlan().toString()
        assert plan.count("PushedFilters: [IsNotNull(ProductID)]") >= 1
        assert "isnotnull(ProductID" in plan


def test_lines_of_a_product_sold_very_often_are_split(spark):
    """A third of the lines of one product: adaptive execution splits its partition."""
    lines = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("ProductID"),
        F.concat(F.lit("line "), F.col("id").cast("string")).alias("text"),
    )
    known = spark.range(0, 200_000, 1, 8).withColumnRenamed("id", "ProductID")
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "100000",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200000",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
    }
    for name, value in small.items():
        spark.conf.set(name, value)
    try:
        plans = []
        for kept in (
            integrity.referenced(lines, known, "ProductID"),
            migrate._with_known(lines, known).where("known"),
        ):
            kept.write.format("noop").mode("overwrite").save()
            assert kept.agg(F.count("*")).head()[0] == 100_000 + 133_333
            rows = kept.select("text")
            rows.collect()
            plans.append(rows._jdf.queryExecution().executedPlan().toString())
    finally:
        for name in small:
            spark.conf.unset(name)
    assert all("SortMergeJoin(skew=true)" in plan for plan in plans)
