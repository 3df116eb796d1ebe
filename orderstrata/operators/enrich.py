"""Derived columns of the publish layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstrata.functions import (
    CATEGORY_RULES,
    CategoryRule,
    business_days,
    categorised,
    extended_price,
    known_color,
)


def product_master(
    products: DataFrame, rules: tuple[CategoryRule, ...] = CATEGORY_RULES
) -> DataFrame:
    """Products with a default colour and, where missing, a category from the subcategory."""
    return products.withColumns(
        {"Color": known_color(), "ProductCategoryName": categorised(rules=rules)}
    )


def without_category(products: DataFrame) -> DataFrame:
    """Products that still have no category."""
    return products.where(F.col("ProductCategoryName").isNull())


def one_per_subcategory(products: DataFrame) -> DataFrame:
    """Each subcategory, NULL included, with its lowest product id."""
    return products.groupBy("ProductSubCategoryName").agg(
        F.min("ProductID").alias("ProductID")
    )


def name_total_freight(df: DataFrame) -> DataFrame:
    return df.withColumnRenamed("Freight", "TotalOrderFreight")


def order_lines(details: DataFrame, headers: DataFrame) -> DataFrame:
    """Lines joined with their order, with lead time and extended price.

    Lines without an order are left out. A single order with very many lines
    is split by adaptive execution's skew join, as headers are unique by key.
    """
    joined = details.join(headers, "SalesOrderID")
    measured = joined.withColumns(
        {
            "LeadTimeInBusinessDays": business_days("OrderDate", "ShipDate"),
            "TotalLineExtendedPrice": extended_price(),
        }
    )
    return name_total_freight(measured)
