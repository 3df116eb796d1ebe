"""Report queries over published orders and products."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

TOTAL = "decimal(38,4)"


def _total(column: str, name: str) -> Column:
    return F.sum(column).cast(TOTAL).alias(name)


def color_revenue(lines: DataFrame) -> DataFrame:
    """Revenue by order year and colour of lines that carry their product's colour."""
    return lines.groupBy(F.year("OrderDate").alias("OrderYear"), "Color").agg(
        _total("TotalLineExtendedPrice", "TotalRevenue")
    )


def top_color_per_year(revenue: DataFrame) -> DataFrame:
    """The colour with the highest revenue of each year; ties go to the first by name."""
    by_revenue = Window.partitionBy("OrderYear").orderBy(F.desc("TotalRevenue"), F.asc("Color"))
    return (
        revenue.withColumn("_rank", F.row_number().over(by_revenue))
        .where("_rank = 1")
        .select("OrderYear", "Color", "TotalRevenue")
        .orderBy("OrderYear")
    )


def highest_revenue_colors(lines: DataFrame) -> DataFrame:
    return top_color_per_year(color_revenue(lines))


def average_lead_times(lines: DataFrame) -> DataFrame:
    """Mean lead time by product category of lines that carry it, shortest first."""
    return (
        lines.groupBy("ProductCategoryName")
        .agg(F.avg("LeadTimeInBusinessDays").alias("AvgLeadTime"))
        .orderBy("AvgLeadTime")
    )


def color_revenue_of(orders: DataFrame, products: DataFrame) -> DataFrame:
    """:func:`color_revenue` of the two tables joined, summed per product before the join.

    Only one row per product and year is joined, so neither the number of
    lines nor a product sold very often shapes the join.
    """
    per_product = orders.groupBy("ProductID", F.year("OrderDate").alias("OrderYear")).agg(
        F.sum("TotalLineExtendedPrice").alias("_revenue")
    )
    return (
        per_product.join(products.select("ProductID", "Color"), "ProductID")
        .groupBy("OrderYear", "Color")
        .agg(_total("_revenue", "TotalRevenue"))
    )


def average_lead_times_of(orders: DataFrame, products: DataFrame) -> DataFrame:
    """:func:`average_lead_times` of the two tables joined, summed per product before the join."""
    per_product = orders.groupBy("ProductID").agg(
        F.sum("LeadTimeInBusinessDays").alias("_days"),
        F.count("LeadTimeInBusinessDays").alias("_lines"),
    )
    joined = per_product.join(products.select("ProductID", "ProductCategoryName"), "ProductID")
    mean = F.try_divide(F.sum("_days").cast("double"), F.sum("_lines"))
    return (
        joined.groupBy("ProductCategoryName")
        .agg(mean.alias("AvgLeadTime"))
        .orderBy("AvgLeadTime")
    )
