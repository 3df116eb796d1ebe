"""The report over the publish layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstrata.contracts import SALES, Layers
from orderstrata.operators.reports import (
    average_lead_times,
    average_lead_times_of,
    color_revenue_of,
    highest_revenue_colors,
    top_color_per_year,
)
from orderstrata.plans.ingest import Tables
from orderstrata.plans.outcomes import Section
from orderstrata.plans.sizing import BROADCAST_BYTES, small_enough

# The questions as they are shown.
TOP_COLOR_QUESTION = "Which color generated the highest revenue each year?"
LEAD_TIME_QUESTION = "What is the average lead time for each product category?"
TOP_COLOR_TABLE = "report_top_color_by_year"
LEAD_TIME_TABLE = "report_avg_lead_time_by_category"
UNCATEGORISED_TABLE = "report_uncategorised_subcategories"


def sections(
    orders: DataFrame, products: DataFrame, broadcast_bytes: int = BROADCAST_BYTES
) -> list[Section]:
    """Both questions with lazy answers; each reads only the columns it needs.

    A product table measured as small goes to every executor and the order
    lines are not shuffled at all. Beyond that size the lines are summed per
    product first and only the sums are joined.
    """
    attributes = products.select("ProductID", "Color", "ProductCategoryName")
    if small_enough(attributes, broadcast_bytes):
        combined = orders.join(F.broadcast(attributes), "ProductID")
        colors, lead_times = highest_revenue_colors(combined), average_lead_times(combined)
    else:
        colors = top_color_per_year(color_revenue_of(orders, attributes))
        lead_times = average_lead_times_of(orders, attributes)
    return [
        Section(TOP_COLOR_QUESTION, colors, TOP_COLOR_TABLE),
        Section(LEAD_TIME_QUESTION, lead_times, LEAD_TIME_TABLE),
    ]


def report(tables: Tables, layers: Layers = SALES) -> list[Section]:
    return sections(tables.read(layers.published_orders), tables.read(layers.published_products))


def keep(tables: Tables, name: str, result: DataFrame) -> DataFrame:
    """``result`` as a table of that name, replaced if it is there; the table's rows."""
    tables.write_raw(name, result)
    return tables.read_raw(name)
