"""Store layer to publish layer."""

from __future__ import annotations

from orderstrata.contracts import SALES, Layers
from orderstrata.operators.enrich import order_lines, product_master, without_category
from orderstrata.plans.ingest import Tables
from orderstrata.plans.outcomes import Published


def publish_products(tables: Tables, layers: Layers = SALES) -> Published:
    target = layers.published_products
    try:
        rows = tables.write(target, product_master(tables.read(layers.products)))
        published = tables.read(target)
        return Published(target.name, rows=rows, uncategorised=without_category(published))
    except Exception as error:
        return Published(target.name, error=error)


def publish_orders(tables: Tables, layers: Layers = SALES) -> Published:
    target = layers.published_orders
    try:
        stored = tables.read_for_join(layers.order_details, layers.order_headers)
        rows = tables.write(target, order_lines(*stored).drop("SalesOrderID"))
        return Published(target.name, rows=rows)
    except Exception as error:
        return Published(target.name, error=error)
