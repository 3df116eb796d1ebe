"""The run over all layers, from files to the report."""

from __future__ import annotations

from dataclasses import dataclass

from orderstrata.contracts import SALES, Layers
from orderstrata.plans.ingest import (
    Tables,
    create_tables,
    load_order_details,
    load_order_headers,
    load_products,
)
from orderstrata.plans.migrate import migrate_all
from orderstrata.plans.outcomes import Migrated, Published, Section, StageFailed
from orderstrata.plans.publish import publish_orders, publish_products
from orderstrata.plans.reporting import report


@dataclass(frozen=True)
class LayersRun:
    """Outcomes of a run that reached its end."""

    created: list[str]
    migrated: list[Migrated]
    products: Published
    orders: Published
    sections: list[Section]


def run_layers(
    tables: Tables,
    folder: str,
    layers: Layers = SALES,
    hold: bool = False,
    recreate: bool = True,
) -> LayersRun:
    """Fill every layer anew from the files in ``folder``.

    Raises :class:`StageFailed` at the first stage that does not succeed; the
    migrations count as one stage and are all tried. With ``hold``, rows that do not fit
    their contract are set aside with the reasons (``migrated[n].malformed``) and fail nothing.
    Without ``recreate``, tables that are there are not emptied first: a table whose stage
    fails, or is not reached, still has the rows of the last run.
    """
    created = create_tables(tables, layers.all(), missing_only=not recreate)
    if not created.success:
        done = ", ".join(created.created) or "none"
        raise StageFailed(f"creating tables (created: {done})") from created.error

    load_products(tables, folder)
    load_order_headers(tables, folder)
    load_order_details(tables, folder)

    migrated = migrate_all(tables, layers, hold)
    failures = [f"{m.table}: {m.error}" for m in migrated if not m.success]
    if failures:
        raise StageFailed("migrating " + "; ".join(failures))

    products = publish_products(tables, layers)
    if not products.success:
        raise StageFailed(f"publishing {products.table}") from products.error

    orders = publish_orders(tables, layers)
    if not orders.success:
        raise StageFailed(f"publishing {orders.table}") from orders.error

    return LayersRun(created.created, migrated, products, orders, report(tables, layers))
