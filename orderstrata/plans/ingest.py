"""Files to raw tables, and empty typed tables to fill."""

from __future__ import annotations

from collections.abc import Iterable

from orderstrata.contracts import Contract, Layers
from orderstrata.plans.outcomes import TablesCreated
from orderstrata.sources import (
    JdbcTables,
    ParquetTables,
    read_alike,
    read_csv,
    tells_of_headers,
)

Tables = ParquetTables | JdbcTables

# Names of the raw tables and of the files they come from.
RAW_PRODUCTS = "raw_products"
RAW_ORDER_HEADERS = "raw_sales_order_header"
RAW_ORDER_DETAILS = "raw_sales_order_detail"
PRODUCTS_FILE = "products.csv"
ORDER_HEADERS_FILE = "sales_order_header.csv"
ORDER_DETAILS_FILE = "sales_order_detail.csv"


def keys_of(layers: Layers) -> dict[str, str]:
    """The key of each table of all layers, raw ones included."""
    raw = {
        RAW_PRODUCTS: layers.products,
        RAW_ORDER_HEADERS: layers.order_headers,
        RAW_ORDER_DETAILS: layers.order_details,
    }
    typed = {contract.name: contract for contract in layers.all()}
    return {name: contract.key for name, contract in {**raw, **typed}.items()}


def create_tables(
    tables: Tables, contracts: Iterable[Contract], missing_only: bool = False
) -> TablesCreated:
    """Create the tables empty, in order, until one fails; with ``missing_only`` those not there."""
    created: list[str] = []
    try:
        for contract in contracts:
            if missing_only and tables.exists(contract):
                continue
            tables.create(contract)
            created.append(contract.name)
    except Exception as error:
        return TablesCreated(created, error)
    return TablesCreated(created)


def _load(tables: Tables, folder: str, file: str, raw_table: str) -> None:
    """Files are taken to have one header; only if tasks find that they don't, all are looked at."""
    path = f"{folder.rstrip('/')}/{file}"
    try:
        tables.write_raw(raw_table, read_alike(tables.spark, path))
    except Exception as error:
        if not tells_of_headers(error):
            raise
        tables.write_raw(raw_table, read_csv(tables.spark, path))


def load_products(tables: Tables, folder: str) -> None:
    _load(tables, folder, PRODUCTS_FILE, RAW_PRODUCTS)


def load_order_headers(tables: Tables, folder: str) -> None:
    _load(tables, folder, ORDER_HEADERS_FILE, RAW_ORDER_HEADERS)


def load_order_details(tables: Tables, folder: str) -> None:
    _load(tables, folder, ORDER_DETAILS_FILE, RAW_ORDER_DETAILS)
