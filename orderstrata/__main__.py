"""``python -m orderstrata INPUT_FOLDER STORE``: run every layer, keep and show the report."""

from __future__ import annotations

import argparse

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orderstrata.contracts import SALES
from orderstrata.operators.enrich import one_per_subcategory
from orderstrata.plans import ingest
from orderstrata.plans.layers import run_layers
from orderstrata.plans.reporting import UNCATEGORISED_TABLE, keep
from orderstrata.session import build_session, size_for
from orderstrata.sources import JdbcTables, ParquetTables, data_files
from orderstrata.sources.parts import MALFORMED

# Rows of a result that are printed; the table it is kept in has them all.
SHOWN_ROWS = 1000
# Tables of rows that were set aside are named like the table they were meant for, after this.
HELD_PREFIX = "held_"
FILES = (ingest.PRODUCTS_FILE, ingest.ORDER_HEADERS_FILE, ingest.ORDER_DETAILS_FILE)


def _told() -> Column:
    return F.array_join("reasons", "; ")


def _show(title: str, table: str, result: DataFrame) -> None:
    print(f"\n{title}")
    result.show(SHOWN_ROWS, truncate=False)
    rows = result.count()
    if rows > SHOWN_ROWS:
        print(f"{rows - SHOWN_ROWS} more rows in {table}")


def main() -> None:
    parser = argparse.ArgumentParser(prog="orderstrata", description=__doc__)
    parser.add_argument("folder", help="folder with the three CSV files")
    parser.add_argument("store", help="folder for the tables, shared by all executors, or jdbc: URL")
    parser.add_argument("--wide-ids", action="store_true", help="64-bit identifiers")
    parser.add_argument(
        "--largest-bytes", type=int, help="size of the largest table; else that of the input files"
    )
    parser.add_argument(
        "--jdbc-option", action="append", default=[], metavar="NAME=VALUE", help="user, driver, ..."
    )
    parser.add_argument(
        "--hold-malformed",
        action="store_true",
        help="set rows that do not fit their table aside, with the reasons, instead of failing",
    )
    parser.add_argument(
        "--keep-until-replaced",
        action="store_true",
        help="don't empty the tables first: they have their old rows until new ones are all written",
    )
    parser.add_argument(
        "--jdbc-parts",
        type=int,
        default=16,
        help="tasks that read a database table, parted by its key as the database tells",
    )
    args = parser.parse_args()

    spark = build_session()
    folder = args.folder.rstrip("/")
    sizes = [sum(data_files(spark, f"{folder}/{name}").values()) for name in FILES]
    size_for(spark, args.largest_bytes or max(sizes))
    layers = SALES.widened() if args.wide_ids else SALES
    if args.store.startswith("jdbc:"):
        options = dict(option.split("=", 1) for option in args.jdbc_option)
        keys = ingest.keys_of(layers)
        tables = JdbcTables(spark, args.store, options, keys=keys, parts=args.jdbc_parts)
    else:
        tables = ParquetTables(spark, args.store)
    run = run_layers(
        tables, folder, layers, hold=args.hold_malformed, recreate=not args.keep_until_replaced
    )
    for outcome in (*run.migrated, run.products, run.orders):
        print(f"{outcome.table}: {outcome.rows} rows")
    for migrated in run.migrated:
        if migrated.counts[MALFORMED]:
            table = f"{HELD_PREFIX}{migrated.table}"
            print(f"{migrated.counts[MALFORMED]} malformed rows, with the reasons, in {table}")
            keep(tables, table, migrated.malformed.withColumn("reasons", _told()))
    if not run.products.uncategorised.isEmpty():
        listed = keep(
            tables, UNCATEGORISED_TABLE, one_per_subcategory(run.products.uncategorised)
        )
        _show("Subcategories without a product category", UNCATEGORISED_TABLE, listed)
    for section in run.sections:
        _show(section.question, section.table, keep(tables, section.table, section.result))


if __name__ == "__main__":
    main()
