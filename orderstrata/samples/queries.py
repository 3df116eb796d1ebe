"""Named queries over the sample tables: ``(spark, sf_dir) -> DataFrame``."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable
from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from orderstrata.contracts import SALES, Contract
from orderstrata.functions import business_days
from orderstrata.operators import dedupe, enrich, integrity, reports
from orderstrata.operators.clean import clean
from orderstrata.plans import ingest
from orderstrata.plans.layers import LayersRun, run_layers
from orderstrata.plans.outcomes import Section
from orderstrata.plans.reporting import sections
from orderstrata.plans.sizing import heavy_keys
from orderstrata.samples import tables as sample
from orderstrata.session import shared_folder
from orderstrata.sources import ParquetTables

Query = Callable[[SparkSession, str], DataFrame]
LAYERS = sample.LAYERS


# --- raw text to typed rows -------------------------------------------------


def clean_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(sample.raw_products(spark, sf_dir), LAYERS.products.schema)


def clean_order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(sample.raw_order_headers(spark, sf_dir), LAYERS.order_headers.schema)


def clean_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(sample.raw_order_details(spark, sf_dir), LAYERS.order_details.schema)


def declared_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The contracts as declared, with 32-bit identifiers."""
    return clean(sample.raw_products(spark, sf_dir), SALES.products.schema)


def declared_order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(sample.raw_order_headers(spark, sf_dir), SALES.order_headers.schema)


def declared_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clean(sample.raw_order_details(spark, sf_dir), SALES.order_details.schema)


def declared_published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.conform(published_orders(spark, sf_dir), SALES.published_orders)


# --- one row per key, and the rest --------------------------------------------


def kept_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.keep_one(clean_products(spark, sf_dir), "ProductID")


def kept_order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.keep_one(clean_order_headers(spark, sf_dir), "SalesOrderID")


def kept_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.keep_one(sample.order_details(spark, sf_dir), "SalesOrderDetailID")


def _surplus(df: DataFrame, key: str) -> DataFrame:
    """Rows that are not the one kept of their key, by the same numbering as those kept."""
    told = dedupe.marked(df, key, heavy_keys(df, [key])[key])
    return told.where("NOT kept").drop("kept")


def duplicate_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _surplus(clean_products(spark, sf_dir), "ProductID")


def duplicate_order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _surplus(clean_order_headers(spark, sf_dir), "SalesOrderID")


def duplicate_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _surplus(sample.order_details(spark, sf_dir), "SalesOrderDetailID")


def duplicate_details_numbered_apart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken for keys that very many rows have, here for the hundred largest."""
    details = sample.order_details(spark, sf_dir)
    counts = details.groupBy("SalesOrderDetailID").count()
    heavy = [r.SalesOrderDetailID for r in counts.orderBy(F.desc("count")).limit(100).collect()]
    told = dedupe.marked(details, "SalesOrderDetailID", heavy)
    return told.where("NOT kept").drop("kept")


def details_except_kept(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The duplicates once more, as the difference of two tables."""
    details = sample.order_details(spark, sf_dir)
    return details.exceptAll(dedupe.keep_one(details, "SalesOrderDetailID"))


# --- rules a contract declares --------------------------------------------------


def details_of_catalogued_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = clean_order_details(spark, sf_dir)
    return integrity.referenced(details, sample.catalogued_products(spark, sf_dir), "ProductID")


def orphaned_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    details = clean_order_details(spark, sf_dir)
    return integrity.orphans(details, sample.catalogued_products(spark, sf_dir), "ProductID")


def repeated_detail_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.repeated_keys(sample.order_details(spark, sf_dir), LAYERS.order_details)


def _shipped_orders() -> Contract:
    """Order headers of which a ship date is demanded."""
    headers = LAYERS.order_headers
    demanded = {"SalesOrderID", "ShipDate"}
    schema = [StructField(f.name, f.dataType, f.name not in demanded) for f in headers.schema]
    return replace(headers, name="shipped_orders", schema=StructType(schema))


def headers_missing_required(spark: SparkSession, sf_dir: str) -> DataFrame:
    return integrity.missing_required(sample.order_headers(spark, sf_dir), _shipped_orders())


def _with_told_reasons(rows: DataFrame) -> DataFrame:
    return rows.withColumn("reasons", F.array_join("reasons", "; "))


def malformed_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw products that their table does not take, as they are, with the reasons."""
    raw = sample.spoiled_products(spark, sf_dir)
    return _with_told_reasons(integrity.misfits(raw, LAYERS.products))


def malformed_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    raw = sample.spoiled_order_details(spark, sf_dir)
    return _with_told_reasons(integrity.misfits(raw, LAYERS.order_details))


def sorted_out_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Good and bad details in one frame: cleaned, NULL where a value does not fit."""
    raw = sample.spoiled_order_details(spark, sf_dir)
    return _with_told_reasons(integrity.sort_out(raw, LAYERS.order_details).drop("given"))


def products_with_unknown_units(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Promoted products are given in a unit that the contract does not know."""
    unit = F.when(F.col("ProductCategoryName") == "PROMO", "MM")
    products = sample.products(spark, sf_dir).withColumn(
        "SizeUnitMeasureCode", F.coalesce(unit, "SizeUnitMeasureCode")
    )
    return integrity.outside_domain(products, LAYERS.products)


# --- derived columns --------------------------------------------------------------


def business_day_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Business days from order to shipping of each line item; many ship before the order."""
    lines = sample.load(spark, sf_dir, "lineitem")
    orders = sample.load(spark, sf_dir, "orders")
    ordered, shipped = F.col("o_orderdate").cast("date"), F.col("l_shipdate").cast("date")
    return lines.join(orders, lines.l_orderkey == orders.o_orderkey).select(
        "l_orderkey",
        "l_linenumber",
        ordered.alias("order_date"),
        shipped.alias("ship_date"),
        business_days(ordered, shipped).alias("business_days"),
    )


def business_day_total(spark: SparkSession, sf_dir: str) -> DataFrame:
    return business_day_spans(spark, sf_dir).agg(
        F.count("business_days").alias("spans"), F.sum("business_days").alias("business_days")
    )


def product_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.product_master(sample.products(spark, sf_dir))


def uncategorised_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.without_category(product_master(spark, sf_dir))


def uncategorised_subcategories(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrich.one_per_subcategory(uncategorised_products(spark, sf_dir))


def published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = enrich.order_lines(
        sample.order_details(spark, sf_dir), sample.order_headers(spark, sf_dir)
    )
    return integrity.conform(lines.drop("SalesOrderID"), LAYERS.published_orders)


# --- reports ------------------------------------------------------------------------


def _sections(spark: SparkSession, sf_dir: str) -> list[Section]:
    return sections(published_orders(spark, sf_dir), product_master(spark, sf_dir))


def top_color_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sections(spark, sf_dir)[0].result


def avg_lead_time_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _sections(spark, sf_dir)[1].result


def color_revenue_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = published_orders(spark, sf_dir).join(product_master(spark, sf_dir), "ProductID")
    return reports.color_revenue(lines)


def color_revenue_summed_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when the product table is too large to broadcast."""
    return reports.color_revenue_of(
        published_orders(spark, sf_dir), product_master(spark, sf_dir)
    )


def avg_lead_time_summed_by_product(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The way taken when the product table is too large to broadcast."""
    return reports.average_lead_times_of(
        published_orders(spark, sf_dir), product_master(spark, sf_dir)
    )


# --- files, tables and the run over all layers ----------------------------------------


RAW_FILES = {
    ingest.PRODUCTS_FILE: sample.raw_products,
    ingest.ORDER_HEADERS_FILE: sample.raw_order_headers,
    ingest.ORDER_DETAILS_FILE: sample.raw_order_details,
}


# Rows of a CSV file at most, as one task reads a file that is packed.
ROWS_A_FILE = 1_000_000
_inputs: dict[tuple[str, str], str] = {}
_written: set[str] = set()


def input_files(spark: SparkSession, sf_dir: str, names: Iterable[str] = tuple(RAW_FILES)) -> str:
    """A shared folder with raw sample tables as CSV, each made once per session and size."""
    key = (spark.sparkContext.applicationId, sf_dir)
    folder = _inputs.setdefault(key, f"{shared_folder(spark)}/input-{uuid.uuid4().hex}")
    for name in names:
        path = f"{folder}/{name}"
        if path not in _written:
            _write_csv(RAW_FILES[name](spark, sf_dir), path)
            _written.add(path)
    return folder


def _write_csv(rows: DataFrame, path: str) -> None:
    blanks_kept = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False}
    packed = {
        "compression": "gzip",
        "zlib.compress.level": "BEST_SPEED",
        "maxRecordsPerFile": ROWS_A_FILE,
    }
    rows.write.mode("append").options(**packed).csv(path, header=True, **blanks_kept)


def _new_tables(spark: SparkSession) -> ParquetTables:
    return ParquetTables(spark, f"{shared_folder(spark)}/layers-{uuid.uuid4().hex}")


def bronze_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _new_tables(spark)
    ingest.load_products(tables, input_files(spark, sf_dir, [ingest.PRODUCTS_FILE]))
    return tables.read_raw(ingest.RAW_PRODUCTS)


def bronze_order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _new_tables(spark)
    ingest.load_order_headers(tables, input_files(spark, sf_dir, [ingest.ORDER_HEADERS_FILE]))
    return tables.read_raw(ingest.RAW_ORDER_HEADERS)


def bronze_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _new_tables(spark)
    ingest.load_order_details(tables, input_files(spark, sf_dir, [ingest.ORDER_DETAILS_FILE]))
    return tables.read_raw(ingest.RAW_ORDER_DETAILS)


def bronze_order_details_of_two_exports(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details in a folder of files that list the columns in two different orders."""
    folder = f"{shared_folder(spark)}/exports-{uuid.uuid4().hex}"
    path = f"{folder}/{ingest.ORDER_DETAILS_FILE}"
    details = sample.raw_order_details(spark, sf_dir)
    early = F.pmod(F.xxhash64(*details.columns), F.lit(2)) == 0
    _write_csv(details.where(early), path)
    _write_csv(details.where(~early).select(details.columns[::-1]), path)
    tables = _new_tables(spark)
    ingest.load_order_details(tables, folder)
    return tables.read_raw(ingest.RAW_ORDER_DETAILS).select(details.columns)


def _run(spark: SparkSession, sf_dir: str) -> tuple[LayersRun, ParquetTables]:
    tables = _new_tables(spark)
    return run_layers(tables, input_files(spark, sf_dir), LAYERS), tables


def layers_store_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)[1].read(LAYERS.products)


def layers_store_order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)[1].read(LAYERS.order_headers)


def layers_store_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _run(spark, sf_dir)[1].read(LAYERS.order_details)


def layers_rejected_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Details turned away for naming no known product."""
    return _run(spark, sf_dir)[0].migrated[2].rejected


def _run_of_spoiled(spark: SparkSession, sf_dir: str) -> tuple[LayersRun, ParquetTables]:
    """A run on files with malformed rows, which are held."""
    folder = f"{shared_folder(spark)}/spoiled-{uuid.uuid4().hex}"
    spoiled = {
        ingest.PRODUCTS_FILE: sample.spoiled_products,
        ingest.ORDER_HEADERS_FILE: sample.raw_order_headers,
        ingest.ORDER_DETAILS_FILE: sample.spoiled_order_details,
    }
    for name, rows in spoiled.items():
        _write_csv(rows(spark, sf_dir), f"{folder}/{name}")
    tables = _new_tables(spark)
    return run_layers(tables, folder, LAYERS, hold=True), tables


def layers_held_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products set aside by a run, as the file has them, with the reasons."""
    return _with_told_reasons(_run_of_spoiled(spark, sf_dir)[0].migrated[0].malformed)


def layers_held_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _with_told_reasons(_run_of_spoiled(spark, sf_dir)[0].migrated[2].malformed)


def layers_published_orders_beside_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a run publishes when it sets malformed rows aside."""
    return _run_of_spoiled(spark, sf_dir)[1].read(LAYERS.published_orders)


def layers_parts_beside_held(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each part of each store table, counted by the job that wrote them."""
    run, _ = _run_of_spoiled(spark, sf_dir)
    counts = [(m.table, part, rows) for m in run.migrated for part, rows in m.counts.items()]
    return spark.createDataFrame(counts, "table_name string, part string, row_count bigint")


def layers_created_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each typed table after a run, and once the tables are created anew."""
    _, tables = _run(spark, sf_dir)
    before = {c.name: tables.count(c) for c in LAYERS.all()}
    created = ingest.create_tables(tables, LAYERS.all()).created
    counts = [(c.name, before[c.name], tables.count(c)) for c in LAYERS.all() if c.name in created]
    return spark.createDataFrame(counts, "table_name string, rows_before bigint, rows_after bigint")


def layers_published_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = _run(spark, sf_dir)
    return tables.read(LAYERS.published_products)


def layers_published_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    _, tables = _run(spark, sf_dir)
    return tables.read(LAYERS.published_orders)


def layers_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of each typed table, and duplicates found on the way to the store."""
    run, _ = _run(spark, sf_dir)
    outcomes = (*run.migrated, run.products, run.orders)
    counts = [(outcome.table, outcome.rows) for outcome in outcomes]
    counts += [(f"{m.table} duplicates", m.duplicates.count()) for m in run.migrated]
    return spark.createDataFrame(counts, "table_name string, row_count bigint")


def layers_top_color_by_year(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, _ = _run(spark, sf_dir)
    return run.sections[0].result


def layers_avg_lead_time_by_category(spark: SparkSession, sf_dir: str) -> DataFrame:
    run, _ = _run(spark, sf_dir)
    return run.sections[1].result


QUERIES: dict[str, Query] = {
    query.__name__: query
    for query in (
        top_color_by_year,
        avg_lead_time_by_category,
        color_revenue_by_year,
        color_revenue_summed_by_product,
        avg_lead_time_summed_by_product,
        clean_products,
        clean_order_headers,
        clean_order_details,
        declared_products,
        declared_order_headers,
        declared_order_details,
        declared_published_orders,
        kept_products,
        kept_order_headers,
        kept_order_details,
        duplicate_products,
        duplicate_order_headers,
        duplicate_order_details,
        duplicate_details_numbered_apart,
        details_except_kept,
        details_of_catalogued_products,
        orphaned_details,
        repeated_detail_keys,
        malformed_products,
        malformed_order_details,
        sorted_out_order_details,
        headers_missing_required,
        products_with_unknown_units,
        business_day_spans,
        business_day_total,
        product_master,
        uncategorised_products,
        uncategorised_subcategories,
        published_orders,
        bronze_products,
        bronze_order_headers,
        bronze_order_details,
        bronze_order_details_of_two_exports,
        layers_store_products,
        layers_store_order_headers,
        layers_store_order_details,
        layers_rejected_details,
        layers_held_products,
        layers_held_details,
        layers_published_orders_beside_held,
        layers_parts_beside_held,
        layers_created_again,
        layers_published_products,
        layers_published_orders,
        layers_row_counts,
        layers_top_color_by_year,
        layers_avg_lead_time_by_category,
    )
}
