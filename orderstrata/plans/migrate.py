"""Raw tables to the store layer: clean, check references, keep one row per key."""

from __future__ import annotations

from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from orderstrata.contracts import SALES, Contract, Layers
from orderstrata.operators.clean import clean
from orderstrata.operators.dedupe import marked, marked_in_place, torn_keys
from orderstrata.operators.integrity import sort_out
from orderstrata.plans.ingest import (
    RAW_ORDER_DETAILS,
    RAW_ORDER_HEADERS,
    RAW_PRODUCTS,
    Tables,
)
from orderstrata.plans.outcomes import Migrated
from orderstrata.plans.sizing import heavy_keys, small_enough
from orderstrata.sources.parts import DUPLICATE, KEPT, MALFORMED, PART, REJECTED, Layout


def _cleaned(raw: DataFrame, contract: Contract, hold: bool) -> DataFrame:
    """Raw rows, cleaned, with ``fits``; one that does not fit fails the job if it is not held."""
    if hold:
        return sort_out(raw, contract).withColumn("fits", F.size("reasons") == 0)
    return clean(raw, contract.schema).withColumn("fits", F.lit(True))


def _with_known(rows: DataFrame, known: DataFrame) -> DataFrame:
    """Rows with ``known``: whether the one column of ``known``, unique there, has their value."""
    met = rows.join(known.withColumn("known", F.lit(True)), known.columns, "left")
    return met.select(*rows.columns, F.coalesce("known", F.lit(False)).alias("known"))


def _told(
    rows: DataFrame, contract: Contract, heavy: dict[str, list], layout: Layout | None
) -> tuple[DataFrame, bool]:
    """Rows with ``kept``, and whether they lie as the layout says.

    Where the layout lets rows of a key be told apart in its buckets, they are shuffled once,
    for both; else by their key, and once more when they are written.
    """
    key, among = contract.key, F.col("fits") & F.col("known")
    first = next(name for name in contract.columns if name != key)
    if layout is None or layout.column not in (key, first) or heavy[layout.column]:
        return marked(rows, key, heavy[key], contract.columns, among), False
    torn = False
    if layout.column != key:
        # looked for among all rows, which reads two columns; rows without a key can't be kept
        keyed = rows.dropna(subset=[key]) if key in contract.required else rows
        torn = not torn_keys(keyed, key, layout.column).isEmpty()
    spread = layout.spread(rows, ~F.col("fits"))
    column, buckets = layout.column, layout.buckets
    return marked_in_place(spread, key, column, buckets, contract.columns, among, torn), True


def _migrate(
    tables: Tables,
    raw_table: str,
    contract: Contract,
    known: Callable[[], DataFrame] | None = None,
    hold: bool = False,
    layout: Layout | None = None,
) -> Migrated:
    """One write, of which all parts are counted on the way.

    Keys and orders that very many rows share are looked for first: rows of such a key are
    numbered apart, and a table with such an order is not put into buckets.
    """
    try:
        rows = _cleaned(tables.read_raw(raw_table), contract, hold)
        by = {contract.key} | ({layout.column} if layout else set())
        heavy = heavy_keys(rows, sorted(by))
        if layout and layout.column != contract.key and heavy[layout.column]:
            layout = None
        rows = _with_known(rows, known()) if known else rows.withColumn("known", F.lit(True))
        told, placed = _told(rows, contract, heavy, layout)
        part = F.when(~F.col("fits"), MALFORMED).when(~F.col("known"), REJECTED)
        part = part.when(F.col("kept"), KEPT).otherwise(DUPLICATE)
        told = told.withColumn(PART, part).drop("fits", "known", "kept")
        written = tables.write_parts(contract, told, layout, placed)
        frames = {part: frame.select(contract.columns) for part, frame in written.frames.items()}
        held = written.frames[MALFORMED].select("given.*", "reasons") if hold else None
        return Migrated(
            contract.name,
            rows=written.rows[KEPT],
            duplicates=frames[DUPLICATE],
            rejected=frames[REJECTED] if known else None,
            malformed=held,
            counts=written.rows,
        )
    except Exception as error:
        return Migrated(contract.name, error=str(error))


def migrate_products(tables: Tables, layers: Layers = SALES, hold: bool = False) -> Migrated:
    return _migrate(tables, RAW_PRODUCTS, layers.products, hold=hold)


def _by_order(tables: Tables) -> Layout:
    """Headers and lines alike, so that joining them moves neither."""
    return Layout("SalesOrderID", int(tables.spark.conf.get("spark.sql.shuffle.partitions")))


def migrate_order_headers(tables: Tables, layers: Layers = SALES, hold: bool = False) -> Migrated:
    layout = _by_order(tables)
    return _migrate(tables, RAW_ORDER_HEADERS, layers.order_headers, hold=hold, layout=layout)


def migrate_order_details(tables: Tables, layers: Layers = SALES, hold: bool = False) -> Migrated:
    """Details of products already in the store; the others are left out."""

    def known_products() -> DataFrame:
        known = tables.read(layers.products).select("ProductID")
        return F.broadcast(known) if small_enough(known) else known

    return _migrate(
        tables, RAW_ORDER_DETAILS, layers.order_details, known_products, hold, _by_order(tables)
    )


def migrate_all(tables: Tables, layers: Layers = SALES, hold: bool = False) -> list[Migrated]:
    """Every migration; a failed one does not stop the others.

    Products and headers have nothing to do with one another and go side by side, each in a
    scheduler pool named like its table (of use where ``spark.scheduler.mode`` is FAIR);
    details are held against the products stored and come after these. With ``hold``,
    rows that a contract does not take are set aside with the reasons, instead of failing
    their migration.
    """

    def run(step: Callable[..., Migrated], contract: Contract) -> Migrated:
        context = tables.spark.sparkContext
        pool = context.getLocalProperty("spark.scheduler.pool")
        context.setLocalProperty("spark.scheduler.pool", contract.name)
        try:
            return step(tables, layers, hold)
        finally:
            context.setLocalProperty("spark.scheduler.pool", pool)

    with ThreadPoolExecutor(max_workers=1) as beside:
        headers = beside.submit(
            inheritable_thread_target(tables.spark)(run), migrate_order_headers, layers.order_headers
        )
        products = run(migrate_products, layers.products)
        details = run(migrate_order_details, layers.order_details)
        return [products, headers.result(), details]
