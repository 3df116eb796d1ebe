"""For each sample query the SQL that gives the same rows from the same tables."""

from __future__ import annotations

from orderstrata.contracts import SALES
from orderstrata.samples.tables import LAYERS

# --- common table expressions ---------------------------------------------------

PRODUCTS = """
products AS (
  SELECT p_partkey AS ProductID,
         p_name AS ProductDesc,
         p_brand || '-' || CAST(p_partkey AS VARCHAR) AS ProductNumber,
         p_type IN ('STANDARD', 'ECONOMY') AS MakeFlag,
         nullif(split_part(p_name, ' ', 1), 'new') AS Color,
         p_size * 20 AS SafetyStockLevel,
         p_size * 15 AS ReorderPoint,
         CAST(CAST(p_retailprice AS DECIMAL(19,4)) - p_size AS DECIMAL(19,4)) AS StandardCost,
         CAST(p_retailprice AS DECIMAL(19,4)) AS ListPrice,
         CAST(p_size AS VARCHAR) AS Size,
         CASE p_type WHEN 'SMALL' THEN 'CM' WHEN 'MEDIUM' THEN 'IN' WHEN 'LARGE' THEN 'FT' END
           AS SizeUnitMeasureCode,
         CAST(p_size AS DECIMAL(19,4)) AS Weight,
         CASE WHEN p_size < 25 THEN 'G' ELSE 'LB' END AS WeightUnitMeasureCode,
         CASE WHEN p_type IN ('PROMO', 'SMALL') THEN p_type END AS ProductCategoryName,
         CASE split_part(p_name, ' ', 2)
           WHEN 'anvil' THEN 'Road Frames' WHEN 'bolt' THEN 'Gloves' WHEN 'gear' THEN 'Helmets'
           WHEN 'gizmo' THEN 'Wheels' WHEN 'plate' THEN 'Chains' WHEN 'ring' THEN 'Pumps'
           WHEN 'widget' THEN 'Socks' END AS ProductSubCategoryName
  FROM part)"""

HEADERS = """
headers AS (
  SELECT o_orderkey AS SalesOrderID,
         CAST(o_orderdate AS DATE) AS OrderDate,
         CASE WHEN o_orderstatus <> 'O'
              THEN CAST(o_orderdate AS DATE) + CAST(day(o_orderdate) - 3 AS INTEGER) END
           AS ShipDate,
         o_orderpriority IN ('1-URGENT', '2-HIGH') AS OnlineOrderFlag,
         'AC-' || CAST(o_custkey AS VARCHAR) AS AccountNumber,
         o_custkey AS CustomerID,
         CASE WHEN o_orderpriority NOT IN ('1-URGENT', '2-HIGH') THEN o_custkey END
           AS SalesPersonID,
         CAST(o_totalprice AS DECIMAL(19,4)) AS Freight
  FROM orders)"""

DETAILS = """
details AS (
  SELECT l_orderkey AS SalesOrderID,
         l_orderkey * 10 + l_linenumber AS SalesOrderDetailID,
         CAST(l_quantity AS INTEGER) AS OrderQty,
         l_partkey AS ProductID,
         CAST(l_extendedprice AS DECIMAL(19,4)) AS UnitPrice,
         CAST(l_discount AS DECIMAL(19,4)) AS UnitPriceDiscount
  FROM lineitem)"""

# Names of the subcategories and of the categories they belong to.
MASTER_COLUMNS = """
         ProductID, ProductDesc, ProductNumber, MakeFlag,
         CASE WHEN Color IS NULL THEN 'N/A' ELSE Color END AS Color,
         SafetyStockLevel, ReorderPoint, StandardCost, ListPrice, Size, SizeUnitMeasureCode,
         Weight, WeightUnitMeasureCode,
         CASE WHEN ProductCategoryName IS NOT NULL THEN ProductCategoryName
              WHEN ProductSubCategoryName IN ('Gloves', 'Shorts', 'Socks', 'Tights', 'Vests')
                THEN 'Clothing'
              WHEN ProductSubCategoryName IN
                   ('Locks', 'Lights', 'Headsets', 'Helmets', 'Pedals', 'Pumps')
                THEN 'Accessories'
              WHEN ProductSubCategoryName LIKE '%Frames%'
                   OR ProductSubCategoryName IN ('Wheels', 'Saddles')
                THEN 'Components' END AS ProductCategoryName,
         ProductSubCategoryName"""


def _master(source: str) -> str:
    return f"\nmaster AS (SELECT {MASTER_COLUMNS} FROM {source})"


def _business_days(start: str, end: str) -> str:
    """The days of the span listed and the weekdays among them counted, less one."""
    days = f"generate_series(least({start}, {end}), greatest({start}, {end}), INTERVAL 1 DAY)"
    weekdays = f"len([day FOR day IN {days} IF isodow(day) < 6])"
    return (
        f"CASE WHEN {start} IS NOT NULL AND {end} IS NOT NULL"
        f" THEN CAST({weekdays} - 1 AS INTEGER) END"
    )


def _published(details: str, headers: str) -> str:
    return f"""
published AS (
  SELECT SalesOrderDetailID, OrderQty, ProductID, UnitPrice, UnitPriceDiscount,
         OrderDate, ShipDate, OnlineOrderFlag, AccountNumber, CustomerID, SalesPersonID,
         Freight AS TotalOrderFreight,
         {_business_days("OrderDate", "ShipDate")} AS LeadTimeInBusinessDays,
         CAST(OrderQty * (UnitPrice - UnitPriceDiscount) AS DECIMAL(19,4))
           AS TotalLineExtendedPrice
  FROM {details} JOIN {headers} USING (SalesOrderID))"""


COLOR_REVENUE = """
revenue AS (
  SELECT CAST(year(OrderDate) AS INTEGER) AS OrderYear, Color,
         CAST(sum(TotalLineExtendedPrice) AS DECIMAL(38,4)) AS TotalRevenue
  FROM published JOIN master USING (ProductID) GROUP BY 1, 2)"""

TOP_COLOR = """
SELECT OrderYear, Color, TotalRevenue
FROM (SELECT *, row_number() OVER (PARTITION BY OrderYear
             ORDER BY TotalRevenue DESC NULLS LAST, Color ASC NULLS FIRST) AS place FROM revenue)
WHERE place = 1"""

LEAD_TIME = """
SELECT ProductCategoryName, avg(LeadTimeInBusinessDays) AS AvgLeadTime
FROM published JOIN master USING (ProductID) GROUP BY 1"""


# Raw tables: padded text. Cleaned tables: trimmed and cast back.

SQL_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "string": "VARCHAR",
    "decimal(19,4)": "DECIMAL(19,4)",
}


def _padded(contract, name: str, source: str) -> str:
    columns = ", ".join(f"'  ' || CAST({c} AS VARCHAR) || ' ' AS {c}" for c in contract.columns)
    return f"\n{name} AS (SELECT {columns} FROM ({source}))"


def _cleaned(contract, name: str, source: str) -> str:
    columns = ", ".join(
        f"CAST(trim({f.name}) AS {SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}"
        for f in contract.schema.fields
    )
    return f"\n{name} AS (SELECT {columns} FROM {source})"


RAW_PRODUCTS = _padded(
    LAYERS.products,
    "raw_products",
    """SELECT * FROM products UNION ALL
       SELECT * REPLACE (CAST(ListPrice - 10 AS DECIMAL(19,4)) AS ListPrice)
       FROM products WHERE ProductCategoryName = 'PROMO'""",
)
RAW_HEADERS = _padded(
    LAYERS.order_headers,
    "raw_headers",
    "SELECT * FROM headers UNION ALL SELECT * FROM headers WHERE OnlineOrderFlag",
)
RAW_DETAILS = _padded(
    LAYERS.order_details,
    "raw_details",
    """SELECT * REPLACE (CASE WHEN UnitPrice >= 10000 THEN ProductID END AS ProductID,
                         CAST(UnitPrice AS VARCHAR) || '5' AS UnitPrice) FROM details""",
)
# The same with values that their tables do not take, and why not.
SPOILED_PRODUCTS = """
spoiled_products AS (
  SELECT * REPLACE (CASE WHEN spoiled THEN ' OZ ' ELSE WeightUnitMeasureCode END
                      AS WeightUnitMeasureCode,
                    CASE WHEN spoiled THEN 'free' ELSE ListPrice END AS ListPrice),
         CASE WHEN spoiled THEN 'ListPrice does not take free; WeightUnitMeasureCode does not allow OZ'
              ELSE '' END AS reasons
  FROM (SELECT *, CAST(trim(ProductID) AS BIGINT) % 7 = 0 AS spoiled FROM raw_products))"""
SPOILED_DETAILS = """
spoiled_details AS (
  SELECT * EXCLUDE (o, words, digits) REPLACE (
           CASE WHEN o % 11 = 0 THEN words ELSE OrderQty END AS OrderQty,
           CASE WHEN o % 13 <> 0 THEN SalesOrderDetailID END AS SalesOrderDetailID,
           CASE WHEN o % 17 = 0 THEN digits ELSE UnitPrice END AS UnitPrice),
         concat_ws('; ',
           CASE WHEN o % 13 = 0 THEN 'SalesOrderDetailID is empty' END,
           CASE WHEN o % 11 = 0 THEN 'OrderQty does not take ' || words END,
           CASE WHEN o % 17 = 0 THEN 'UnitPrice does not take ' || digits END) AS reasons
  FROM (SELECT *, CAST(trim(SalesOrderID) AS BIGINT) AS o, ' about' || OrderQty AS words,
               '12345678901234567890' || trim(UnitPrice) AS digits FROM raw_details))"""


def _sorted_out(contract, name: str, source: str) -> str:
    columns = ", ".join(
        f"TRY_CAST(trim({f.name}) AS {SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}"
        for f in contract.schema.fields
    )
    return f"\n{name} AS (SELECT {columns}, reasons FROM {source})"


CLEAN_PRODUCTS = _cleaned(LAYERS.products, "clean_products", "raw_products")
CLEAN_HEADERS = _cleaned(LAYERS.order_headers, "clean_headers", "raw_headers")
CLEAN_DETAILS = _cleaned(LAYERS.order_details, "clean_details", "raw_details")

CATALOGUED = """
catalogued AS (
  SELECT ProductID FROM products
  WHERE SizeUnitMeasureCode IS NOT NULL OR ProductCategoryName IS NOT NULL)"""


def _numbered(contract, name: str, source: str) -> str:
    """Rows numbered within their key; the first is the one that is kept."""
    others = ", ".join(f"{c} ASC NULLS FIRST" for c in contract.columns if c != contract.key)
    return (
        f"\n{name} AS (SELECT *, row_number() OVER "
        f"(PARTITION BY {contract.key} ORDER BY {others}) AS place FROM {source})"
    )


def _select(contract, source: str, condition: str = "TRUE") -> str:
    return f"\nSELECT {', '.join(contract.columns)} FROM {source} WHERE {condition}"


def _query(*parts: str) -> str:
    *ctes, body = parts
    return ("WITH " + ",".join(ctes) if ctes else "") + body


# The run over all layers: clean, drop details of unknown products, keep one row per key.
STORE = (
    PRODUCTS,
    RAW_PRODUCTS,
    CLEAN_PRODUCTS,
    _numbered(LAYERS.products, "numbered_products", "clean_products"),
    "\nstore_products AS (" + _select(LAYERS.products, "numbered_products", "place = 1") + ")",
    HEADERS,
    RAW_HEADERS,
    CLEAN_HEADERS,
    _numbered(LAYERS.order_headers, "numbered_headers", "clean_headers"),
    "\nstore_headers AS (" + _select(LAYERS.order_headers, "numbered_headers", "place = 1") + ")",
    DETAILS,
    RAW_DETAILS,
    CLEAN_DETAILS,
    "\nvalid_details AS (SELECT * FROM clean_details d WHERE EXISTS"
    " (SELECT 1 FROM store_products p WHERE p.ProductID = d.ProductID))",
    _numbered(LAYERS.order_details, "numbered_details", "valid_details"),
    "\nstore_details AS (" + _select(LAYERS.order_details, "numbered_details", "place = 1") + ")",
)
LAYERED = (*STORE, _master("store_products"), _published("store_details", "store_headers"))

# The run on spoiled files: what fits goes on as above, the rest is held.
HELD = (
    PRODUCTS,
    RAW_PRODUCTS,
    SPOILED_PRODUCTS,
    _sorted_out(LAYERS.products, "told_products", "spoiled_products"),
    _numbered(LAYERS.products, "numbered_products", "told_products WHERE reasons = ''"),
    "\nstore_products AS (" + _select(LAYERS.products, "numbered_products", "place = 1") + ")",
    HEADERS,
    RAW_HEADERS,
    CLEAN_HEADERS,
    _numbered(LAYERS.order_headers, "numbered_headers", "clean_headers"),
    "\nstore_headers AS (" + _select(LAYERS.order_headers, "numbered_headers", "place = 1") + ")",
    DETAILS,
    RAW_DETAILS,
    SPOILED_DETAILS,
    _sorted_out(LAYERS.order_details, "told_details", "spoiled_details"),
    "\nfitting_details AS (SELECT d.*, EXISTS (SELECT 1 FROM store_products p"
    " WHERE p.ProductID = d.ProductID) AS known FROM told_details d WHERE reasons = '')",
    _numbered(LAYERS.order_details, "numbered_details", "fitting_details WHERE known"),
    "\nstore_details AS (" + _select(LAYERS.order_details, "numbered_details", "place = 1") + ")",
    _published("store_details", "store_headers"),
)

DIRECT = (
    PRODUCTS,
    HEADERS,
    DETAILS,
    _master("products"),
    _published("details", "headers"),
)

SPANS = f"""
spans AS (
  SELECT l_orderkey, l_linenumber,
         CAST(o_orderdate AS DATE) AS order_date, CAST(l_shipdate AS DATE) AS ship_date
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey),
counted AS (
  SELECT *, {_business_days("order_date", "ship_date")} AS business_days FROM spans)"""


def _declared(contract, *parts: str) -> str:
    """The last part's rows in the contract's columns and types."""
    columns = ", ".join(
        f"CAST({f.name} AS {SQL_TYPES[f.dataType.simpleString()]}) AS {f.name}"
        for f in contract.schema.fields
    )
    *ctes, source = parts
    return _query(*ctes, f"\nSELECT {columns} FROM {source}")


def _before_and_after(name: str, source: str) -> str:
    return (
        f"SELECT '{name}' AS table_name, count(*) AS rows_before,"
        f" CAST(0 AS BIGINT) AS rows_after FROM {source}"
    )


def _part(table: str, part: str, source: str) -> str:
    return (
        f"SELECT '{table}' AS table_name, '{part}' AS part, count(*) AS row_count FROM {source}"
    )


def _parts(table: str, numbered: str, rejected: str, malformed: str) -> list[str]:
    return [
        _part(table, "kept", f"{numbered} WHERE place = 1"),
        _part(table, "duplicate", f"{numbered} WHERE place > 1"),
        _part(table, "rejected", rejected),
        _part(table, "malformed", malformed),
    ]


NOBODY = "(SELECT 1 WHERE FALSE)"


def _count(name: str, source: str, condition: str = "TRUE") -> str:
    return f"SELECT '{name}' AS table_name, count(*) AS row_count FROM {source} WHERE {condition}"


ORACLE_SQL: dict[str, str] = {
    "top_color_by_year": _query(*DIRECT, COLOR_REVENUE, TOP_COLOR),
    "color_revenue_by_year": _query(*DIRECT, COLOR_REVENUE, "\nSELECT * FROM revenue"),
    "avg_lead_time_by_category": _query(*DIRECT, LEAD_TIME),
    "color_revenue_summed_by_product": _query(
        *DIRECT, COLOR_REVENUE, "\nSELECT * FROM revenue"
    ),
    "avg_lead_time_summed_by_product": _query(*DIRECT, LEAD_TIME),
    "clean_products": _query(
        PRODUCTS, RAW_PRODUCTS, CLEAN_PRODUCTS, "\nSELECT * FROM clean_products"
    ),
    "clean_order_headers": _query(
        HEADERS, RAW_HEADERS, CLEAN_HEADERS, "\nSELECT * FROM clean_headers"
    ),
    "clean_order_details": _query(
        DETAILS, RAW_DETAILS, CLEAN_DETAILS, "\nSELECT * FROM clean_details"
    ),
    "declared_products": _declared(
        SALES.products, PRODUCTS, RAW_PRODUCTS, CLEAN_PRODUCTS, "clean_products"
    ),
    "declared_order_headers": _declared(
        SALES.order_headers, HEADERS, RAW_HEADERS, CLEAN_HEADERS, "clean_headers"
    ),
    "declared_order_details": _declared(
        SALES.order_details, DETAILS, RAW_DETAILS, CLEAN_DETAILS, "clean_details"
    ),
    "declared_published_orders": _declared(SALES.published_orders, *DIRECT, "published"),
    "kept_products": _query(
        PRODUCTS,
        RAW_PRODUCTS,
        CLEAN_PRODUCTS,
        _numbered(LAYERS.products, "numbered", "clean_products"),
        _select(LAYERS.products, "numbered", "place = 1"),
    ),
    "kept_order_headers": _query(
        HEADERS,
        RAW_HEADERS,
        CLEAN_HEADERS,
        _numbered(LAYERS.order_headers, "numbered", "clean_headers"),
        _select(LAYERS.order_headers, "numbered", "place = 1"),
    ),
    "kept_order_details": _query(
        DETAILS,
        _numbered(LAYERS.order_details, "numbered", "details"),
        _select(LAYERS.order_details, "numbered", "place = 1"),
    ),
    "duplicate_products": _query(
        PRODUCTS,
        RAW_PRODUCTS,
        CLEAN_PRODUCTS,
        _numbered(LAYERS.products, "numbered", "clean_products"),
        _select(LAYERS.products, "numbered", "place > 1"),
    ),
    "duplicate_order_headers": _query(
        HEADERS,
        RAW_HEADERS,
        CLEAN_HEADERS,
        _numbered(LAYERS.order_headers, "numbered", "clean_headers"),
        _select(LAYERS.order_headers, "numbered", "place > 1"),
    ),
    "duplicate_order_details": _query(
        DETAILS,
        _numbered(LAYERS.order_details, "numbered", "details"),
        _select(LAYERS.order_details, "numbered", "place > 1"),
    ),
    "duplicate_details_numbered_apart": _query(
        DETAILS,
        _numbered(LAYERS.order_details, "numbered", "details"),
        _select(LAYERS.order_details, "numbered", "place > 1"),
    ),
    "malformed_products": _query(
        PRODUCTS,
        RAW_PRODUCTS,
        SPOILED_PRODUCTS,
        "\nSELECT * EXCLUDE (spoiled) FROM spoiled_products WHERE reasons <> ''",
    ),
    "malformed_order_details": _query(
        DETAILS,
        RAW_DETAILS,
        SPOILED_DETAILS,
        "\nSELECT * FROM spoiled_details WHERE reasons <> ''",
    ),
    "sorted_out_order_details": _query(
        DETAILS,
        RAW_DETAILS,
        SPOILED_DETAILS,
        _sorted_out(LAYERS.order_details, "told_details", "spoiled_details"),
        "\nSELECT * FROM told_details",
    ),
    "layers_held_products": _query(
        PRODUCTS,
        RAW_PRODUCTS,
        SPOILED_PRODUCTS,
        "\nSELECT * EXCLUDE (spoiled) FROM spoiled_products WHERE reasons <> ''",
    ),
    "layers_held_details": _query(
        DETAILS,
        RAW_DETAILS,
        SPOILED_DETAILS,
        "\nSELECT * FROM spoiled_details WHERE reasons <> ''",
    ),
    "layers_published_orders_beside_held": _query(*HELD, "\nSELECT * FROM published"),
    "layers_parts_beside_held": _query(
        *HELD,
        "\n"
        + "\nUNION ALL ".join(
            [
                *_parts(
                    "store_products",
                    "numbered_products",
                    NOBODY,
                    "told_products WHERE reasons <> ''",
                ),
                *_parts("store_sales_order_header", "numbered_headers", NOBODY, NOBODY),
                *_parts(
                    "store_sales_order_detail",
                    "numbered_details",
                    "fitting_details WHERE NOT known",
                    "told_details WHERE reasons <> ''",
                ),
            ]
        ),
    ),
    "details_except_kept": _query(
        DETAILS,
        _numbered(LAYERS.order_details, "numbered", "details"),
        "\nSELECT * FROM details EXCEPT ALL"
        + _select(LAYERS.order_details, "numbered", "place = 1"),
    ),
    "details_of_catalogued_products": _query(
        PRODUCTS,
        DETAILS,
        RAW_DETAILS,
        CLEAN_DETAILS,
        CATALOGUED,
        """
SELECT * FROM clean_details d
WHERE EXISTS (SELECT 1 FROM catalogued c WHERE c.ProductID = d.ProductID)""",
    ),
    "orphaned_details": _query(
        PRODUCTS,
        DETAILS,
        RAW_DETAILS,
        CLEAN_DETAILS,
        CATALOGUED,
        """
SELECT * FROM clean_details d
WHERE ProductID IS NOT NULL
  AND NOT EXISTS (SELECT 1 FROM catalogued c WHERE c.ProductID = d.ProductID)""",
    ),
    "repeated_detail_keys": _query(
        DETAILS,
        """
SELECT SalesOrderDetailID, count(*) AS row_count
FROM details GROUP BY SalesOrderDetailID HAVING count(*) > 1""",
    ),
    "headers_missing_required": _query(
        HEADERS,
        "\nSELECT * FROM headers WHERE SalesOrderID IS NULL OR ShipDate IS NULL",
    ),
    "products_with_unknown_units": _query(
        PRODUCTS,
        """
SELECT * FROM (
  SELECT * REPLACE (CASE WHEN ProductCategoryName = 'PROMO' THEN 'MM'
                         ELSE SizeUnitMeasureCode END AS SizeUnitMeasureCode) FROM products)
WHERE SizeUnitMeasureCode NOT IN ('CM', 'IN', 'FT')
   OR WeightUnitMeasureCode NOT IN ('LB', 'G')""",
    ),
    "business_day_spans": _query(SPANS, "\nSELECT * FROM counted"),
    "business_day_total": _query(
        SPANS,
        """
SELECT count(business_days) AS spans, CAST(sum(business_days) AS BIGINT) AS business_days
FROM counted""",
    ),
    "product_master": _query(PRODUCTS, _master("products"), "\nSELECT * FROM master"),
    "uncategorised_products": _query(
        PRODUCTS,
        _master("products"),
        "\nSELECT * FROM master WHERE ProductCategoryName IS NULL",
    ),
    "uncategorised_subcategories": _query(
        PRODUCTS,
        _master("products"),
        """
SELECT ProductSubCategoryName, min(ProductID) AS ProductID
FROM master WHERE ProductCategoryName IS NULL GROUP BY 1""",
    ),
    "published_orders": _query(*DIRECT, "\nSELECT * FROM published"),
    "bronze_products": _query(PRODUCTS, RAW_PRODUCTS, "\nSELECT * FROM raw_products"),
    "bronze_order_headers": _query(HEADERS, RAW_HEADERS, "\nSELECT * FROM raw_headers"),
    "bronze_order_details": _query(DETAILS, RAW_DETAILS, "\nSELECT * FROM raw_details"),
    "bronze_order_details_of_two_exports": _query(
        DETAILS, RAW_DETAILS, "\nSELECT * FROM raw_details"
    ),
    "layers_store_products": _query(*STORE, "\nSELECT * FROM store_products"),
    "layers_store_order_headers": _query(*STORE, "\nSELECT * FROM store_headers"),
    "layers_store_order_details": _query(*STORE, "\nSELECT * FROM store_details"),
    "layers_rejected_details": _query(
        *STORE,
        """
SELECT * FROM clean_details d
WHERE NOT EXISTS (SELECT 1 FROM store_products p WHERE p.ProductID = d.ProductID)""",
    ),
    "layers_created_again": _query(
        *LAYERED,
        "\n"
        + "\nUNION ALL ".join(
            [
                _before_and_after("store_products", "store_products"),
                _before_and_after("store_sales_order_header", "store_headers"),
                _before_and_after("store_sales_order_detail", "store_details"),
                _before_and_after("publish_product", "master"),
                _before_and_after("publish_orders", "published"),
            ]
        ),
    ),
    "layers_published_products": _query(*LAYERED, "\nSELECT * FROM master"),
    "layers_published_orders": _query(*LAYERED, "\nSELECT * FROM published"),
    "layers_row_counts": _query(
        *LAYERED,
        "\n"
        + "\nUNION ALL ".join(
            [
                _count("store_products", "store_products"),
                _count("store_sales_order_header", "store_headers"),
                _count("store_sales_order_detail", "store_details"),
                _count("publish_product", "master"),
                _count("publish_orders", "published"),
                _count("store_products duplicates", "numbered_products", "place > 1"),
                _count("store_sales_order_header duplicates", "numbered_headers", "place > 1"),
                _count("store_sales_order_detail duplicates", "numbered_details", "place > 1"),
            ]
        ),
    ),
    "layers_top_color_by_year": _query(*LAYERED, COLOR_REVENUE, TOP_COLOR),
    "layers_avg_lead_time_by_category": _query(*LAYERED, LEAD_TIME),
}
