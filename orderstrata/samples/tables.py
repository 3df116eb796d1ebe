"""Sample tables in the shape of the contracts.

Parts stand in for products, orders for order headers, line items for order
details. Order number and line number together identify a detail; many line
items share both, which gives duplicates. ``raw_*`` are the same tables as
padded text with some rows delivered twice, as files would hold them.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from orderstrata.contracts import MONEY, SALES

# Samples outgrow 32-bit identifiers at large scale factors.
LAYERS = SALES.widened()

# The second word of a part's name, as a product subcategory; "rod" has none.
SUBCATEGORY_OF = {
    "anvil": "Road Frames",
    "bolt": "Gloves",
    "gear": "Helmets",
    "gizmo": "Wheels",
    "plate": "Chains",
    "ring": "Pumps",
    "widget": "Socks",
}
# Units of the part types that are sold by size.
SIZE_UNIT_OF = {"SMALL": "CM", "MEDIUM": "IN", "LARGE": "FT"}


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _money(column: str) -> Column:
    return F.col(column).cast(MONEY)


def _lookup(mapping: dict[str, str], key: Column) -> Column:
    return F.create_map(*[F.lit(x) for x in chain(*mapping.items())])[key]


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_name", " ")
    return load(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("ProductID"),
        F.col("p_name").alias("ProductDesc"),
        F.concat("p_brand", F.lit("-"), F.col("p_partkey").cast("string")).alias("ProductNumber"),
        F.col("p_type").isin("STANDARD", "ECONOMY").alias("MakeFlag"),
        F.nullif(words[0], F.lit("new")).alias("Color"),
        (F.col("p_size") * 20).alias("SafetyStockLevel"),
        (F.col("p_size") * 15).alias("ReorderPoint"),
        (_money("p_retailprice") - F.col("p_size")).cast(MONEY).alias("StandardCost"),
        _money("p_retailprice").alias("ListPrice"),
        F.col("p_size").cast("string").alias("Size"),
        _lookup(SIZE_UNIT_OF, F.col("p_type")).alias("SizeUnitMeasureCode"),
        _money("p_size").alias("Weight"),
        F.when(F.col("p_size") < 25, "G").otherwise("LB").alias("WeightUnitMeasureCode"),
        F.when(F.col("p_type").isin("PROMO", "SMALL"), F.col("p_type")).alias(
            "ProductCategoryName"
        ),
        _lookup(SUBCATEGORY_OF, words[1]).alias("ProductSubCategoryName"),
    )


def order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ship dates run from before the order to after it, open orders have none."""
    ordered = F.col("o_orderdate").cast("date")
    shipped = F.date_add(ordered, F.day(ordered) - 3)
    online = F.col("o_orderpriority").isin("1-URGENT", "2-HIGH")
    return load(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("SalesOrderID"),
        ordered.alias("OrderDate"),
        F.when(F.col("o_orderstatus") != "O", shipped).alias("ShipDate"),
        online.alias("OnlineOrderFlag"),
        F.concat(F.lit("AC-"), F.col("o_custkey").cast("string")).alias("AccountNumber"),
        F.col("o_custkey").alias("CustomerID"),
        F.when(~online, F.col("o_custkey")).alias("SalesPersonID"),
        _money("o_totalprice").alias("Freight"),
    )


def order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    return load(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("SalesOrderID"),
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("SalesOrderDetailID"),
        F.col("l_quantity").cast("int").alias("OrderQty"),
        F.col("l_partkey").alias("ProductID"),
        _money("l_extendedprice").alias("UnitPrice"),
        _money("l_discount").alias("UnitPriceDiscount"),
    )


def _padded(df: DataFrame) -> DataFrame:
    """Every column as text between blanks, NULLs left as they are."""
    return df.select(
        [F.concat(F.lit("  "), F.col(c).cast("string"), F.lit(" ")).alias(c) for c in df.columns]
    )


def raw_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as text; promoted ones come a second time at a lower price."""
    listed = products(spark, sf_dir)
    promoted = listed.where(F.col("ProductCategoryName") == "PROMO").withColumn(
        "ListPrice", (F.col("ListPrice") - 10).cast(MONEY)
    )
    return _padded(listed.unionByName(promoted))


def raw_order_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order headers as text; those placed online come twice."""
    listed = order_headers(spark, sf_dir)
    return _padded(listed.unionByName(listed.where("OnlineOrderFlag")))


def raw_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order details as text with a fifth decimal in prices; cheap lines name no product."""
    details = order_details(spark, sf_dir)
    named = F.when(F.col("UnitPrice") >= 10000, F.col("ProductID"))
    finer = F.concat(F.col("UnitPrice").cast("string"), F.lit("5"))
    return _padded(details.withColumns({"ProductID": named, "UnitPrice": finer}))


def spoiled_order_details(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Order details as text, some with what their table does not take.

    Of every eleventh order the quantities are words, of every thirteenth the line's number
    is missing, of every seventeenth the price has too many digits.
    """
    raw = raw_order_details(spark, sf_dir)
    order = F.trim("SalesOrderID").cast("bigint")
    words = F.concat(F.lit(" about"), F.col("OrderQty"))
    digits = F.concat(F.lit("12345678901234567890"), F.trim("UnitPrice"))
    return raw.withColumns(
        {
            "OrderQty": F.when(order % 11 == 0, words).otherwise(F.col("OrderQty")),
            "SalesOrderDetailID": F.when(order % 13 != 0, F.col("SalesOrderDetailID")),
            "UnitPrice": F.when(order % 17 == 0, digits).otherwise(F.col("UnitPrice")),
        }
    )


def spoiled_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products as text; every seventh comes in a unit unknown and at a price that is none."""
    raw = raw_products(spark, sf_dir)
    spoiled = F.trim("ProductID").cast("bigint") % 7 == 0
    return raw.withColumns(
        {
            "WeightUnitMeasureCode": F.when(spoiled, " OZ ").otherwise(
                F.col("WeightUnitMeasureCode")
            ),
            "ListPrice": F.when(spoiled, "free").otherwise(F.col("ListPrice")),
        }
    )


def catalogued_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products with a size unit or a category; lines of the others have no product here."""
    return products(spark, sf_dir).where(
        "SizeUnitMeasureCode IS NOT NULL OR ProductCategoryName IS NOT NULL"
    )
