"""Table contracts: columns, types, keys, references and value domains of each layer."""

from __future__ import annotations

from dataclasses import dataclass, field, fields, replace

from pyspark.sql.types import (
    BooleanType,
    DataType,
    DateType,
    DecimalType,
    IntegerType,
    LongType,
    StringType,
    StructField,
    StructType,
)

TEXT = StringType()
INT = IntegerType()
FLAG = BooleanType()
DAY = DateType()
MONEY = DecimalType(19, 4)


@dataclass(frozen=True)
class Contract:
    """What a typed table promises; the schema also drives the cleaning."""

    name: str
    schema: StructType
    key: str
    references: dict[str, str] = field(default_factory=dict)
    domains: dict[str, tuple[str, ...]] = field(default_factory=dict)

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()

    @property
    def required(self) -> list[str]:
        return [f.name for f in self.schema.fields if not f.nullable]

    def widened(self) -> Contract:
        """The same table with 64-bit identifiers, for more rows than 32 bits can number."""
        wide = [
            StructField(f.name, LongType() if f.name.endswith("ID") else f.dataType, f.nullable)
            for f in self.schema.fields
        ]
        return replace(self, schema=StructType(wide))


def _schema(required: set[str], **columns: DataType) -> StructType:
    return StructType([StructField(n, t, n not in required) for n, t in columns.items()])


# The units a size and a weight may be given in.
SIZE_UNITS = ("CM", "IN", "FT")
WEIGHT_UNITS = ("LB", "G")
UNIT_DOMAINS = {"SizeUnitMeasureCode": SIZE_UNITS, "WeightUnitMeasureCode": WEIGHT_UNITS}

# Names, order and types of the columns below.
PRODUCT_SCHEMA = _schema(
    {"ProductID"},
    ProductID=INT,
    ProductDesc=TEXT,
    ProductNumber=TEXT,
    MakeFlag=FLAG,
    Color=TEXT,
    SafetyStockLevel=INT,
    ReorderPoint=INT,
    StandardCost=MONEY,
    ListPrice=MONEY,
    Size=TEXT,
    SizeUnitMeasureCode=TEXT,
    Weight=MONEY,
    WeightUnitMeasureCode=TEXT,
    ProductCategoryName=TEXT,
    ProductSubCategoryName=TEXT,
)

STORE_PRODUCTS = Contract(
    "store_products", PRODUCT_SCHEMA, key="ProductID", domains=UNIT_DOMAINS
)

STORE_ORDER_HEADERS = Contract(
    "store_sales_order_header",
    _schema(
        {"SalesOrderID"},
        SalesOrderID=INT,
        OrderDate=DAY,
        ShipDate=DAY,
        OnlineOrderFlag=FLAG,
        AccountNumber=TEXT,
        CustomerID=INT,
        SalesPersonID=INT,
        Freight=MONEY,
    ),
    key="SalesOrderID",
)

# A line's order is not a declared reference: lines without a header may be stored.
STORE_ORDER_DETAILS = Contract(
    "store_sales_order_detail",
    _schema(
        {"SalesOrderID", "SalesOrderDetailID"},
        SalesOrderID=INT,
        SalesOrderDetailID=INT,
        OrderQty=INT,
        ProductID=INT,
        UnitPrice=MONEY,
        UnitPriceDiscount=MONEY,
    ),
    key="SalesOrderDetailID",
    references={"ProductID": "store_products"},
)

PUBLISH_PRODUCTS = Contract(
    "publish_product", PRODUCT_SCHEMA, key="ProductID", domains=UNIT_DOMAINS
)

PUBLISH_ORDERS = Contract(
    "publish_orders",
    _schema(
        {"SalesOrderDetailID"},
        SalesOrderDetailID=INT,
        OrderQty=INT,
        ProductID=INT,
        UnitPrice=MONEY,
        UnitPriceDiscount=MONEY,
        OrderDate=DAY,
        ShipDate=DAY,
        OnlineOrderFlag=FLAG,
        AccountNumber=TEXT,
        CustomerID=INT,
        SalesPersonID=INT,
        TotalOrderFreight=MONEY,
        LeadTimeInBusinessDays=INT,
        TotalLineExtendedPrice=MONEY,
    ),
    key="SalesOrderDetailID",
    references={"ProductID": "publish_product"},
)


@dataclass(frozen=True)
class Layers:
    """The typed tables of the store and publish layers, in order of creation."""

    products: Contract = STORE_PRODUCTS
    order_headers: Contract = STORE_ORDER_HEADERS
    order_details: Contract = STORE_ORDER_DETAILS
    published_products: Contract = PUBLISH_PRODUCTS
    published_orders: Contract = PUBLISH_ORDERS

    def all(self) -> list[Contract]:
        return [getattr(self, f.name) for f in fields(self)]

    def widened(self) -> Layers:
        return Layers(*[contract.widened() for contract in self.all()])


SALES = Layers()
