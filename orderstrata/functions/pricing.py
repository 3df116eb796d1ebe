"""Money expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def extended_price(
    quantity: str = "OrderQty",
    unit_price: str = "UnitPrice",
    unit_discount: str = "UnitPriceDiscount",
) -> Column:
    """Quantity times the discounted unit price; the discount is an amount per unit."""
    amount = F.col(quantity) * (F.col(unit_price) - F.col(unit_discount))
    return amount.cast("decimal(19,4)")
