"""Column expressions; all built from Spark's own functions, so they stay inside code generation."""

from orderstrata.functions.dates import business_days
from orderstrata.functions.pricing import extended_price
from orderstrata.functions.products import CATEGORY_RULES, CategoryRule, categorised, known_color

__all__ = [
    "CATEGORY_RULES",
    "CategoryRule",
    "business_days",
    "categorised",
    "extended_price",
    "known_color",
]
