"""Product attributes with defaults."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column
from pyspark.sql import functions as F


@dataclass(frozen=True)
class CategoryRule:
    """A category, and the subcategories that belong to it by name or by a contained word."""

    category: str
    names: tuple[str, ...]
    containing: str | None = None

    def matches(self, subcategory: Column) -> Column:
        listed = subcategory.isin(*self.names)
        if self.containing is None:
            return listed
        return listed | subcategory.contains(self.containing)


# Category names and their subcategories, first match wins.
CATEGORY_RULES = (
    CategoryRule("Clothing", ("Gloves", "Shorts", "Socks", "Tights", "Vests")),
    CategoryRule(
        "Accessories", ("Locks", "Lights", "Headsets", "Helmets", "Pedals", "Pumps")
    ),
    CategoryRule("Components", ("Wheels", "Saddles"), containing="Frames"),
)

# Fixed value: the colour shown where none is known.
UNKNOWN_COLOR = "N/A"


def known_color(color: str = "Color") -> Column:
    """The colour, or a marker where it is NULL; an empty string counts as known."""
    return F.coalesce(F.col(color), F.lit(UNKNOWN_COLOR))


def categorised(
    category: str = "ProductCategoryName",
    subcategory: str = "ProductSubCategoryName",
    rules: tuple[CategoryRule, ...] = CATEGORY_RULES,
) -> Column:
    """The category, or the one its subcategory belongs to where it is NULL."""
    guesses = [F.when(rule.matches(F.col(subcategory)), rule.category) for rule in rules]
    return F.coalesce(F.col(category), *guesses)
