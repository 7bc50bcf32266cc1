"""Small fixed tables and the expressions that look values up in them."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import Column
from pyspark.sql import functions as F

# Price premium and seasonal multiplier per region.
REGION_PREMIUM = {
    "Northeast": Decimal("1.15"),
    "Southeast": Decimal("0.95"),
    "Midwest": Decimal("1.00"),
    "Southwest": Decimal("1.05"),
    "West": Decimal("1.25"),
    "Northwest": Decimal("1.10"),
}
REGION_SEASONAL = {
    "Northeast": Decimal("0.6"),
    "Southeast": Decimal("0.8"),
    "Midwest": Decimal("0.5"),
    "Southwest": Decimal("0.9"),
    "West": Decimal("0.7"),
    "Northwest": Decimal("0.4"),
}

# Demand multiplier per calendar month.
MONTH_SEASONAL = {
    1: Decimal("0.7"),
    2: Decimal("0.8"),
    3: Decimal("1.1"),
    4: Decimal("1.4"),
    5: Decimal("1.6"),
    6: Decimal("1.8"),
    7: Decimal("1.7"),
    8: Decimal("1.5"),
    9: Decimal("1.2"),
    10: Decimal("1.0"),
    11: Decimal("0.8"),
    12: Decimal("0.9"),
}

# Categories shipped as hazardous material; sales tax.
HAZMAT_CATEGORIES = ("Stains & Finishes", "Primers")
SALES_TAX = Decimal("0.08")


def looked_up(key: Column, table: Mapping) -> Column:
    """Value of `key` in a fixed table of a few entries, NULL if absent.

    A map literal keeps the lookup in the projection: no join, no broadcast.
    """
    entries = [F.lit(item) for pair in table.items() for item in pair]
    return F.try_element_at(F.create_map(*entries), key)


def region_premium(region: Column, table: Mapping = REGION_PREMIUM) -> Column:
    """Price premium of a region, NULL for an unknown one."""
    return looked_up(region, table).cast("decimal(5,4)")


def region_seasonal(region: Column, table: Mapping = REGION_SEASONAL) -> Column:
    """Seasonal multiplier of a region, NULL for an unknown one."""
    return looked_up(region, table).cast("decimal(5,4)")


def month_seasonal(month: Column, table: Mapping = MONTH_SEASONAL) -> Column:
    """Demand multiplier of a calendar month, 1 where none is given."""
    return F.coalesce(looked_up(month.cast("int"), table).cast("decimal(5,4)"), F.lit(Decimal("1.0000")))
