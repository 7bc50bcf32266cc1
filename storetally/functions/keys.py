"""Business keys and product attributes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from storetally.functions.lookups import HAZMAT_CATEGORIES


def customer_key(segment: Column, number: Column) -> Column:
    """'Commercial', 42 -> 'COM_00000042'; longer numbers are kept whole; NULL if either is."""
    key = F.format_string("%s_%08d", F.upper(F.substring(segment, 1, 3)), number.cast("bigint"))
    return F.when(segment.isNotNull() & number.isNotNull(), key)


def sku_key(number: Column) -> Column:
    """100000 -> 'P100000'."""
    return F.concat(F.lit("P"), number.cast("bigint").cast("string"))


def product_name(brand: Column, category: Column, color: Column, sheen: Column, size: Column) -> Column:
    """Parts joined by one space and trimmed; an empty colour leaves two spaces."""
    return F.trim(F.concat_ws(" ", brand, category, color, sheen, size))


def is_hazmat(category: Column, categories: Sequence[str] = HAZMAT_CATEGORIES) -> Column:
    return category.isin(list(categories))
