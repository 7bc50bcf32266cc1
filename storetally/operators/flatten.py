"""Star tables to the flat sales table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def flatten(
    items: DataFrame,
    header: DataFrame | None = None,
    products: DataFrame | None = None,
    stores: DataFrame | None = None,
) -> DataFrame:
    """One row per line with the columns of the sides given.

    `items`: transaction_id, sku, quantity, unit_price, line_total; `header`:
    transaction_id, customer_id, customer_segment, timestamp; `products`: sku,
    category; `stores`: store_id, region, state. `store_id` comes with either
    `items` or `header`. The measure of a flat row is its own line total. Lines
    without a header, product or store are kept, with NULLs.

    A side that is not needed costs a join that Spark cannot remove: leave it
    out. No join is hinted: a side below Spark's broadcast threshold is
    broadcast, larger ones are sorted and merged, and there AQE splits a hot key.
    """
    flat = items.withColumnRenamed("line_total", "transaction_total")
    if header is not None:
        flat = flat.join(header.withColumnRenamed("timestamp", "transaction_date"), "transaction_id", "left")
    if products is not None:
        flat = flat.join(products.select("sku", F.col("category").alias("product_category")), "sku", "left")
    if stores is not None:
        flat = flat.join(stores.select("store_id", "region", "state"), "store_id", "left")
    return flat


FLAT_COLUMNS = [
    "customer_id",
    "store_id",
    "customer_segment",
    "product_category",
    "region",
    "state",
    "quantity",
    "unit_price",
    "transaction_total",
    "transaction_date",
]
