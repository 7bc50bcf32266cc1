"""Sales by product category."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storetally.functions.exact import summed


def product_performance(sales: DataFrame, amount: str = "transaction_total") -> DataFrame:
    """Units, revenue, unweighted mean unit price and selling stores per category."""
    units = F.col("quantity").cast("bigint").alias("quantity")
    sold, sums = summed(sales, amount, ["product_category", "store_id", "unit_price", units])
    sold, prices = summed(sold, "unit_price", [name for name in sold.columns if name != "unit_price"], "unit_cents")
    return (
        sold.groupBy("product_category")
        .agg(
            F.sum("quantity").alias("total_units_sold"),
            *sums.totals(),
            F.count(prices.name).alias("unit_prices"),
            *prices.sums(),
            F.countDistinct("store_id").alias("stores_selling"),
        )
        .select(
            "product_category",
            "total_units_sold",
            sums.total().alias("total_revenue"),
            F.try_divide(prices.total(), F.col("unit_prices").cast("double")).alias("avg_unit_price"),
            "stores_selling",
        )
        .orderBy(F.desc("total_revenue"))
    )
