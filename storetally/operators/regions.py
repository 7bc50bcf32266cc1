"""Sales by region and state."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storetally.functions.exact import Sums, summed
from storetally.operators.rollup import in_one_pass

PLACE = ["region", "state"]


def regional_flat(sales: DataFrame, amount: str = "transaction_total") -> DataFrame:
    """Revenue, mean, stores and customers per region and state of a flat table."""
    priced, sums = summed(sales, amount, [*PLACE, "store_id", "customer_id"])
    return (
        in_one_pass(priced, sums, PLACE)
        .select(
            *PLACE,
            sums.total().alias("total_revenue"),
            sums.average().alias("avg_transaction_value"),
            F.col("stores").alias("store_count"),
            F.col("customers").alias("customer_count"),
        )
        .orderBy("region", F.desc("total_revenue"))
    )


def regional_star(sales: DataFrame, stores: DataFrame, amount: str | Sums = "total_amount") -> DataFrame:
    """The same from fact and stores; sales of unknown stores form a NULL group.

    `store_id` must be unique in `stores` (`sources.check_unique`). The fact
    carries one number per place, the place's smallest store, instead of two
    strings through the distinct counts; region and state are joined to the
    result. No join is hinted: Spark broadcasts the stores if their size is below
    its threshold (give them as a scan, for the estimated size of a join is the
    product of its sides) and else sorts and merges, where AQE splits a hot store.
    """
    # Stores with neither region nor state belong to the NULL group, too.
    named = stores.where(F.col("region").isNotNull() | F.col("state").isNotNull())
    places = named.groupBy(*PLACE).agg(F.min("store_id").alias("place"))
    # A window keeps the size of the stores; a self-join would be estimated far larger.
    known = named.withColumn("place", F.min("store_id").over(Window.partitionBy(*PLACE)))
    priced, sums = summed(sales, amount, ["store_id", "customer_id"])
    placed = priced.join(
        known.select("store_id", "place"), "store_id", "left"
    )
    return (
        in_one_pass(placed, sums, ["place"])
        .join(places, "place", "left")
        .select(
            *PLACE,
            sums.total().alias("total_revenue"),
            sums.average().alias("avg_transaction_value"),
            F.col("row_count").alias("transaction_count"),
            F.col("stores").alias("store_count"),
            F.col("customers").alias("customer_count"),
        )
        .orderBy(F.desc("total_revenue"))
    )


def regional_by_store(sales: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Revenue, mean and count per store, for use without a stores table."""
    priced, sums = summed(sales, amount, ["store_id"])
    return (
        priced.groupBy("store_id")
        .agg(*sums.totals())
        .select(
            "store_id",
            sums.total().alias("total_revenue"),
            sums.average().alias("avg_transaction_value"),
            F.col("row_count").alias("transaction_count"),
        )
        .orderBy(F.desc("total_revenue"))
    )
