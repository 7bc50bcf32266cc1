"""Totals with exact distinct customers and stores in one result.

Two `countDistinct` in one aggregate make Spark emit every row three times
before the first partial aggregate (`in_one_pass`). It is cheaper to give each
entity its own aggregate, which reads only its own columns, and to stack and add
up the two small results (`add_up`), unless the rows come from a costly plan
such as a join, which would run twice. Both combine on the map side, so a store
or a customer with a third of all rows leaves each task as one row. Measured in
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storetally.functions.exact import Sums


def in_one_pass(sales: DataFrame, sums: Sums, groups: Sequence[str] = (), extra: Sequence[Column] = ()) -> DataFrame:
    """Totals, distinct stores and distinct customers per group."""
    return sales.groupBy(*groups).agg(
        *sums.totals(),
        F.countDistinct("store_id").alias("stores"),
        F.countDistinct("customer_id").alias("customers"),
        *extra,
    )


def add_up(stores: DataFrame, customers: DataFrame, sums: Sums, extra: Sequence[Column] = ()) -> DataFrame:
    """The same over the whole table, from totals per store and distinct customers.

    `extra` are aggregates over further columns of `stores`.
    """
    present = stores.withColumn("stores", F.col("store_id").isNotNull().cast("bigint")).drop("store_id")
    counted = customers.select(F.col("customer_id").isNotNull().cast("bigint").alias("customers"))
    return present.unionByName(counted, allowMissingColumns=True).agg(
        F.coalesce(F.sum("row_count"), F.lit(0)).alias("row_count"),
        F.coalesce(F.sum("priced"), F.lit(0)).alias("priced"),
        F.sum(F.col(sums.name).cast("decimal(38,10)")).alias(sums.name),
        *[F.sum(name).alias(name) for name in sums.names[1:]],
        F.coalesce(F.sum("stores"), F.lit(0)).alias("stores"),
        F.coalesce(F.sum("customers"), F.lit(0)).alias("customers"),
        *extra,
    )
