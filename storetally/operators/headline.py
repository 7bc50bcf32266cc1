"""Headline statistics of the whole table, one row."""

from __future__ import annotations

from typing import Any

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storetally.functions.exact import Sums, summed
from storetally.functions.money import ratio_or_zero
from storetally.operators.rollup import add_up, in_one_pass


def basic_stats(
    sales: DataFrame,
    amount: str | Sums = "total_amount",
    date: str | None = None,
    ratios: bool = False,
    one_pass: bool = False,
) -> DataFrame:
    """Counts, revenue, mean, distinct customers and stores.

    `date` adds `date_from` and `date_to`, `ratios` adds `revenue_per_customer`
    and `transactions_per_store` (0 where the count is 0). Set `one_pass` where
    `sales` is a join rather than a table, so that it is evaluated once.
    """
    days = [F.to_date(date).alias("day")] if date else []
    spans = [F.min("day").alias("date_from"), F.max("day").alias("date_to")] if date else []
    priced, sums = summed(sales, amount, ["store_id", "customer_id", *days])
    if one_pass:
        stats = in_one_pass(priced, sums, extra=spans)
    else:
        stats = add_up(
            priced.groupBy("store_id").agg(*sums.totals(), *spans),
            priced.select("customer_id").distinct(),
            sums,
            extra=[F.min("date_from").alias("date_from"), F.max("date_to").alias("date_to")] if date else [],
        )
    columns = [
        F.col("row_count").alias("total_transactions"),
        sums.total().alias("total_revenue"),
        sums.average().alias("avg_transaction_value"),
        F.col("customers").alias("unique_customers"),
        F.col("stores").alias("active_stores"),
    ]
    if date:
        columns += ["date_from", "date_to"]
    if ratios:
        columns += [
            ratio_or_zero(F.col("total_revenue"), F.col("customers")).alias("revenue_per_customer"),
            ratio_or_zero(F.col("row_count"), F.col("stores")).alias("transactions_per_store"),
        ]
    return stats.select(*columns)


def mini_stats(sales: DataFrame, amount: str = "total_amount") -> DataFrame:
    """Count, revenue and mean only."""
    priced, sums = summed(sales, amount)
    return (
        priced.agg(*sums.totals())
        .select(
            F.col("row_count").alias("total_transactions"),
            sums.total().alias("total_revenue"),
            sums.average().alias("avg_transaction_value"),
        )
    )


def first_row(stats: DataFrame) -> dict[str, Any]:
    """The one row of a statistics frame as a dictionary (runs the query)."""
    return stats.first().asDict(recursive=True)
