"""Sales by customer segment."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storetally.functions.exact import Sums, summed
from storetally.functions.money import ratio


def sales_by_segment(sales: DataFrame, amount: str | Sums = "total_amount", share: bool = False) -> DataFrame:
    """Count, revenue, mean and distinct customers per segment, by revenue.

    `share` adds the sample standard deviation and the share of all revenue. A
    customer may occur in several segments, so the distinct counts need not add
    up to the global one.

    The single distinct count shuffles on (segment, customer) after a partial
    aggregate: neither a hot segment nor a hot customer reaches one task whole.
    """
    priced, sums = summed(sales, amount, ["customer_segment", "customer_id"], moments=share)
    per_segment = priced.groupBy("customer_segment").agg(
        *sums.totals(), F.countDistinct("customer_id").alias("unique_customers")
    )
    columns = [
        "customer_segment",
        F.col("row_count").alias("transaction_count"),
        sums.total().alias("total_revenue"),
        sums.average().alias("avg_transaction_value"),
        "unique_customers",
    ]
    if share:
        # One row per segment reaches this window.
        whole = Window.partitionBy()
        over_all = {f"all_{name}": F.sum(name).over(whole) for name in sums.names[1:]}
        over_all[f"all_{sums.name}"] = F.sum(F.col(sums.name).cast("decimal(38,10)")).over(whole)
        per_segment = per_segment.withColumns(over_all)
        columns += [
            sums.deviation().alias("transaction_stddev"),
            ratio(F.col("total_revenue"), sums.total("all_{}".format)).alias("revenue_share"),
        ]
    return per_segment.select(*columns).orderBy(F.desc("total_revenue"))
