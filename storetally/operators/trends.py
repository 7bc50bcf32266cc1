"""Sales over tumbling time windows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from storetally.functions.exact import Sums, summed
from storetally.functions.periods import is_shorter_than_a_day, window_end, window_start


def sales_by_date(
    sales: DataFrame, window: str = "1 month", amount: str = "transaction_total", time: str = "transaction_date"
) -> DataFrame:
    """Revenue, count and distinct customers per window; times are cut to days first."""
    kind = _time_type(sales, time)
    day = F.to_date(time).cast(kind)
    windows, sums = _per_window(sales, day, window, amount, kind)
    return (
        windows
        .select(
            "window_start",
            "window_end",
            sums.total().alias("total_revenue"),
            F.col("row_count").alias("transaction_count"),
            "unique_customers",
        )
        .orderBy("window_start")
    )


def sales_by_time(
    sales: DataFrame,
    window: str = "1 month",
    amount: str | Sums = "total_amount",
    time: str = "timestamp",
    growth: bool = False,
) -> DataFrame:
    """As above on the full timestamp, with the mean.

    `growth` adds revenue minus the revenue of the previous non-empty window.
    """
    kind = _time_type(sales, time)
    moment = F.col(time).cast(kind)
    windows, sums = _per_window(sales, moment, window, amount, kind)
    columns = [
        "window_start",
        "window_end",
        sums.total().alias("total_revenue"),
        F.col("row_count").alias("transaction_count"),
        "unique_customers",
        sums.average().alias("avg_transaction_value"),
    ]
    if growth:
        if is_shorter_than_a_day(window):
            windows = _previous_across_days(windows, sums)
        else:
            # One row per window of a day or more: a few hundred rows a year.
            windows = windows.withColumn("previous", F.lag(F.struct(*sums.names)).over(Window.orderBy("window_start")))
        columns.append(sums.less("previous").alias("revenue_growth"))
    return windows.select(*columns).orderBy("window_start")


def _time_type(sales: DataFrame, time: str) -> str:
    """Windows keep the kind of timestamp they are given."""
    return "timestamp_ntz" if dict(sales.dtypes)[time] == "timestamp_ntz" else "timestamp"


def _per_window(
    sales: DataFrame, moment: Column, window: str, amount: str | Sums, kind: str
) -> tuple[DataFrame, Sums]:
    priced, sums = summed(sales, amount, [moment.alias("moment"), "customer_id"])
    # Rows without a time belong to no window.
    return (
        priced.where(F.col("moment").isNotNull())
        .groupBy(window_start(F.col("moment"), window).cast(kind).alias("window_start"))
        .agg(*sums.totals(), F.countDistinct("customer_id").alias("unique_customers"))
        .withColumn("window_end", window_end(F.col("window_start"), window).cast(kind))
    ), sums


def _previous_across_days(windows: DataFrame, sums: Sums) -> DataFrame:
    """Previous window's sums without sorting all windows in one task.

    Within a day by `lag` per day; the first window of a day takes the last
    window of the previous non-empty day from a table with one row per day. That
    table carries all columns of its windows, so that both sides are the same
    exchange for Spark and the fact is read and totalled once.
    """
    in_day = Window.partitionBy("day").orderBy("window_start")
    by_day = windows.withColumn("day", F.to_date("window_start"))
    closing = (
        by_day.groupBy("day")
        .agg(F.max_by(F.struct(*windows.columns), "window_start").alias("last"))
        .select("day", F.lag("last").over(Window.orderBy("day")).alias("last"))
        .select(
            "day",
            F.when(F.col("last").isNotNull(), F.struct(*[F.col("last")[name].alias(name) for name in sums.names])).alias(
                "previous_closing"
            ),
        )
    )
    return (
        by_day.withColumn("place", F.row_number().over(in_day))
        .withColumn("previous_in_day", F.lag(F.struct(*sums.names)).over(in_day))
        .join(closing, "day", "left")
        .withColumn(
            "previous", F.when(F.col("place") == 1, F.col("previous_closing")).otherwise(F.col("previous_in_day"))
        )
    )
