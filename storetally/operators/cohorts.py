"""Customer cohorts by month of first purchase."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storetally.functions.exact import summed


def customer_cohorts(
    sales: DataFrame, amount: str = "transaction_total", time: str = "transaction_date"
) -> DataFrame:
    """Active customers and revenue per first-purchase month and elapsed months.

    Elapsed months are `floor(months_between(time, first))`. The time of day
    cannot change that number: on equal days of the month it is ignored, and
    otherwise it shifts the fraction by less than the day does. So the fact is
    first totalled per customer and day. That bounds the rows of one customer by
    the number of days, however many sales they have, and makes the window over
    a customer safe. The per-customer steps share one shuffle, and counting
    customers needs no distinct.
    """
    known = sales.where(F.col("customer_id").isNotNull())
    priced, sums = summed(known, amount, ["customer_id", F.to_date(time).alias("day")])
    kind = "timestamp_ntz" if dict(sales.dtypes)[time] == "timestamp_ntz" else "timestamp"
    daily = priced.groupBy("customer_id", "day").agg(*sums.sums())
    dated = daily.withColumn("first_day", F.min("day").over(Window.partitionBy("customer_id")))
    per_customer = dated.groupBy(
        "customer_id",
        F.trunc("first_day", "month").alias("cohort"),
        F.floor(F.months_between("day", "first_day")).alias("month_number"),
    ).agg(*sums.sums())
    wide = F.sum(F.col(sums.name).cast("decimal(38,10)")).alias(sums.name)
    return (
        per_customer.groupBy(F.col("cohort").cast(kind).alias("cohort_month"), "month_number")
        .agg(F.count("*").alias("active_customers"), wide, *sums.sums()[1:])
        .select("cohort_month", "month_number", "active_customers", sums.total().alias("total_revenue"))
        .orderBy("cohort_month", "month_number")
    )
