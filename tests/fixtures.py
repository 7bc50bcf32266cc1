"""Small frames with the edge cases the analyses must get right."""

from __future__ import annotations

import datetime as dt

SALES = (
    "transaction_id bigint, store_id bigint, customer_id string, customer_segment string, "
    "timestamp timestamp_ntz, total_amount double"
)


def ts(text: str) -> dt.datetime:
    return dt.datetime.fromisoformat(text)


SALES_ROWS = [
    (1, 1, "PRO_1", "Professional Contractor", ts("2024-01-31 10:00:00"), 100.10),
    # The same customer in another segment.
    (2, 1, "PRO_1", "Property Manager", ts("2024-02-29 09:00:00"), 50.25),
    (3, 2, "DIY_2", "DIY Homeowner", ts("2024-01-15 10:00:00"), 20.00),
    (4, 2, "DIY_2", "DIY Homeowner", ts("2024-02-14 09:00:00"), 30.05),
    # No customer, a store that is not in the stores table.
    (5, 99, None, "DIY Homeowner", ts("2024-02-20 00:00:00"), 5.55),
    # No amount.
    (6, 3, "DIY_3", "DIY Homeowner", ts("2024-04-01 23:59:59"), None),
    # No store; March has no rows at all.
    (7, None, "DIY_3", "DIY Homeowner", ts("2024-05-01 00:00:00"), 7.00),
]

STORES = [(1, "West", "CA"), (2, "West", "CA"), (3, "West", None), (4, "Midwest", "OH"), (5, None, None)]


def sales(spark, rows=None):
    return spark.createDataFrame(SALES_ROWS if rows is None else rows, SALES)


def stores(spark):
    return spark.createDataFrame(STORES, "store_id bigint, region string, state string")


def rows(df):
    return [row.asDict(recursive=True) for row in df.collect()]
