"""Profile of a dataset."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Assumed size of a transaction in KB, rows of a chunk.
KB_PER_TRANSACTION = 0.1
CHUNK_ROWS = 1_000_000


def table_profile(name: str, table: DataFrame, date: str | None = None) -> DataFrame:
    """Row count and date span of one table."""
    day = F.to_date(date) if date else F.lit(None).cast("date")
    return table.agg(
        F.count("*").alias("row_count"), F.min(day).alias("date_from"), F.max(day).alias("date_to")
    ).select(F.lit(name).alias("table_name"), "row_count", "date_from", "date_to")


def dataset_profile(
    transactions: DataFrame, stores: DataFrame, products: DataFrame, date: str = "date"
) -> DataFrame:
    """One row per table."""
    return (
        table_profile("transactions", transactions, date)
        .unionByName(table_profile("stores", stores))
        .unionByName(table_profile("products", products))
    )


def dataset_info(profile: DataFrame) -> DataFrame:
    """The profile as one row, with the estimated size and chunk count."""

    def rows_of(name: str):
        return F.max(F.when(F.col("table_name") == name, F.col("row_count")))

    return profile.agg(
        rows_of("transactions").alias("total_transactions"),
        rows_of("stores").alias("total_stores"),
        rows_of("products").alias("total_products"),
        F.concat_ws(" to ", F.min("date_from").cast("string"), F.max("date_to").cast("string")).alias("date_range"),
    ).select(
        "*",
        (F.col("total_transactions") * F.lit(KB_PER_TRANSACTION) / F.lit(1_000_000.0)).alias("estimated_size_gb"),
        F.floor(F.col("total_transactions") / F.lit(CHUNK_ROWS)).alias("chunks_generated"),
    )
