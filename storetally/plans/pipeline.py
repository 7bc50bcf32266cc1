"""Batch jobs: load, analyse, save, summarise."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from storetally.functions.exact import Sums, tally
from storetally.functions.periods import window_start
from storetally.operators.cohorts import customer_cohorts
from storetally.operators.flatten import FLAT_COLUMNS, flatten
from storetally.operators.headline import basic_stats, first_row
from storetally.operators.products import product_performance
from storetally.operators.profile import dataset_info, dataset_profile
from storetally.operators.regions import regional_flat, regional_star
from storetally.operators.segments import sales_by_segment
from storetally.operators.trends import sales_by_date, sales_by_time
from storetally.schemas import REQUIRED
from storetally.session import remove_folder, run_folder
from storetally.sinks.facts import save_chunks
from storetally.sinks.results import observed, observed_metrics, save_result
from storetally.sources import parquet

# Bytes of the fact, or of its totals, that a task of the one-scan job reads at most (a larger row group is one task's).
SPLIT_BYTES = 32 << 20

LOADERS = {
    "chunks": parquet.load_chunks,
    "mixed": parquet.load_mixed_chunks,
    "filtered": parquet.load_filtered,
    "recursive": parquet.load_recursive,
    "partitioned": parquet.load_partitioned,
}


def run_pipeline(
    spark: SparkSession,
    input_path: str,
    output_path: str,
    layout: str = "chunks",
    window: str = "1 month",
    cache: bool = False,
    one_scan: bool = False,
) -> dict[str, Any]:
    """Reads fact and dimensions below `input_path`, writes results below `output_path`.

    Returns the summary that is also written to `analysis_summary.json`. Every
    analysis is evaluated once, by its own write, and reads only its columns of
    the fact; only one-row statistics come to the driver. `cache` keeps the
    columns they need in memory, for a fact that fits there. `one_scan` reads the fact once,
    totals it by day, window, store, segment and customer into a folder of the run, and folds all analyses
    from these totals: for facts with many sales of a customer a day, or costly to read.
    """
    transactions = LOADERS[layout](spark, input_path)
    if cache:
        transactions = parquet.keep(transactions, REQUIRED["transactions"])
    stores = parquet.load_stores(spark, input_path)
    # A repeated store would multiply its sales.
    master_data = {
        "stores_count": parquet.check_unique(stores, "store_id"),
        "products_count": parquet.load_products(spark, input_path).count(),
    }
    amount: str | Sums = "total_amount"
    totals_path = None
    if one_scan:
        totals_path = run_folder(spark, "totals")
        with _small_splits(spark):
            transactions, amount = daily_totals(transactions, window, totals_path)
    try:
        with _small_splits(spark) if one_scan else nullcontext():
            paths, watch = save_analyses(transactions, stores, output_path, window, amount)
    finally:
        if totals_path:
            remove_folder(spark, totals_path)
    if cache:
        transactions.unpersist()

    stats = spark.read.parquet(paths["basic_stats"])
    now = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    save_result(observed_metrics(spark, watch).withColumn("ts", F.lit(now)), output_path, "run_metrics")
    summary = summary_row(stats, now, input_path, output_path, master_data, paths)
    summary.write.mode("overwrite").json(f"{output_path.rstrip('/')}/analysis_summary.json")
    return first_row(summary)


@contextmanager
def _small_splits(spark: SparkSession) -> Iterator[None]:
    """Scans that run inside read `SPLIT_BYTES` a task, or less if the cluster says so.

    Where customers seldom buy twice a day, a task that totals a split holds a wide row for nearly
    every sale in it, so its memory goes with the split, not with the result.
    """
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    size = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(before)
    spark.conf.set(setting, f"{min(size, SPLIT_BYTES)}b")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def daily_totals(transactions: DataFrame, window: str, path: str) -> tuple[DataFrame, Sums]:
    """Totals per day, window, store, segment and customer, written to `path`: a fact for all four analyses.

    The start of a row's window stands for its time, so totals of any window fold to the same windows.
    """
    kind = transactions.schema["timestamp"].dataType
    start = window_start(F.col("timestamp"), window).cast(kind)
    keys = ["date", "timestamp", "store_id", "customer_segment", "customer_id"]
    totals, sums = tally(transactions.withColumn("timestamp", start), keys, "total_amount", moments=True)
    totals.write.parquet(path)
    return transactions.sparkSession.read.schema(totals.schema).parquet(path), sums


def save_analyses(
    transactions: DataFrame,
    stores: DataFrame,
    output_path: str,
    window: str = "1 month",
    amount: str | Sums = "total_amount",
) -> tuple[dict[str, str], Observation]:
    """Writes the four analyses of the star tables; returns their paths by name and the observed statistics."""
    trend = sales_by_time(transactions, window, amount, growth=True)
    trend = trend.withColumn("window_date", F.to_date("window_start"))
    stats, watch = observed(basic_stats(transactions, amount, date="date", ratios=True))
    by_name = {
        "basic_stats": stats,
        "customer_segments": sales_by_segment(transactions, amount, share=True),
        "regional_analysis": regional_star(transactions, stores, amount),
    }
    # One row, one per segment, one per region and state: small whatever the fact is.
    paths = {
        name: save_result(result, output_path, name, one_file=True, json_copy=True) for name, result in by_name.items()
    }
    return paths | {"time_series": save_result(trend, output_path, "time_series", ["window_date"])}, watch


def summary_row(
    stats: DataFrame,
    now: dt.datetime,
    input_path: str,
    output_path: str,
    master_data: dict[str, int],
    paths: dict[str, str],
) -> DataFrame:
    """One row: time, paths, counts, statistics and where the results are."""
    return stats.select(
        F.lit(now.isoformat()).alias("analysis_timestamp"),
        F.lit(input_path).alias("input_path"),
        F.lit(output_path).alias("output_path"),
        F.col("total_transactions").alias("transaction_count"),
        F.struct(*[F.lit(count).cast("bigint").alias(name) for name, count in master_data.items()]).alias(
            "master_data"
        ),
        F.struct(*stats.columns).alias("basic_statistics"),
        F.struct(*[F.lit(path).alias(name) for name, path in paths.items()]).alias("analysis_results"),
    )


def save_dataset_info(profile: DataFrame, path: str, base_path: str) -> str:
    """The one-row dataset profile with the path of the dataset, as JSON at `<path>/dataset_info.json`."""
    target = f"{path.rstrip('/')}/dataset_info.json"
    info = dataset_info(profile).withColumn("base_path", F.lit(base_path))
    info.coalesce(1).write.mode("overwrite").option("ignoreNullFields", "false").json(target)
    return target


def run_profile(spark: SparkSession, input_path: str, output_path: str) -> str:
    """Profiles the star tables below `input_path`."""
    profile = dataset_profile(
        parquet.load_chunks(spark, input_path),
        parquet.load_stores(spark, input_path),
        parquet.load_products(spark, input_path),
    )
    return save_dataset_info(profile, output_path, input_path)


def flat_analyses(sales: DataFrame, window: str = "1 month") -> dict[str, DataFrame]:
    """The six analyses of the flat table by name."""
    return {
        "basic_stats": basic_stats(sales, "transaction_total"),
        "sales_by_segment": sales_by_segment(sales, "transaction_total"),
        "product_performance": product_performance(sales),
        "regional_analysis": regional_flat(sales),
        "time_series": sales_by_date(sales, window),
        "customer_cohorts": customer_cohorts(sales),
    }


def run_flat(spark: SparkSession, input_path: str, output_path: str, window: str = "1 month") -> dict[str, str]:
    """Analyses flat chunks below `input_path`; returns the result paths by name."""
    sales = parquet.load_chunks(spark, input_path, "flat")
    return {
        name: save_result(result, output_path, name) for name, result in flat_analyses(sales, window).items()
    }


def build_flat(spark: SparkSession, input_path: str, output_path: str) -> str:
    """Joins the star tables below `input_path` to flat chunks below `output_path`."""
    stores = parquet.load_stores(spark, input_path)
    products = parquet.load_products(spark, input_path)
    # A repeated store or product would multiply its sales.
    parquet.check_unique(stores, "store_id")
    parquet.check_unique(products, "sku")
    header = parquet.load_chunks(spark, input_path).select(
        "transaction_id", "store_id", "customer_id", "customer_segment", "timestamp"
    )
    items = parquet.load_chunks(spark, input_path, "items").select(
        "transaction_id", "sku", "quantity", "unit_price", "line_total"
    )
    return save_chunks(flatten(items, header, products, stores).select(*FLAT_COLUMNS), output_path)
