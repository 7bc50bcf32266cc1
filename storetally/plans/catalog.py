"""Registered queries: every analysis, rule, source and sink over the test tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storetally.functions.keys import customer_key, is_hazmat, product_name, sku_key
from storetally.functions.lookups import month_seasonal, region_premium, region_seasonal
from storetally.functions.periods import calendar_parts
from storetally.operators.cohorts import customer_cohorts
from storetally.operators.flatten import FLAT_COLUMNS, flatten
from storetally.operators.headline import basic_stats, mini_stats
from storetally.operators.pricing import header_totals, price_lines
from storetally.operators.products import product_performance
from storetally.operators.profile import dataset_info, dataset_profile
from storetally.operators.regions import regional_by_store, regional_flat, regional_star
from storetally.operators.segments import sales_by_segment
from storetally.operators.sequence import item_sequence
from storetally.operators.trends import sales_by_date, sales_by_time
from storetally.plans.pipeline import run_pipeline, save_dataset_info
from storetally.plans.testdata import (
    TEST_PREMIUM,
    TEST_SEASONAL,
    event_sales,
    flat_sales,
    header,
    items,
    priced_lines,
    products,
    saved_stores,
    star_sales,
    stores,
    table,
    with_places,
)
from storetally.session import remove_at_end, run_folder
from storetally.sinks.facts import save_bucketed, save_chunks, save_clustered, save_partitioned
from storetally.sinks.published import load_all, load_latest, publish, stage
from storetally.sinks.results import observed, observed_metrics, run_metrics, save_result
from storetally.sources.parquet import (
    load_bucketed,
    load_chunks,
    load_filtered,
    load_mixed_chunks,
    load_partitioned,
    load_recursive,
)

Query = Callable[[SparkSession, str], DataFrame]


def _rounded(df: DataFrame, **digits: int) -> DataFrame:
    """Rounds columns whose last binary digit depends on the engine."""
    return df.withColumns({name: F.round(name, n) for name, n in digits.items()})


# Analyses -----------------------------------------------------------------


def basic_stats_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basic_stats(flat_sales(spark, sf_dir, "header"), "transaction_total", one_pass=True)


def basic_stats_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basic_stats(star_sales(spark, sf_dir, "header"), date="date", ratios=True, one_pass=True)


def basic_stats_ratios(spark: SparkSession, sf_dir: str) -> DataFrame:
    return basic_stats(star_sales(spark, sf_dir, "header"), ratios=True, one_pass=True)


def mini_stats_star(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mini_stats(star_sales(spark, sf_dir))


def sales_by_segment_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by_segment(flat_sales(spark, sf_dir, "segments"), "transaction_total")


def sales_by_segment_share(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(sales_by_segment(star_sales(spark, sf_dir, "segments"), share=True), revenue_share=6)


def sales_by_segment_net(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounted amounts: four decimals, so DECIMAL."""
    lines = table(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey AS transaction_id",
        "CAST(l_extendedprice AS DECIMAL(12,2)) * (1 - CAST(l_discount AS DECIMAL(4,2))) AS total_amount",
    )
    net = lines.join(header(spark, sf_dir, segments=True), "transaction_id", "left")
    return _rounded(sales_by_segment(net), total_revenue=4, avg_transaction_value=4)


def product_performance_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product_performance(flat_sales(spark, sf_dir, "products"))


def regional_flat_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regional_flat(flat_sales(spark, sf_dir, "header", "stores"))


def regional_star_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regional_star(star_sales(spark, sf_dir, "header"), saved_stores(spark, sf_dir))


def regional_star_unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Without the stores of one region: its sales are the (NULL, NULL) group."""
    return regional_star(star_sales(spark, sf_dir, "header"), saved_stores(spark, sf_dir, leave_out="ASIA"))


def regional_by_store_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    return regional_by_store(star_sales(spark, sf_dir))


def sales_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by_date(flat_sales(spark, sf_dir, "header"))


def sales_by_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by_date(flat_sales(spark, sf_dir, "header"), "1 quarter")


def monthly_sales_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by_time(star_sales(spark, sf_dir, "header"), growth=True)


def events_in(window: str, growth: bool = False) -> Query:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return sales_by_time(event_sales(spark, sf_dir), window, growth=growth)

    return query


def events_by_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by_date(event_sales(spark, sf_dir), "3 days", "total_amount", "timestamp")


def order_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_cohorts(flat_sales(spark, sf_dir, "header"))


def event_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_cohorts(event_sales(spark, sf_dir), "total_amount", "timestamp")


def _uneven(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events whose amounts have all the digits of a DOUBLE."""
    return event_sales(spark, sf_dir).withColumn("total_amount", F.col("total_amount") / 7)


def uneven_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    kinds = table(spark, sf_dir, "events").select(
        F.col("event_type").alias("customer_segment"),
        F.col("user_id").alias("customer_id"),
        (F.col("value") / 7).alias("total_amount"),
    )
    return sales_by_segment(kinds, share=True)


def uneven_growth(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by_time(_uneven(spark, sf_dir), "6 hours", growth=True)


def uneven_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_cohorts(_uneven(spark, sf_dir), "total_amount", "timestamp")


# Row-level rules ----------------------------------------------------------


def line_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_lines(priced_lines(spark, sf_dir)).select(
        "transaction_id", "line_number", "sku", "store_id", "quantity", "unit_price", "line_total"
    )


def line_discount(spark: SparkSession, sf_dir: str) -> DataFrame:
    return price_lines(priced_lines(spark, sf_dir)).select(
        "transaction_id", "line_number", "sku", "store_id", "quantity", "discount_amount"
    )


LONG_DISCOUNT = {"discount": "l_discount / 7", "without": "PROMO"}


def line_pricing_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Discounts of many digits, and lines without a product."""
    return price_lines(priced_lines(spark, sf_dir, **LONG_DISCOUNT)).select(
        "transaction_id", "line_number", "sku", "store_id", "quantity", "unit_price", "line_total", "discount_amount"
    )


def line_pricing_digits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices of five decimals as DOUBLE, premiums and discounts of many."""
    lines = priced_lines(spark, sf_dir, **LONG_DISCOUNT)
    finer = lines.withColumn("base_price", F.expr("CAST(base_price * 0.001BD AS DOUBLE)"))
    return price_lines(finer).select(
        "transaction_id", "line_number", "sku", "store_id", "quantity", "unit_price", "line_total", "discount_amount"
    )


def header_rollup_long(spark: SparkSession, sf_dir: str) -> DataFrame:
    return header_totals(priced_lines(spark, sf_dir, **LONG_DISCOUNT))


def header_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return header_totals(priced_lines(spark, sf_dir))


def header_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Priced lines, totalled per transaction, analysed by segment."""
    totals = header_totals(priced_lines(spark, sf_dir)).select("transaction_id", "total_amount")
    return sales_by_segment(totals.join(header(spark, sf_dir, segments=True), "transaction_id", "left"))


LINE_ORDER = ["line_number", "sku", "store_id", "line_total", "quantity", "shipped"]


def numbered_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_linenumber").cast("bigint").alias("line_number"),
        F.col("l_partkey").alias("sku"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_extendedprice").alias("line_total"),
        F.col("l_quantity").alias("quantity"),
        F.col("l_shipdate").alias("shipped"),
    )
    return item_sequence(lines, LINE_ORDER)


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", *[part.alias(name) for name, part in calendar_parts(F.col("o_orderdate")).items()]
    )


def event_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        "event_id", *[part.alias(name) for name, part in calendar_parts(F.col("ts")).items()]
    )


def store_premium(spark: SparkSession, sf_dir: str) -> DataFrame:
    return stores(spark, sf_dir).select(
        "store_id",
        "region",
        "state",
        region_premium(F.col("region"), TEST_PREMIUM).cast("double").alias("price_premium"),
        region_seasonal(F.col("region"), TEST_SEASONAL).cast("double").alias("seasonal_multiplier"),
    )


def seasonal_factor(spark: SparkSession, sf_dir: str) -> DataFrame:
    month = F.month("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        month.cast("bigint").alias("month"),
        month_seasonal(month).cast("double").alias("seasonal_factor"),
        # Two months only, the others fall back to 1.
        month_seasonal(month, {1: "0.7", 6: "1.8"}).cast("double").alias("partial_factor"),
    )


def product_attributes(spark: SparkSession, sf_dir: str) -> DataFrame:
    words = F.split("p_name", " ")
    color = F.when(F.col("p_type").isin("ECONOMY", "STANDARD"), words[0]).otherwise("")
    return table(spark, sf_dir, "part").select(
        "p_partkey",
        product_name(F.col("p_brand"), F.col("p_type"), color, words[1], F.col("p_size").cast("string")).alias(
            "product_name"
        ),
        is_hazmat(F.col("p_type"), ("PROMO", "SMALL")).alias("is_hazmat"),
    )


def business_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").select(
        "c_custkey", customer_key(F.col("c_mktsegment"), F.col("c_custkey")).alias("customer_id")
    )


def sku_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select("p_partkey", sku_key(F.col("p_partkey")).alias("sku"))


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_profile(
        table(spark, sf_dir, "orders"), table(spark, sf_dir, "supplier"), table(spark, sf_dir, "part"), "o_orderdate"
    )


def profile_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dataset_info(profile(spark, sf_dir))


def flattened(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat_sales(spark, sf_dir, "segments", "products", "stores").select("transaction_id", *FLAT_COLUMNS)


# Sources and sinks: written below the shared folder, read back ---------------


SPARK_FILES = "part-*.parquet"


def _new_folder(spark: SparkSession, label: str) -> str:
    folder = run_folder(spark, label)
    remove_at_end(spark, folder)
    return folder


def chunked_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = _new_folder(spark, "chunks")
    save_chunks(star_sales(spark, sf_dir, "segments"), folder)
    return regional_by_store(load_chunks(spark, folder))


def filtered_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = save_chunks(star_sales(spark, sf_dir, "segments"), _new_folder(spark, "chunks"))
    return sales_by_segment(load_filtered(spark, path, pattern=SPARK_FILES))


def _by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    parts = calendar_parts(F.col("timestamp"))
    return star_sales(spark, sf_dir, "segments").withColumns({"year": parts["year"], "month": parts["month"]})


def _save_by_month(spark: SparkSession, sf_dir: str) -> str:
    return save_partitioned(_by_month(spark, sf_dir), _new_folder(spark, "partitioned"))


def recursive_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales_by_segment(load_recursive(spark, _save_by_month(spark, sf_dir), pattern=SPARK_FILES))


def partitioned_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        load_partitioned(spark, _save_by_month(spark, sf_dir))
        .groupBy("year", "month")
        .agg(F.count("*").alias("transaction_count"), F.countDistinct("customer_id").alias("unique_customers"))
    )


def pruned_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quarter of the partitioned fact; the other folders are not read."""
    fact = load_partitioned(spark, _save_by_month(spark, sf_dir))
    return sales_by_segment(fact.where((F.col("year") == 1996) & F.col("month").between(4, 6)))


def _buckets(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _bucketed(spark: SparkSession, frame: DataFrame, by: str) -> DataFrame:
    path = save_bucketed(frame, _new_folder(spark, "bucketed"), by, _buckets(spark))
    return load_bucketed(spark, path, by, _buckets(spark))


def bucketed_flat_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The flat table from items and headers in buckets of transactions, joined without a shuffle of either."""
    lines = _bucketed(spark, items(spark, sf_dir), "transaction_id")
    heads = _bucketed(spark, header(spark, sf_dir, segments=True), "transaction_id")
    placed = with_places(spark, sf_dir, flatten(lines, heads, products(spark, sf_dir)))
    return placed.select("transaction_id", *FLAT_COLUMNS)


def bucketed_cohorts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cohorts of a fact in buckets of customers, which is not shuffled by customer again."""
    return customer_cohorts(_bucketed(spark, flat_sales(spark, sf_dir, "header"), "customer_id"))


def _clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact written in ranges of dates, with Bloom filters on customers; ids keep the type that the filters have."""
    fact = star_sales(spark, sf_dir, "segments")
    path = save_clustered(fact, _new_folder(spark, "clustered"), ["date", "transaction_id"], ["customer_id"])
    return spark.read.parquet(path)


def clustered_quarter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One quarter of the clustered fact; row groups of other dates are skipped."""
    return sales_by_segment(_clustered(spark, sf_dir).where("date >= DATE'1996-04-01' AND date < DATE'1996-07-01'"))


def clustered_customer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All sales of one customer, the one with the least id, looked up in the clustered fact."""
    fact = _clustered(spark, sf_dir)
    least = fact.agg(F.min("customer_id")).first()[0]
    found = fact.where(F.col("customer_id") == least)
    return found.select("customer_id", "transaction_id", "sku", "store_id", "quantity", "total_amount", "date")


def saved_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    shares = sales_by_segment(star_sales(spark, sf_dir, "segments"), share=True)
    path = save_result(shares, _new_folder(spark, "saved"), "customer_segments", one_file=True)
    return _rounded(spark.read.parquet(path), revenue_share=6)


def saved_segments_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = sales_by_segment(star_sales(spark, sf_dir, "segments"))
    path = save_result(segments, _new_folder(spark, "saved"), "customer_segments", json_copy=True)
    return spark.read.schema(segments.schema).json(f"{path}_summary.json")


def saved_cohorts_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    cohorts = order_cohorts(spark, sf_dir)
    path = save_result(cohorts, _new_folder(spark, "saved"), "cohorts", json_copy=True)
    return spark.read.schema(cohorts.schema).json(f"{path}_summary.json")


def appended_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two results, one appended to the other."""
    folder = _new_folder(spark, "saved")
    for _ in range(2):
        path = save_result(sales_by_segment(star_sales(spark, sf_dir, "segments")), folder, "segments", mode="append")
    return spark.read.parquet(path)


def rewritten_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The partitioned fact after one month was written again with the sales of one segment only."""
    path = _save_by_month(spark, sf_dir)
    april = (F.col("year") == 1996) & (F.col("month") == 4) & (F.col("customer_segment") == "BUILDING")
    save_partitioned(_by_month(spark, sf_dir).where(april), path, only_present=True)
    return (
        load_partitioned(spark, path)
        .groupBy("year", "month")
        .agg(F.count("*").alias("transaction_count"), F.countDistinct("customer_id").alias("unique_customers"))
    )


def published_segments(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What readers see after a run, a later one that died before its manifest, and the first one repeated."""
    folder = _new_folder(spark, "published")
    segments = sales_by_segment(star_sales(spark, sf_dir, "segments"))
    publish({"segments": segments}, folder, "first")
    stage({"segments": segments.limit(2)}, folder, "second")
    publish({"segments": segments.limit(1)}, folder, "first")
    return load_latest(spark, folder, "segments")


def published_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two runs, one of them repeated: each counts once."""
    folder = _new_folder(spark, "published")
    segments = sales_by_segment(star_sales(spark, sf_dir, "segments"))
    for run in ("a", "b", "a"):
        publish({"segments": segments}, folder, run)
    return load_all(spark, folder, "segments")


def mixed_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Chunks of other types: INT32 stores, times in nanoseconds as BIGINT, amounts as DECIMAL."""
    folder = _new_folder(spark, "mixed")
    sales = star_sales(spark, sf_dir, "segments").withColumn("timestamp", F.col("timestamp").cast("timestamp"))
    own = F.col("transaction_id") % 3
    save_chunks(sales.where(own == 0), folder, "transactions_chunk_0000")
    narrow = sales.where(own == 1).withColumn("store_id", F.col("store_id").cast("int"))
    save_chunks(narrow, folder, "transactions_chunk_0001")
    nanos = sales.where(own == 2).withColumn("timestamp", F.unix_micros("timestamp") * 1000)
    save_chunks(nanos.withColumn("note", F.lit("x")), folder, "transactions_chunk_0002")
    return sales_by_time(load_mixed_chunks(spark, folder).withColumn("timestamp", F.col("timestamp").cast("timestamp_ntz")), growth=True)


def saved_time_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    trend = monthly_sales_growth(spark, sf_dir).withColumn("window_date", F.to_date("window_start"))
    path = save_result(trend, _new_folder(spark, "saved"), "time_series", ["window_date"])
    return spark.read.parquet(path)


def saved_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = save_dataset_info(profile(spark, sf_dir), _new_folder(spark, "profile"), sf_dir)
    info = profile_info(spark, sf_dir)
    return spark.read.schema(info.schema).json(path)


def _pipeline_output(spark: SparkSession, sf_dir: str, **choices: bool) -> str:
    """Runs the whole pipeline on model tables written from the test tables."""
    folder = _new_folder(spark, "pipeline")
    save_chunks(star_sales(spark, sf_dir, "segments"), f"{folder}/input")
    stores(spark, sf_dir).write.parquet(f"{folder}/input/stores_master.parquet")
    products(spark, sf_dir).write.parquet(f"{folder}/input/products_master.parquet")
    run_pipeline(spark, f"{folder}/input", f"{folder}/output", **choices)
    return f"{folder}/output"


def pipeline_statistics(spark: SparkSession, sf_dir: str, **choices: bool) -> DataFrame:
    summary = spark.read.json(f"{_pipeline_output(spark, sf_dir, **choices)}/analysis_summary.json")
    return summary.select(
        "transaction_count",
        "master_data.*",
        *[
            f"basic_statistics.{name}"
            for name in ("total_revenue", "avg_transaction_value", "unique_customers", "active_stores")
        ],
        F.to_date("basic_statistics.date_from").alias("date_from"),
        F.to_date("basic_statistics.date_to").alias("date_to"),
    )


def pipeline_cached(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipeline_statistics(spark, sf_dir, cache=True)


def pipeline_result(name: str, one_scan: bool = False, **digits: int) -> Query:
    """One of the results the pipeline writes."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return _rounded(spark.read.parquet(f"{_pipeline_output(spark, sf_dir, one_scan=one_scan)}/{name}"), **digits)

    return query


def metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return run_metrics(basic_stats_flat(spark, sf_dir))


def metrics_of_write(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics taken while the statistics are written."""
    stats, watch = observed(basic_stats_flat(spark, sf_dir))
    save_result(stats, _new_folder(spark, "saved"), "basic_stats", one_file=True)
    return observed_metrics(spark, watch)


QUERIES: dict[str, Query] = {
    "basic_stats_flat": basic_stats_flat,
    "basic_stats_star": basic_stats_star,
    "basic_stats_ratios": basic_stats_ratios,
    "mini_stats": mini_stats_star,
    "sales_by_segment": sales_by_segment_flat,
    "sales_by_segment_share": sales_by_segment_share,
    "sales_by_segment_net": sales_by_segment_net,
    "product_performance": product_performance_flat,
    "regional_flat": regional_flat_sales,
    "regional_star": regional_star_sales,
    "regional_star_unknown": regional_star_unknown,
    "regional_by_store": regional_by_store_sales,
    "monthly_sales": sales_by_month,
    "quarterly_sales": sales_by_quarter,
    "monthly_sales_growth": monthly_sales_growth,
    "events_daily": events_in("1 day"),
    "events_6h": events_in("6 hours"),
    "events_7d": events_in("7 days"),
    "events_3d_by_date": events_by_date,
    "events_daily_growth": events_in("1 day", growth=True),
    "events_6h_growth": events_in("6 hours", growth=True),
    "customer_cohorts": order_cohorts,
    "event_cohorts": event_cohorts,
    "uneven_segments": uneven_segments,
    "uneven_6h_growth": uneven_growth,
    "uneven_cohorts": uneven_cohorts,
    "line_pricing": line_pricing,
    "line_discount": line_discount,
    "line_pricing_long": line_pricing_long,
    "line_pricing_digits": line_pricing_digits,
    "header_rollup": header_rollup,
    "header_rollup_long": header_rollup_long,
    "header_segments": header_segments,
    "item_sequence": numbered_items,
    "calendar_parts": order_calendar,
    "calendar_parts_events": event_calendar,
    "region_premium": store_premium,
    "seasonal_factor": seasonal_factor,
    "product_attributes": product_attributes,
    "business_keys": business_keys,
    "sku_keys": sku_keys,
    "dataset_profile": profile,
    "dataset_info": profile_info,
    "flat_sales": flattened,
    "run_metrics": metrics,
    "run_metrics_observed": metrics_of_write,
    "chunked_fact": chunked_fact,
    "mixed_chunks": mixed_chunks,
    "rewritten_month": rewritten_month,
    "bucketed_flat_sales": bucketed_flat_sales,
    "bucketed_cohorts": bucketed_cohorts,
    "clustered_quarter": clustered_quarter,
    "clustered_customer": clustered_customer,
    "published_segments": published_segments,
    "published_twice": published_twice,
    "filtered_fact": filtered_fact,
    "recursive_fact": recursive_fact,
    "partitioned_fact": partitioned_fact,
    "saved_segments": saved_segments,
    "saved_segments_json": saved_segments_json,
    "pruned_fact": pruned_fact,
    "saved_cohorts_json": saved_cohorts_json,
    "appended_segments": appended_segments,
    "saved_time_series": saved_time_series,
    "saved_profile": saved_profile,
    "pipeline_statistics": pipeline_statistics,
    "pipeline_cached": pipeline_cached,
    "pipeline_basic_stats": pipeline_result("basic_stats"),
    "pipeline_segments": pipeline_result("customer_segments", revenue_share=6),
    "pipeline_regions": pipeline_result("regional_analysis"),
    "pipeline_time_series": pipeline_result("time_series"),
    "pipeline_one_scan_stats": pipeline_result("basic_stats", one_scan=True),
    "pipeline_one_scan_segments": pipeline_result("customer_segments", one_scan=True, revenue_share=6),
    "pipeline_one_scan_regions": pipeline_result("regional_analysis", one_scan=True),
    "pipeline_one_scan_series": pipeline_result("time_series", one_scan=True),
}
