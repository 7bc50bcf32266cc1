"""Physical plans: what must and must not occur in them."""

import contextlib
import io

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from storetally.operators.regions import regional_star
from storetally.operators.trends import sales_by_time
from storetally.plans.catalog import QUERIES
from storetally.plans.testdata import event_sales
from storetally.operators.cohorts import customer_cohorts
from storetally.operators.flatten import flatten
from storetally.operators.headline import basic_stats
from storetally.plans.testdata import star_sales, table
from storetally.sinks.facts import save_clustered


def plan_of(df) -> str:
    out = io.StringIO()
    with contextlib.redirect_stdout(out):
        df.explain("formatted")
    return out.getvalue()


@contextlib.contextmanager
def settings(spark, **values):
    before = {key: spark.conf.get(key) for key in values}
    for key, value in values.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.set(key, value)


WRITING = {"chunked_fact", "filtered_fact", "recursive_fact", "partitioned_fact", "pruned_fact", "appended_segments"}
WRITING |= {"mixed_chunks", "rewritten_month", "published_segments", "published_twice", "run_metrics_observed"}
WRITING |= {"bucketed_flat_sales", "bucketed_cohorts", "clustered_quarter", "clustered_customer"}
WRITING |= {"item_sequence", "regional_star", "regional_star_unknown"} | {n for n in QUERIES if n.startswith("pipeline_")}


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n not in WRITING and "saved" not in n))
def test_no_cross_joins_and_no_python(spark, name):
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        plan = plan_of(QUERIES[name](spark, SF_DIR))
    for unwanted in ("CartesianProduct", "BroadcastNestedLoopJoin", "Python", "Pandas"):
        assert unwanted not in plan


def test_headline_reads_only_its_columns_once_each(spark):
    plan = plan_of(basic_stats(star_sales(spark, SF_DIR, "header"), date="date"))
    assert "Expand" not in plan
    assert "c_mktsegment" not in plan and "l_comment" not in plan and "l_partkey" not in plan
    schemas = [line for line in plan.splitlines() if line.startswith("ReadSchema")]
    assert "ReadSchema: struct<l_orderkey:bigint>" in schemas


def test_filter_reaches_the_scan(spark):
    plan = plan_of(table(spark, SF_DIR, "events").where(F.col("value") > 5).select("event_id"))
    assert "GreaterThan(value,5.0)" in plan


def test_cohorts_total_days_before_the_shuffle(spark):
    plan = plan_of(customer_cohorts(star_sales(spark, SF_DIR, "header"), "total_amount", "timestamp"))
    # Day totals, one row per customer, cohort cells, and the sort.
    assert plan.count("hashpartitioning(customer_id") == 2
    assert sum("partial_sum" in line for line in plan.splitlines()) == 3


def test_hot_transaction_is_split_in_the_join(spark, tmp_path):
    """AQE cuts the join partition that holds a third of all lines."""
    lines = spark.range(600_000).select(
        F.when(F.col("id") % 3 == 0, F.lit(-1)).otherwise(F.col("id") % 40_000).alias("transaction_id"),
        F.col("id").alias("sku"),
        F.lit(1).cast("bigint").alias("quantity"),
        F.rand(1).alias("line_total"),
        F.lit(2.0).alias("unit_price"),
    )
    lines.repartition(40).write.parquet(str(tmp_path / "items"))
    header = (
        spark.range(-1, 40_000)
        .withColumnRenamed("id", "transaction_id")
        .withColumn("timestamp", F.lit("2024-01-01").cast("timestamp_ntz"))
    )
    header.write.parquet(str(tmp_path / "header"))
    small = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "200KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "200KB",
    }
    with settings(spark, **small):
        flat = flatten(spark.read.parquet(str(tmp_path / "items")), spark.read.parquet(str(tmp_path / "header")))
        totals = flat.groupBy("transaction_date").agg(
            F.count("*").alias("lines"), F.countDistinct("sku").alias("skus"), F.sum("transaction_total").alias("total")
        )
        (found,) = totals.collect()
        assert "skew=true" in plan_of(totals)
    assert (found["lines"], found["skus"]) == (600_000, 600_000)


@pytest.mark.parametrize("name", ["regional_flat", "flat_sales", "line_pricing", "line_discount", "header_rollup", "header_segments"])
def test_the_fact_is_not_shuffled_by_store(spark, name):
    """With Spark's own broadcast threshold."""
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    assert "hashpartitioning(l_suppkey" not in plan and "hashpartitioning(store_id" not in plan


def test_regions_of_many_stores_are_broadcast(spark, tmp_path):
    spark.range(12_000).selectExpr(
        "id AS store_id", "concat('R', id % 6) AS region", "concat('S', id % 50) AS state"
    ).coalesce(1).write.parquet(str(tmp_path / "stores"))
    spark.range(100_000).selectExpr(
        "id AS transaction_id", "id % 13000 AS store_id", "id % 500 AS customer_id", "1.5D AS total_amount"
    ).write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    found = regional_star(fact, spark.read.parquet(str(tmp_path / "stores")))
    assert "hashpartitioning(store_id" not in plan_of(found)
    assert found.where("region IS NULL").count() == 1


def test_growth_below_a_day_reads_the_fact_once(spark):
    growth = sales_by_time(event_sales(spark, SF_DIR), "6 hours", growth=True)
    growth.collect()
    final = growth._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan parquet") == 1


def test_buckets_are_joined_and_grouped_without_a_shuffle(spark):
    """Neither side of the join, nor the fact by customer, is dealt out again."""
    with settings(spark, **{"spark.sql.autoBroadcastJoinThreshold": "-1"}):
        flat, cohorts = (plan_of(QUERIES[name](spark, SF_DIR)) for name in ("bucketed_flat_sales", "bucketed_cohorts"))
    assert "hashpartitioning(transaction_id" not in flat and flat.count("Bucketed: true") == 2
    assert "hashpartitioning(customer_id" not in cohorts and "CartesianProduct" not in flat + cohorts


def rows_scanned(df) -> int:
    """Rows of the row groups that the scan did not skip."""
    df.collect()
    scan = df._jdf.queryExecution().executedPlan().collectLeaves().head()
    return scan.metrics().apply("numOutputRows").value()


def test_clustered_fact_is_skipped(spark, tmp_path):
    path = save_clustered(
        star_sales(spark, SF_DIR, "header"), str(tmp_path / "fact"), ["date", "transaction_id"], ["customer_id"], rows=1000
    )
    fact = spark.read.parquet(path)
    customer = fact.where("customer_id = 4")
    assert 0 < customer.count() <= rows_scanned(customer) < 60_000 / 2
    april = fact.where("date >= DATE'1996-04-01' AND date < DATE'1996-05-01'")
    assert 0 < april.count() <= rows_scanned(april) < 60_000 / 10
    assert fact.count() == 60_000
