"""Sums and deviations of amounts of any digits against fractions."""

import random
import statistics
from decimal import Decimal
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from conftest import SF_DIR
from storetally.functions.exact import summed, tally
from storetally.operators.cohorts import customer_cohorts
from storetally.operators.headline import basic_stats
from storetally.operators.regions import regional_flat
from storetally.operators.segments import sales_by_segment
from storetally.plans.testdata import event_sales

RNG = random.Random(3)
MAKERS = {
    "sevenths": lambda: RNG.random() * 100 / 7,
    "tiny": lambda: RNG.uniform(-1, 1) * 1e-7,
    "large": lambda: RNG.uniform(-1e17, 1e17),
    "cents": lambda: round(RNG.uniform(-500, 500), 2),
    "mixed": lambda: RNG.choice([1e9 / 3, -1e9 / 3, 1e-5 / 3, 0.1, 0.3, 0.1 + 0.2]),
    "millions": lambda: RNG.uniform(-1e6, 1e6),
    "cancelling": lambda: RNG.choice([1e15 / 3, -1e15 / 3]),
}


def expected(values):
    cents = [round(v * 100) for v in values if round(v * 100) / 100 == v and abs(v) < 9e13]
    rest = [Fraction(round(Fraction(v) * 2**78), 2**78) for v in values if not (round(v * 100) / 100 == v and abs(v) < 9e13)]
    return sum(cents) / 100 + float(sum(rest, Fraction(0))) if rest else sum(cents) / 100


@pytest.mark.parametrize("kind", MAKERS)
def test_sums_equal_fractions(spark, kind):
    rows = [(i % 3, MAKERS[kind]() if i % 17 else None) for i in range(500)]
    frame = spark.createDataFrame(rows, "g int, x double")
    priced, sums = summed(frame, "x", ["g"])
    found = priced.groupBy("g").agg(*sums.totals()).select("g", "priced", sums.total().alias("t")).collect()
    for row in found:
        own = [x for g, x in rows if g == row["g"] and x is not None]
        assert (row["priced"], row["t"]) == (len(own), expected(own))


@pytest.mark.parametrize("kind", ["sevenths", "cents", "mixed", "millions"])
def test_deviation(spark, kind):
    rows = [(i % 3, MAKERS[kind]()) for i in range(300)] + [(7, 1.5)]
    frame = spark.createDataFrame(rows, "customer_segment int, total_amount double").withColumn("customer_id", F.lit(1))
    found = {row["customer_segment"]: row["transaction_stddev"] for row in sales_by_segment(frame, share=True).collect()}
    assert found.pop(7) is None
    for group, deviation in found.items():
        own = [Fraction(x) for g, x in rows if g == group]
        assert deviation == pytest.approx(statistics.stdev(own), rel=1e-9 if kind != "cents" else 1e-15)


def test_deviation_of_decimals_and_large_amounts(spark):
    values = [Decimal("1.2345"), Decimal("7.5"), Decimal("-3.0001")]
    frame = spark.createDataFrame([(1, 1, v) for v in values], "customer_segment int, customer_id int, total_amount decimal(12,4)")
    (row,) = sales_by_segment(frame, share=True).collect()
    assert row["transaction_stddev"] == pytest.approx(float(statistics.stdev(values)), rel=1e-12)
    values = [5e7, 6e8 + 0.25, 0.01, 9e8]
    frame = spark.createDataFrame([(1, 1, v) for v in values], "customer_segment int, customer_id int, total_amount double")
    (row,) = sales_by_segment(frame, share=True).collect()
    assert row["transaction_stddev"] == pytest.approx(statistics.stdev(values), rel=1e-14)


def analyses(frame):
    yield sales_by_segment(frame.withColumnRenamed("event_type", "customer_segment"), share=True)
    yield regional_flat(frame.selectExpr("*", "event_type AS region", "'x' AS state"), "total_amount")
    yield customer_cohorts(frame, "total_amount", "timestamp")
    yield basic_stats(frame, one_pass=True)
    yield basic_stats(frame)


def test_partitions_do_not_matter(spark):
    source = event_sales(spark, SF_DIR).join(
        spark.read.parquet(f"{SF_DIR}/events.parquet").select(F.col("event_id").alias("transaction_id"), "event_type"),
        "transaction_id",
    )
    frame = source.selectExpr("customer_id", "timestamp", "total_amount / 7 AS total_amount", "event_type", "customer_id % 9 AS store_id")
    found = []
    for parts, order in ((1, "total_amount"), (7, "timestamp"), (23, "customer_id")):
        mixed = frame.repartition(parts, order).sortWithinPartitions(order)
        found.append([sorted(map(tuple, one.collect()), key=str) for one in analyses(mixed)])
    assert found[0] == found[1] == found[2]


def test_totals_of_totals(spark):
    rows = [(i % 2, i % 5, i % 7, MAKERS["sevenths"]()) for i in range(400)]
    frame = spark.createDataFrame(rows, "customer_segment int, customer_id int, store_id int, total_amount double")
    totals, sums = tally(frame, ["customer_segment", "customer_id", "store_id"], "total_amount", moments=True)
    assert sorted(sales_by_segment(totals, sums, share=True).collect()) == sorted(sales_by_segment(frame, share=True).collect())
    assert basic_stats(totals, sums, ratios=True).collect() == basic_stats(frame, ratios=True).collect()


@pytest.mark.parametrize("value", [float("nan"), float("inf"), 1e300])
def test_no_number_is_refused(spark, value):
    frame = spark.createDataFrame([(1.0,), (value,)], "total_amount double").withColumn("store_id", F.lit(1))
    with pytest.raises(Exception, match="CAST_OVERFLOW|overflow"):
        basic_stats(frame.withColumn("customer_id", F.lit(1))).collect()
