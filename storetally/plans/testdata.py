"""The model tables, derived from the TPC-H-like test tables.

One line item is one sale: the supplier is the store, the part the product, the
order the transaction. Columns not needed by a query are pruned by Spark; joins
are not, so each query names the sides it needs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from storetally.functions.lookups import region_premium
from storetally.functions.money import amount, cents
from storetally.operators.flatten import flatten
from storetally.schemas import declared
from storetally.session import remove_at_end, run_folder
from storetally.sources.parquet import load_stores

TABLES = {
    "region": declared(r_regionkey="int", r_name="string"),
    "nation": declared(n_nationkey="int", n_name="string", n_regionkey="int"),
    "customer": declared(
        c_custkey="bigint", c_name="string", c_nationkey="int", c_acctbal="double", c_mktsegment="string"
    ),
    "supplier": declared(s_suppkey="bigint", s_name="string", s_nationkey="int", s_acctbal="double"),
    "part": declared(
        p_partkey="bigint", p_name="string", p_brand="string", p_type="string", p_size="int", p_retailprice="double"
    ),
    "orders": declared(
        o_orderkey="bigint",
        o_custkey="bigint",
        o_orderstatus="string",
        o_totalprice="double",
        o_orderdate="timestamp_ntz",
        o_orderpriority="string",
    ),
    "lineitem": declared(
        l_orderkey="bigint",
        l_partkey="bigint",
        l_suppkey="bigint",
        l_linenumber="int",
        l_quantity="double",
        l_extendedprice="double",
        l_discount="double",
        l_tax="double",
        l_returnflag="string",
        l_linestatus="string",
        l_shipdate="timestamp_ntz",
    ),
    "events": declared(
        event_id="bigint", ts="timestamp_ntz", user_id="bigint", event_type="string", value="double", props="string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A test table; the declared schema saves the job that reads one from a footer."""
    return spark.read.schema(TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def unit_price(total_cents: Column, quantity: Column) -> Column:
    """Total over quantity, rounded half up to cents in whole numbers."""
    doubled = total_cents * 2 + quantity
    return amount(F.floor(doubled / (quantity * 2)))


def items(spark: SparkSession, sf_dir: str) -> DataFrame:
    quantity = F.col("l_quantity").cast("bigint")
    lines = table(spark, sf_dir, "lineitem")
    return lines.select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_partkey").alias("sku"),
        F.col("l_suppkey").alias("store_id"),
        quantity.alias("quantity"),
        unit_price(cents(lines, "l_extendedprice"), quantity).alias("unit_price"),
        F.col("l_extendedprice").alias("line_total"),
    )


def header(spark: SparkSession, sf_dir: str, segments: bool = False) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("transaction_id"),
        F.col("o_custkey").alias("customer_id"),
        F.col("o_orderdate").alias("timestamp"),
    )
    if not segments:
        return orders
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("customer_id"), F.col("c_mktsegment").alias("customer_segment")
    )
    return orders.join(customers, "customer_id", "left")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku"),
        F.col("p_type").alias("category"),
        F.col("p_retailprice").alias("base_price"),
    )


def stores(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    return (
        table(spark, sf_dir, "supplier")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"))
        .select(
            F.col("s_suppkey").alias("store_id"), F.col("r_name").alias("region"), F.col("n_name").alias("state")
        )
    )


def with_places(spark: SparkSession, sf_dir: str, sales: DataFrame) -> DataFrame:
    """Adds region and state by store_id, one plain table after the other.

    Spark estimates a joined dimension as the product of its sides and would
    shuffle the fact for it; each of these tables is broadcast by its own size.
    """
    supplier, nation, region = (table(spark, sf_dir, name) for name in ("supplier", "nation", "region"))
    return (
        sales.join(supplier.select(F.col("s_suppkey").alias("store_id"), "s_nationkey"), "store_id", "left")
        .join(nation, F.col("s_nationkey") == F.col("n_nationkey"), "left")
        .join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
        .select(*sales.columns, F.col("r_name").alias("region"), F.col("n_name").alias("state"))
    )


def saved_stores(spark: SparkSession, sf_dir: str, leave_out: str | None = None) -> DataFrame:
    """The stores as a master file, as the analyses find them; `leave_out` is a region without its stores."""
    path = run_folder(spark, "stores")
    derived = stores(spark, sf_dir)
    if leave_out:
        derived = derived.where(F.col("region") != leave_out)
    derived.write.parquet(f"{path}/stores_master.parquet")
    remove_at_end(spark, path)
    return load_stores(spark, path)


def flat_sales(spark: SparkSession, sf_dir: str, *sides: str) -> DataFrame:
    """Flat table with the sides named: header, segments, products, stores."""
    flat = flatten(
        items(spark, sf_dir),
        header(spark, sf_dir, "segments" in sides) if {"header", "segments"} & set(sides) else None,
        products(spark, sf_dir) if "products" in sides else None,
    )
    return with_places(spark, sf_dir, flat) if "stores" in sides else flat


def star_sales(spark: SparkSession, sf_dir: str, *sides: str) -> DataFrame:
    """Fact of the star form: total_amount, timestamp, date."""
    flat = flat_sales(spark, sf_dir, *sides).withColumnRenamed("transaction_total", "total_amount")
    if "transaction_date" not in flat.columns:
        return flat
    return flat.withColumnRenamed("transaction_date", "timestamp").withColumn("date", F.to_date("timestamp"))


def event_sales(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as sales with a time of day."""
    return table(spark, sf_dir, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("customer_id"),
        F.col("ts").alias("timestamp"),
        F.col("value").alias("total_amount"),
    )


# Stand-in factors for the regions of the test tables; the others have none.
TEST_PREMIUM = {"AMERICA": "1.15", "EUROPE": "1.25", "ASIA": "0.95"}
TEST_SEASONAL = {"AMERICA": "0.6", "EUROPE": "0.7"}


def priced_lines(spark: SparkSession, sf_dir: str, discount: str | None = None, without: str | None = None) -> DataFrame:
    """Lines with list price, regional premium, discount and quantity.

    Prices and discounts of the tables are amounts of two decimals, so they are
    declared as such; `discount` is another expression for the discount, kept as it is. `without`
    leaves out the products of one type, whose lines have no price.
    """
    lines = table(spark, sf_dir, "lineitem").select(
        F.col("l_orderkey").alias("transaction_id"),
        F.col("l_linenumber").cast("bigint").alias("line_number"),
        F.col("l_partkey").alias("sku"),
        F.col("l_suppkey").alias("store_id"),
        F.col("l_quantity").cast("bigint").alias("quantity"),
        (F.expr(discount) if discount else F.col("l_discount").cast("decimal(15,2)")).alias("discount_pct"),
    )
    listed = products(spark, sf_dir)
    if without:
        listed = listed.where(F.col("category") != without)
    listed = listed.select("sku", F.col("base_price").cast("decimal(15,2)").alias("base_price"))
    premium = region_premium(F.col("region"), TEST_PREMIUM).alias("price_premium")
    placed = with_places(spark, sf_dir, lines.join(listed, "sku", "left"))
    return placed.select(*lines.columns, "base_price", premium)
