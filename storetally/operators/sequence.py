"""Numbering of the lines within a transaction."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from storetally.session import remove_at_end, run_folder


def item_sequence(items: DataFrame, order_by: Sequence[str], key: str = "transaction_id") -> DataFrame:
    """Adds `item_sequence`, 1.. within `key` in the total order `order_by` (NULL first, as Spark sorts).

    The lines are cut by ranges of (key, order_by) into slices of similar size,
    so a transaction with a large share of the table spans several slices, and
    written once with the number of their slice. Each slice numbers its lines by
    itself. Only the transactions at the borders of slices, two for each slice at
    most, need the sizes of the slices before. Lines without a key get no number.
    """
    spark = items.sparkSession
    folder = run_folder(spark, "slices")
    items.repartitionByRange(key, *order_by).withColumn("slice", F.spark_partition_id()).write.parquet(folder)
    remove_at_end(spark, folder)
    rows = spark.read.parquet(folder)

    ends = rows.where(F.col(key).isNotNull()).groupBy("slice").agg(F.min(key).alias("low"), F.max(key).alias("high"))
    border = ends.select(F.explode(F.array("low", "high")).alias(key)).distinct()
    # Bounded by twice the number of slices.
    sizes = rows.select(key, "slice").join(F.broadcast(border), key).groupBy(key, "slice").agg(F.count("*").alias("n"))
    before = Window.partitionBy(key).orderBy("slice").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select(key, "slice", F.sum("n").over(before).alias("rows_before")).where("rows_before > 0")
    in_slice = F.row_number().over(Window.partitionBy(key, "slice").orderBy(*order_by))
    number = F.col("in_slice") + F.coalesce("rows_before", F.lit(0))
    return (
        rows.withColumn("in_slice", F.when(F.col(key).isNotNull(), in_slice))
        .join(F.broadcast(offsets), [key, "slice"], "left")
        .select(*items.columns, F.when(F.col(key).isNotNull(), number).alias("item_sequence"))
    )
