"""Connected components of an edge table.

Each task first joins the edges it holds, as many as `EDGES_PER_TASK`, into stars.
What is left over several tasks is joined by alternating star operations: the edges
of every node are turned towards its least neighbour, first for the greater
neighbours, then for the lesser ones, until every edge leads to a root. The
number of rounds grows with the logarithm of the longest chain.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storetally.llm.texts import shared_checkpoint

EDGES_PER_TASK = 400_000


def _roots(left: np.ndarray, right: np.ndarray, count: int) -> np.ndarray:
    """The least node of each node's component; nodes are 0 to count - 1."""
    roots = np.arange(count)
    while True:
        a, b = roots[left], roots[right]
        high, low = np.maximum(a, b), np.minimum(a, b)
        apart = high != low
        if not apart.any():
            return roots
        np.minimum.at(roots, high[apart], low[apart])
        while True:
            jumped = roots[roots]
            if (jumped == roots).all():
                break
            roots = jumped


def _stars(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges from each node of a partition to the root of its component there."""
    held = [batch for batch in batches if batch.num_rows]
    if not held:
        return
    edges = pa.Table.from_batches(held)
    names = pc.unique(pa.chunked_array([*edges.column("u").chunks, *edges.column("v").chunks]))
    names = names.take(pc.sort_indices(names))
    place = [pc.index_in(edges.column(side), names).to_numpy() for side in ("u", "v")]
    roots = _roots(*place, len(names))
    nodes = np.flatnonzero(roots != np.arange(len(names)))
    yield pa.RecordBatch.from_arrays([names.take(pa.array(nodes)), names.take(pa.array(roots[nodes]))], ["u", "v"])


def _least(edges: DataFrame) -> DataFrame:
    """Every edge (u, v) with the least of u and all its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("least"))
    return edges.join(least, "u").select("u", "v", F.least("u", "least").alias("least"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    turned = _least(both).filter("v > u").select(F.col("v").alias("u"), F.col("least").alias("v"))
    return turned.filter("u != v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    starred = _least(down)
    turned = starred.select(F.col("v").alias("u"), F.col("least").alias("v")).union(
        starred.select("u", F.col("least").alias("v"))
    )
    return turned.filter("u != v").distinct()


def components(edges: DataFrame, edges_per_task: int = EDGES_PER_TASK) -> DataFrame:
    """(node, root) for every node of `edges` (columns u, v), root being the least node it reaches.

    NULL nodes and loops are ignored; no edges give no rows. A node that is in
    no edge is its own root and not listed.
    """
    edges = shared_checkpoint(edges.filter("u != v").select("u", "v").distinct())
    tasks = -(-edges.count() // edges_per_task)
    edges = shared_checkpoint(edges.repartition(max(1, tasks)).mapInArrow(_stars, edges.schema).distinct())
    while tasks > 1:
        edges = shared_checkpoint(_small_star(_large_star(edges)))
        # Done when every node has one edge and no root has an edge of its own.
        several = edges.groupBy("u").agg(F.count("*").alias("n")).filter("n > 1")
        if several.isEmpty() and edges.select(F.col("v").alias("u")).join(edges.select("u"), "u", "left_semi").isEmpty():
            break
    roots = edges.select(F.col("v").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return edges.select(F.col("u").alias("node"), F.col("v").alias("root")).union(roots)
