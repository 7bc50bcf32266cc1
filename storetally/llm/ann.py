"""Approximate nearest neighbours by a navigable small-world graph per shard.

Vectors are dealt out to shards by a hash, so that copies of one vector spread.
A shard keeps its distinct vectors in a hierarchical graph stored as flat
neighbour arrays: vectors are numbered so that each layer is a prefix of the one
below; a vector is linked to near vectors of lesser number that are not nearer to each other,
and these back to it. A search descends from the top layer, keeping a beam of
the best vectors met. The nearest of all shards are merged, ranked by the exact
cosine of the original vectors.

Graphs and blocks of queries are written once. A task takes a run of graphs and a
run of blocks from these tables, holds one graph at a time and gives the nearest of
its whole run, so nothing but these is shuffled. The runs grow with the square
root of the table.
"""

from __future__ import annotations

from collections.abc import Iterator
from math import isqrt

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storetally.llm.texts import shared_table, table

SHARD_ROWS = 4096
BLOCK_ROWS = 1024
# Links of a vector: chosen on its own, kept in the lowest and in the other layers.
CHOSEN = 16
LOWEST = 32
CANDIDATES = 64
BEAM = 96
# Vectors that are linked at once, pairs that are compared at once.
BUILD_ROWS = 256
SCORE_ROWS = 1 << 15
# Queries that walk through a graph at once.
SEARCH_ROWS = 128
# Vectors of its beam that a query goes on from at once.
STEPS = 16
# Graphs that a reader may hold at once, in a file; one at least.
FILE_BYTES = 4 << 20
NO_ID = np.iinfo(np.int64).min


def _diverse(near: np.ndarray, sims: np.ndarray, vectors: np.ndarray, most: int) -> np.ndarray:
    """For each row, of `near` (nearest first, then -1) those nearer to the centre than to any chosen before.

    Filled up with the nearest, in order, -1 where there are fewer than `most`.
    """
    rows, width = near.shape
    found = np.full((rows, most), -1, dtype=np.int64)
    if width <= most:
        found[:, :width] = near
        return found
    own = vectors[near]
    between = own @ own.transpose(0, 2, 1)
    real = near >= 0
    closest = np.full((rows, width), -np.inf, dtype=sims.dtype)
    chosen = np.zeros((rows, width), dtype=bool)
    count = np.zeros(rows, dtype=np.int64)
    for place in range(width):
        add = np.flatnonzero(real[:, place] & (sims[:, place] > closest[:, place]) & (count < most))
        if len(add):
            chosen[add, place] = True
            count[add] += 1
            closest[add] = np.maximum(closest[add], between[add, place])
    rest = real & ~chosen
    chosen |= rest & (np.cumsum(rest, axis=1) <= (most - count)[:, None])
    row, place = np.nonzero(chosen)
    found[row, (np.cumsum(chosen, axis=1) - 1)[row, place]] = near[row, place]
    return found


def build_layer(vectors: np.ndarray, links: int) -> np.ndarray:
    """Neighbours of each vector, -1 where there are fewer than `links`."""
    size = len(vectors)
    pairs: list[np.ndarray] = []
    for begin in range(0, size, BUILD_ROWS):
        stop = min(begin + BUILD_ROWS, size)
        sims = vectors[begin:stop] @ vectors[:stop].T
        sims[np.arange(stop)[None, :] >= np.arange(begin, stop)[:, None]] = -np.inf
        count = min(CANDIDATES, stop)
        near = np.argpartition(-sims, count - 1, axis=1)[:, :count]
        found = np.take_along_axis(sims, near, axis=1)
        order = np.argsort(-found, axis=1, kind="stable")
        near, found = np.take_along_axis(near, order, axis=1), np.take_along_axis(found, order, axis=1)
        near[found == -np.inf] = -1
        chosen = _diverse(near, found, vectors, CHOSEN)
        row, place = np.nonzero(chosen >= 0)
        pairs.append(np.stack([row + begin, chosen[row, place]]))
    one, other = np.concatenate(pairs, axis=1)
    centre, linked = np.concatenate([one, other]), np.concatenate([other, one])
    sims = np.empty(len(centre), dtype=vectors.dtype)
    for begin in range(0, len(centre), SCORE_ROWS):
        part = slice(begin, begin + SCORE_ROWS)
        sims[part] = np.einsum("ij,ij->i", vectors[centre[part]], vectors[linked[part]])
    order = np.lexsort((-sims, centre))
    centre, linked, sims = centre[order], linked[order], sims[order]
    starts = np.searchsorted(centre, np.arange(size + 1))
    lengths = np.diff(starts)
    found = np.full((size, links), -1, dtype=np.int32)
    # Rows of like length together, so that a vector with very many links fills up no others.
    by_length = np.argsort(lengths, kind="stable")
    begin = 0
    while begin < size:
        width = int(lengths[by_length[begin]]) * 3 // 2 + links
        stop = begin + max(1, min(BUILD_ROWS, CANDIDATES * CANDIDATES * BUILD_ROWS // (width * width)))
        rows = by_length[begin:stop]
        rows = rows[lengths[rows] <= width]
        places = starts[rows][:, None] + np.arange(lengths[rows].max())
        real = places < starts[rows + 1][:, None]
        places[~real] = 0
        found[rows] = _diverse(np.where(real, linked[places], -1), np.where(real, sims[places], -np.inf), vectors, links)
        begin += len(rows)
    return found


def layer_sizes(size: int) -> list[int]:
    """Vectors in each layer from the lowest; each has one in CHOSEN of those below."""
    sizes = [size]
    while sizes[-1] > CHOSEN:
        sizes.append(-(-sizes[-1] // CHOSEN))
    return sizes


def _beam(vectors: np.ndarray, links: np.ndarray, queries: np.ndarray, start: np.ndarray, width: int) -> np.ndarray:
    """The `width` best vectors met by each query, from its vectors `start` (-1: none) on."""
    count, stride = len(queries), len(vectors) + 1
    rows = np.arange(count)
    # Which of the vectors found at once was the first to meet a vector; the last column is for none.
    met = np.full(count * stride, -1, dtype=np.int32)
    met[(rows[:, None] * stride + start % stride).ravel()] = 0
    met[stride - 1 :: stride] = 0
    ids = np.full((count, width), -1, dtype=np.int64)
    sims = np.full((count, width), -np.inf, dtype=np.float32)
    ids[:, : start.shape[1]] = start
    known = np.einsum("qij,qj->qi", vectors[start], queries)
    sims[:, : start.shape[1]] = np.where(start >= 0, known, -np.inf)
    done = sims == -np.inf
    while True:
        active = np.flatnonzero(~done.all(axis=1))
        if not len(active):
            return ids
        waiting = np.where(done[active], -np.inf, sims[active])
        steps = min(STEPS, width)
        best = np.argpartition(-waiting, steps - 1, axis=1)[:, :steps]
        side = np.arange(len(active))[:, None]
        real = waiting[side, best] > -np.inf
        nodes = np.where(real, ids[active[:, None], best], 0)
        done[active[:, None], best] = True
        near = np.where(real[:, :, None], links[nodes], -1).reshape(len(active), -1)
        keys = (active[:, None] * stride + near % stride).ravel()
        unmet = np.flatnonzero(met[keys] < 0)
        keys = keys[unmet]
        met[keys] = np.arange(len(keys), dtype=np.int32)
        unmet = unmet[met[keys] == np.arange(len(keys), dtype=np.int32)]
        row, place = np.divmod(unmet, near.shape[1])
        counts = np.bincount(row, minlength=len(active))
        if not len(row):
            continue
        # The fresh ones to the left.
        fresh = np.full((len(active), counts.max()), -1, dtype=np.int64)
        fresh[row, np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)] = near[row, place]
        found = (vectors[fresh] @ queries[active][:, :, None])[:, :, 0]
        found[fresh < 0] = -np.inf
        all_sims = np.concatenate([sims[active], found], axis=1)
        all_ids = np.concatenate([ids[active], fresh], axis=1)
        all_done = np.concatenate([done[active], fresh < 0], axis=1)
        top = np.argpartition(-all_sims, width - 1, axis=1)[:, :width]
        sims[active], ids[active], done[active] = all_sims[side, top], all_ids[side, top], all_done[side, top]


def search_graph(vectors: np.ndarray, layers: list[np.ndarray], queries: np.ndarray, width: int = BEAM) -> np.ndarray:
    """Numbers of the best vectors met by each unit query, -1 where there are fewer; in no order."""
    result = np.full((len(queries), width), -1, dtype=np.int64)
    for begin in range(0, len(queries), SEARCH_ROWS):
        part = queries[begin : begin + SEARCH_ROWS]
        found = np.zeros((len(part), 1), dtype=np.int64)
        for depth in range(len(layers) - 1, -1, -1):
            links = layers[depth]
            found = _beam(vectors[: len(links)], links, part, found, width if not depth else 8)
        result[begin : begin + SEARCH_ROWS] = found
    return result


def _units(vectors: np.ndarray) -> np.ndarray:
    return (vectors / np.linalg.norm(vectors, axis=1, keepdims=True)).astype(np.float32)


def _matrix(column: pa.ChunkedArray) -> np.ndarray:
    values = column.combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1)


def _build(kept: int):
    def build(group: pa.Table) -> pa.Table:
        """One row: the distinct vectors in layer order, their links, and the least ids of each vector."""
        shard, width = group.column("shard")[0].as_py(), group.column("width")[0].as_py()
        group = group.sort_by("vec_id")
        ids = group.column("vec_id").to_numpy()
        vectors = _matrix(group.column("vector"))
        distinct, of = np.unique(vectors, axis=0, return_inverse=True)
        of = of.ravel()
        # The least `kept` ids of each distinct vector; ids are sorted.
        order = np.argsort(of, kind="stable")
        pairs = np.unique(np.stack([of[order], ids[order]]), axis=1)
        starts = np.searchsorted(pairs[0], np.arange(len(distinct) + 1))
        rank = np.arange(pairs.shape[1]) - starts[pairs[0]]
        members = np.full((len(distinct), kept), NO_ID, dtype=np.int64)
        near = rank < kept
        members[pairs[0][near], rank[near]] = pairs[1][near]
        shuffled = np.random.Generator(np.random.PCG64(11)).permutation(len(distinct))
        distinct, members = distinct[shuffled], members[shuffled]
        units = _units(distinct)
        layers = [
            build_layer(units[:size], CHOSEN if depth else LOWEST) for depth, size in enumerate(layer_sizes(len(distinct)))
        ]
        return pa.table(
            {
                "shard": [shard],
                "width": [width],
                "vectors": [distinct.tobytes()],
                "members": [members.tobytes()],
                "layers": [[layer.tobytes() for layer in layers]],
            }
        )

    return build


class _Graph:
    """One shard as `_build` gives it."""

    def __init__(self, width: int, vectors: bytes, members: bytes, layers: list[bytes]) -> None:
        self.vectors = np.frombuffer(vectors).reshape(-1, width)
        self.members = np.frombuffer(members, dtype=np.int64).reshape(len(self.vectors), -1)
        self.members = self.members[:, (self.members != NO_ID).any(axis=0)]
        self.layers = [
            np.frombuffer(layer, dtype=np.int32).reshape(-1, CHOSEN if depth else LOWEST)
            for depth, layer in enumerate(layers)
        ]
        self.units = _units(self.vectors)
        self.norms = np.sqrt((self.vectors * self.vectors).sum(axis=1))

    def nearest(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Ids and scores of all that the queries met, NO_ID where there are fewer."""
        met = search_graph(self.units, self.layers, _units(queries))
        scores = np.empty(met.shape)
        step = max(1, SCORE_ROWS // met.shape[1])
        for begin in range(0, len(queries), step):
            part = slice(begin, begin + step)
            # Not by BLAS, whose last digit changes with the place: equal vectors have equal scores.
            scores[part] = np.einsum("qij,qj->qi", self.vectors[met[part]], queries[part])
        scores /= self.norms[met] * np.sqrt((queries * queries).sum(axis=1))[:, None]
        ids = np.where((met >= 0)[:, :, None], self.members[met], NO_ID)
        return ids.reshape(len(queries), -1), np.repeat(scores, ids.shape[2], axis=1)


def _best(ids: np.ndarray, scores: np.ndarray, nearest: int) -> tuple[np.ndarray, np.ndarray]:
    """The `nearest` best of each row: an id once, with its best score; NO_ID where there are fewer."""
    scores = np.where(ids == NO_ID, -np.inf, scores)
    order = np.lexsort((-scores, ids), axis=1)
    ids, scores = np.take_along_axis(ids, order, axis=1), np.take_along_axis(scores, order, axis=1)
    again = ids[:, 1:] == ids[:, :-1]
    ids[:, 1:][again] = NO_ID
    scores[:, 1:][again] = -np.inf
    order = np.lexsort((ids, -scores), axis=1)[:, :nearest]
    return np.take_along_axis(ids, order, axis=1), np.take_along_axis(scores, order, axis=1)


def _search(nearest: int):
    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The nearest in the graphs of a task for its queries, from pairs of a graph and a block."""
        graph, held = None, None
        best: dict[tuple[int, int], tuple[np.ndarray, ...]] = {}
        for batch in batches:
            column = {name: batch.column(name) for name in batch.schema.names}
            for row in range(batch.num_rows):
                width, shard, block = (column[name][row].as_py() for name in ("width", "shard", "block"))
                if held != (width, shard):
                    graph = _Graph(width, *(column[name][row].as_py() for name in ("vectors", "members", "layers")))
                    held = width, shard
                queries = np.frombuffer(column["queries"][row].as_py()).reshape(-1, width)
                query_ids = np.frombuffer(column["query_ids"][row].as_py(), dtype=np.int64)
                ids, scores = graph.nearest(queries)
                ids = np.where(ids == query_ids[:, None], NO_ID, ids)
                if (width, block) in best:
                    _, known, known_scores = best[width, block]
                    ids, scores = np.concatenate([known, ids], axis=1), np.concatenate([known_scores, scores], axis=1)
                best[width, block] = (query_ids, *_best(ids, scores, nearest))
        for query_ids, ids, scores in best.values():
            row, place = np.nonzero(ids != NO_ID)
            yield pa.record_batch(
                {"query_id": query_ids[row], "vec_id": ids[row, place], "score": scores[row, place]}
            )

    return search


def _block(group: pa.Table) -> pa.Table:
    group = group.sort_by("vec_id")
    return pa.table(
        {
            "block": group.column("block").slice(0, 1),
            "width": group.column("width").slice(0, 1),
            "query_ids": [group.column("vec_id").to_numpy().tobytes()],
            "queries": [_matrix(group.column("vector")).tobytes()],
        }
    )


def _numbers(by_width: dict[int, int]) -> Column:
    return F.create_map(*(F.lit(x).cast("bigint") for pair in by_width.items() for x in pair))


def nearest_vectors(embeddings: DataFrame, every: int = 50, nearest: int = 5, vector: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): the nearest of each query, rows whose vec_id is divisible by `every`.

    Vectors that are NULL, zero, empty, or hold NULL or non-finite components take no part,
    nor do rows without a vec_id. Vectors are compared with those of the same
    number of components. Repeated rows count once; a query's own vec_id is no
    candidate. Ties go to the lesser vec_id. Queries without candidates, and an
    empty table, give no rows. Other columns are ignored.
    """
    double = F.transform(F.col(vector), lambda x: x.cast("double"))
    real = F.forall("vector", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = (
        embeddings.select("vec_id", double.alias("vector"))
        .filter(F.col("vec_id").isNotNull() & F.col("vector").isNotNull())
        .filter(real & F.exists("vector", lambda x: x != 0))
        .withColumn("width", F.size("vector").cast("bigint"))
    )
    counts = {row["width"]: row["count"] for row in rows.groupBy("width").count().collect()}  # one row per width
    if not counts:
        counts = {1: 1}  # no vectors: the plan stays the same

    def dealt(parts: dict[int, int], name: str):
        table = _numbers(parts)
        return F.pmod(F.xxhash64("vec_id", "vector"), F.element_at(table, F.col("width"))).alias(name)

    shards = {width: -(-count // SHARD_ROWS) for width, count in counts.items()}
    blocks = {width: -(-(count // every + 1) // BLOCK_ROWS) for width, count in counts.items()}
    index = (
        rows.select("vec_id", "vector", "width", dealt(shards, "shard"))
        .groupBy("width", "shard")
        .applyInArrow(
            _build(nearest + 1), "shard bigint, width bigint, vectors binary, members binary, layers array<binary>"
        )
    )
    queries = (
        rows.filter(F.col("vec_id") % every == 0)
        .select("vec_id", "vector", "width", dealt(blocks, "block"))
        .distinct()
        .groupBy("width", "block")
        .applyInArrow(_block, "block bigint, width bigint, query_ids binary, queries binary")
    )
    node = 8 * (nearest + 1) + 4 * (LOWEST + 2)
    graph_bytes = max(min(count, SHARD_ROWS) * (8 * width + node) for width, count in counts.items())
    run, block_run = (isqrt(sum(parts.values()) - 1) + 1 for parts in (shards, blocks))
    graphs = shared_table(index, "graphs", max(1, min(run, FILE_BYTES // graph_bytes)))
    asked = shared_table(queries, "queries", block_run)
    # A stated set of queries, in blocks, against every shard. The join takes pairs of partitions without a shuffle.
    met = (
        graphs.coalesce(-(-sum(shards.values()) // run))
        .hint("shuffle_replicate_nl")
        .join(asked.coalesce(-(-sum(blocks.values()) // block_run)), "width")
        .mapInArrow(_search(nearest), "query_id bigint, vec_id bigint, score double")
    )
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (
        met.groupBy("query_id", "vec_id")
        .agg(F.max("score").alias("score"))
        .select("query_id", F.row_number().over(order).alias("rank"), "vec_id", "score")
        .filter(F.col("rank") <= nearest)
    )


def op6_ann(spark, sf_dir: str) -> DataFrame:
    """The five nearest of every fiftieth vector of `embeddings`."""
    return nearest_vectors(table(spark, sf_dir, "embeddings"))
