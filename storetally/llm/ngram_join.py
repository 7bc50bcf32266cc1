"""N-gram Jaccard join by count vectors in an R-tree.

Every text is its set of distinct word shingles. Two texts link when their sets
have a Jaccard similarity of `numerator / denominator` or more.

1. *Shards.* Two linked sets of at most h shingles differ in at most
   D = 2h (q - p) / (q + p) shingles (similarity p / q). Shingles are hashed into
   D + 1 + E groups, so linked sets agree in at least 1 + E whole groups; groups
   that are empty in a text count only if it has more than E of them. Texts meet
   in a shard if one such group agrees. Sizes are cut into strata so that h is
   near the size of every text of a stratum; a text near the upper end of its
   stratum also takes part in the next one.
2. *R-tree.* Shingles are hashed into groups, one for about eight shingles of a text;
   the counts are points of an R-tree, and the overlap of a text with a whole subtree is at most the sum of
   coordinate minima. In a shard this bound joins the texts that may link; joined
   texts are a block. A block is searched in cells of bounded size, by the same tree.
3. *Verification.* Surviving pairs of a cell are compared exactly, unless it already
   knows that both texts are in one component. So a cell gives a spanning forest
   of its links, never all pairs of a group.

Equal sets are one class throughout. Shingles and sets are known by 64-bit and
128-bit hashes.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storetally.llm.components import components
from storetally.llm.texts import (
    fresh,
    mix,
    shared_checkpoint,
    shared_table,
    shingle_hashes,
    signed,
    slices,
    sorted_groups,
    table,
    word_hashes,
)

_WORD = r"[^\x20\x09-\x0D]"
# Coordinates of a point: a power of two, about one for each eight shingles.
LEAST_DIMENSIONS = 64
MOST_DIMENSIONS = 1 << 14
FANOUT = 12
_MOST = np.iinfo(np.uint8).max
# A cell of the join holds about so many texts and shingles.
CELL_TEXTS = 1500
CELL_SHINGLES = 1_500_000
# A shard of more texts, or of more bytes of points, is one block as a whole, without a search by bounds.
SHARD_TEXTS = 20_000
SHARD_BYTES = 32 << 20
# Shards of so many texts or fewer are known by their texts, so that equal shards count once.
LISTED = 64
# Shard keys in a row of the table of classes, and such rows in a batch.
KEYS_A_ROW = 1024
KEY_ROWS = 2048
_CLASS_COLUMNS = ["doc_id", "n_shingles", "node", "class", "point", "keys"]


def _sets(column: pa.Array, size: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row, sorted distinct shingle hashes) of every text."""
    for row, data, offsets in slices(column):
        shingles, first = shingle_hashes(*word_hashes(data, offsets), size)
        for text in range(len(offsets) - 1):
            yield row + text, np.unique(shingles[first[text] : first[text + 1]])


def _fingerprint(mixed: np.ndarray) -> tuple[int, int]:
    low = int(mixed.sum(dtype=np.uint64))
    high = int(mix(mixed ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))
    return low, high


def _dimensions(count: int) -> int:
    """Coordinates for a set: with fewer, unrelated large sets would look alike."""
    return min(max(LEAST_DIMENSIONS, 1 << max(0, (count // 8 - 1).bit_length())), MOST_DIMENSIONS)


def _point(hashes: np.ndarray, dimensions: int) -> np.ndarray:
    """Shingles of a set in each group; a group of fewer coordinates joins neighbours of one of more."""
    group = hashes >> np.uint64(65 - dimensions.bit_length())
    return np.bincount(group.astype(np.int64), minlength=dimensions)


def _class_name(low: int, high: int) -> str:
    return f"{low:016x}{high:016x}"


def _strata(numerator: int, denominator: int) -> Iterator[tuple[int, int, int, int]]:
    """(least size, greatest size, groups, spare groups) of each stratum, without end."""
    low, high = 1, 1
    while True:
        differ = 2 * high * (denominator - numerator) // (denominator + numerator)
        spare = 0
        for _ in range(8 if differ else 0):
            groups = differ + 1 + spare
            empty = groups * math.exp(-low / groups)
            spare = max(spare, math.ceil(empty + 2 * math.sqrt(empty)) + 1)
        yield low, high, differ + 1 + spare, spare
        low, high = high + 1, max(high + 1, high * denominator**2 // numerator**2)


class _Shards:
    """Shard keys of a set; strata are worked out as far as sizes need them."""

    def __init__(self, numerator: int, denominator: int):
        self.numerator, self.denominator = numerator, denominator
        self.source = _strata(numerator, denominator)
        self.strata: list[tuple[int, int, int, int]] = []
        self.highs: list[int] = []

    def keys(self, hashes: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        count = len(hashes)
        while not self.highs or self.highs[-1] < count:
            stratum = next(self.source)
            self.strata.append(stratum)
            self.highs.append(stratum[1])
        own = int(np.searchsorted(self.highs, count))
        found = [self._stratum(own, hashes, mixed)]
        if count * self.denominator // self.numerator > self.highs[own]:
            while len(self.strata) <= own + 1:
                stratum = next(self.source)
                self.strata.append(stratum)
                self.highs.append(stratum[1])
            found.append(self._stratum(own + 1, hashes, mixed))
        return np.concatenate(found)

    def _stratum(self, number: int, hashes: np.ndarray, mixed: np.ndarray) -> np.ndarray:
        _, _, groups, spare = self.strata[number]
        # Hashes are sorted, so a group is a range of them.
        group = ((hashes >> np.uint64(32)) * np.uint64(groups)) >> np.uint64(32)
        bounds = np.concatenate([[0], np.cumsum(np.bincount(group.astype(np.int64), minlength=groups))])
        sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum(mixed, dtype=np.uint64)])
        content = sums[bounds[1:]] - sums[bounds[:-1]]
        place = np.arange(groups, dtype=np.uint64) + np.uint64(number << 32)
        keys = mix(content ^ mix(place))
        filled = bounds[1:] > bounds[:-1]
        return keys if groups - filled.sum() > spare else keys[filled]


def _classes(size: int, numerator: int, denominator: int):
    """Two kinds of rows: one for each text, and those that list the shard keys of its class.

    Rows of the second kind have no doc_id and no n_shingles and hold up to KEYS_A_ROW keys;
    a class that has given its keys in this task does so once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shards = _Shards(numerator, denominator)
        seen: set[int] = set()
        for batch in batches:
            counts = np.zeros(batch.num_rows, dtype=np.int64)
            nodes = np.zeros(batch.num_rows, dtype=np.uint64)
            names: list[str | None] = [None] * batch.num_rows
            points: list[bytes | None] = [None] * batch.num_rows
            keys, owners = [], []
            for row, hashes in _sets(batch.column(1), size):
                if not len(hashes):
                    continue
                mixed = mix(hashes)
                low, high = _fingerprint(mixed)
                counts[row], nodes[row], names[row] = len(hashes), low, _class_name(low, high)
                point = _point(hashes, _dimensions(len(hashes)))
                points[row] = np.minimum(point, _MOST).astype(np.uint8).tobytes()
                if low in seen:  # equal sets have equal keys
                    continue
                if len(seen) >= 1_000_000:
                    seen.clear()
                seen.add(low)
                own = shards.keys(hashes, mixed)
                for begin in range(0, len(own), KEYS_A_ROW):
                    keys.append(own[begin : begin + KEYS_A_ROW])
                    owners.append(low)
                if len(keys) >= KEY_ROWS:
                    yield _key_rows(keys, owners)
                    keys, owners = [], []
            if keys:
                yield _key_rows(keys, owners)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts),
                    pa.array(signed(nodes)),
                    pa.array(names, pa.string()),
                    pa.array(points, pa.binary()),
                    pa.nulls(batch.num_rows, pa.list_(pa.int64())),
                ],
                _CLASS_COLUMNS,
            )

    return run


def _key_rows(keys: list[np.ndarray], owners: list[int]) -> pa.RecordBatch:
    ends = np.cumsum([0, *map(len, keys)], dtype=np.int32)
    count = len(keys)
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(count, pa.int64()),
            pa.nulls(count, pa.int64()),
            pa.array(signed(np.array(owners, dtype=np.uint64))),
            pa.nulls(count, pa.string()),
            pa.nulls(count, pa.binary()),
            pa.ListArray.from_arrays(pa.array(ends), pa.array(signed(np.concatenate(keys)))),
        ],
        _CLASS_COLUMNS,
    )


def _meetings(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(shard, node) of the shards with several texts, of rows sorted by (key, node).

    The first and the last shard of a batch may go on in another batch or
    partition, so they are known by their key and given even with one text.
    """
    seen: set[int] = set()
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        nodes = batch.column(1).to_numpy(zero_copy_only=False)
        new = np.ones(len(keys), dtype=bool)
        new[1:] = (keys[1:] != keys[:-1]) | (nodes[1:] != nodes[:-1])
        keys, nodes = keys[new], nodes[new]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]]))
        counts = np.diff(np.append(starts, len(keys)))
        names = mix(keys[starts].view(np.uint64))
        listed = (counts > 1) & (counts <= LISTED)
        listed[[0, -1]] = False
        lists = mix(np.add.reduceat(mix(nodes.view(np.uint64)), starts) + counts.astype(np.uint64))
        names[listed] = lists[listed]
        chosen = (counts > 1) & ~listed
        chosen[[0, -1]] = True
        _, first = np.unique(lists[listed], return_index=True)
        fresh_lists = [run for run in np.flatnonzero(listed)[first].tolist() if int(lists[run]) not in seen]
        if len(seen) > 1_000_000:
            seen.clear()
        seen.update(lists[fresh_lists].tolist())
        chosen[fresh_lists] = True
        rows = np.repeat(chosen, counts)
        if rows.any():
            yield pa.RecordBatch.from_arrays(
                [pa.array(signed(np.repeat(names, counts)[rows])), pa.array(nodes[rows])], ["shard", "node"]
            )


def _edges(left: np.ndarray, right: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(left), pa.array(right)], ["u", "v"])


def _near(numerator: int, denominator: int, most_bytes: int = SHARD_BYTES):
    def bounded(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        """Edges that join the texts of a shard which may link."""
        rows = pa.Table.from_batches(held)
        nodes, sizes = rows.column("node").to_numpy(), rows.column("n").to_numpy()
        found = [np.frombuffer(one, dtype=np.uint8) for one in rows.column("point").to_pylist()]
        least = min(map(len, found))
        # A count that may have been cut is without bound.
        points = np.stack(
            [np.where(one == _MOST, 2**20, one.astype(np.int32)).reshape(least, -1).sum(axis=1) for one in found]
        )
        tree = _Tree(points, sizes)
        labels = np.arange(len(nodes))
        probed = np.zeros(len(nodes), dtype=bool)
        edges = []
        # A text need not be searched from if all that is not joined to it is.
        while True:
            waiting = ~probed & (labels != np.bincount(labels).argmax()) if probed.any() else ~probed
            if not waiting.any():
                break
            row = int(waiting.argmax())
            probed[row] = True
            found = tree.search(points[row], int(sizes[row]), numerator, denominator)
            found = found[labels[found] != labels[row]]
            edges += [(row, int(other)) for other in found]
            labels[np.isin(labels, labels[found])] = labels[row]
        pairs = np.array(edges, dtype=np.int64).reshape(-1, 2)
        return _edges(nodes[pairs[:, 0]], nodes[pairs[:, 1]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        count, size, shard, leader = 0, 0, None, None
        for batch in batches:
            shards = batch.column(0).to_numpy(zero_copy_only=False)
            cuts = [0, *(np.flatnonzero(shards[1:] != shards[:-1]) + 1).tolist(), len(shards)]
            for begin, stop in zip(cuts, cuts[1:]):
                if begin == stop:
                    continue
                if shards[begin] != shard:
                    if count > 1 and held:
                        yield bounded(held)
                    held, count, size, shard = [], 0, 0, shards[begin]
                    leader = batch.column(1)[begin].as_py()
                held.append(batch.slice(begin, stop - begin))
                count += stop - begin
                size += held[-1].column(3).nbytes
                if size > most_bytes:
                    nodes = np.concatenate([one.column(1).to_numpy(zero_copy_only=False) for one in held])
                    yield _edges(np.full(len(nodes), leader, dtype=np.int64), nodes)
                    held = []
        if count > 1 and held:
            yield bounded(held)

    return run


class _Tree:
    """R-tree over count vectors: levels of upper corners, packed by size, then by the first coordinates."""

    def __init__(self, points: np.ndarray, sizes: np.ndarray):
        order = np.lexsort((points[:, 1], points[:, 0], sizes // max(1, int(sizes.max()) // 32 + 1)))
        self.order = order
        self.levels = [(points[order], sizes[order])]
        while len(self.levels[-1][1]) > FANOUT:
            upper, least = self.levels[-1]
            starts = np.arange(0, len(least), FANOUT)
            self.levels.append((np.maximum.reduceat(upper, starts), np.minimum.reduceat(least, starts)))

    def search(self, point: np.ndarray, size: int, numerator: int, denominator: int) -> np.ndarray:
        """Rows whose overlap bound allows a link."""
        nodes = np.arange(len(self.levels[-1][1]))
        for depth in range(len(self.levels) - 1, -1, -1):
            upper, least = self.levels[depth]
            overlap = np.minimum(upper[nodes], point).sum(axis=1)
            nodes = nodes[overlap * (numerator + denominator) >= numerator * (least[nodes] + size)]
            if depth:
                below = len(self.levels[depth - 1][1])
                nodes = (nodes[:, None] * FANOUT + np.arange(FANOUT)).ravel()
                nodes = nodes[nodes < below]
        return self.order[nodes]


def _common(left: np.ndarray, right: np.ndarray) -> int:
    if len(left) > len(right):
        left, right = right, left
    if not len(left):
        return 0
    places = np.minimum(np.searchsorted(right, left), len(right) - 1)
    return int(np.count_nonzero(right[places] == left))


def join_cell(sets: list[np.ndarray], labels: np.ndarray, numerator: int, denominator: int) -> list[tuple[int, int]]:
    """Links of the sets that join what `labels` does not join yet: a spanning forest of them."""
    sizes = np.array([len(one) for one in sets], dtype=np.int64)
    points = np.stack([_point(one, _dimensions(int(sizes.max()))) for one in sets]).astype(np.int32)
    tree = _Tree(points, sizes)
    labels = labels.copy()
    links = []
    for row in range(len(sets)):
        near = tree.search(points[row], int(sizes[row]), numerator, denominator)
        near = near[labels[near] != labels[row]]
        while len(near):
            other = int(near[0])
            common = _common(sets[row], sets[other])
            if common * (numerator + denominator) >= numerator * (sizes[row] + sizes[other]):
                links.append((row, other))
                labels[labels == labels[other]] = labels[row]
                near = near[labels[near] != labels[row]]
            else:
                near = near[1:]
    return links


def _cell_rows(size: int):
    """(name, block, cells, label, set) for each text whose class is the wanted one; `cells` lists its cells."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names = batch.column(1).to_pylist()
            rows, found = [], []
            for row, hashes in _sets(batch.column(0), size):
                if len(hashes) and _class_name(*_fingerprint(mix(hashes))) == names[row]:
                    rows.append(row)
                    found.append(hashes.tobytes())
            for begin in range(0, len(rows), 256):
                some = pa.array(rows[begin : begin + 256], pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(k).take(some) for k in range(1, batch.num_columns)), pa.array(found[begin : begin + 256], pa.binary())],
                    ["class", *batch.schema.names[2:], "shingles"],
                )

    return run


def _joined(numerator: int, denominator: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in sorted_groups(batches, ["block", "cell"]):
            if group.num_rows < 2:
                continue
            names = group.column("class").to_pylist()
            labels = group.column("label").to_pylist()
            sets = [np.frombuffer(one, dtype=np.uint64) for one in group.column("shingles").to_pylist()]
            _, known = np.unique(np.array(labels, dtype=object).astype(str), return_inverse=True)
            links = join_cell(sets, known, numerator, denominator)
            if links:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([names[i] for i, _ in links]), pa.array([names[j] for _, j in links])], ["u", "v"]
                )

    return run


def _cells(docs: DataFrame, members: DataFrame, text: str, size: int, numerator: int, denominator: int) -> DataFrame:
    """Links (u, v) found in the cells of `members` (doc_id, class, block, cells, label)."""
    wanted = members.select(F.col("doc_id").alias("wanted_id"), "class", "block", "cells", "label")
    rows = (
        docs.select(F.col("doc_id"), F.col(text).alias("text"))
        .join(wanted, F.col("doc_id").eqNullSafe(F.col("wanted_id")))
        .select("text", "class", "block", "cells", "label")
        .mapInArrow(_cell_rows(size), "class string, block bigint, cells array<bigint>, label string, shingles binary")
        .select("class", "block", F.explode("cells").alias("cell"), "label", "shingles")
    )
    return (
        rows.repartition("block", "cell")
        .dropDuplicates(["block", "cell", "class"])
        .sortWithinPartitions("block", "cell", "class")
        .select("class", "block", "cell", "label", "shingles")
        .mapInArrow(_joined(numerator, denominator), "u string, v string")
        .distinct()
    )


def ngram_join(
    docs: DataFrame, numerator: int = 80, denominator: int = 100, size: int = 5, text: str = "text"
) -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row of `docs` (doc_id and a text column, others are ignored).

    component_id is the least doc_id reachable over links, the row's own
    included. A NULL, empty or blank text has no shingles, links with nothing
    and is its own component. Repeated rows are equal sets, so one component.
    A NULL doc_id is kept and never the least of a component that has another.
    An empty table gives no rows.
    """
    source = docs.select("doc_id", F.col(text).alias("text"))
    # A table is computed once; a checkpoint would run its last stage, here all of it, twice. The shard keys
    # lie in the same table, so that texts are cut into shingles once and ranges of keys are sampled from it.
    kept = shared_table(
        source.mapInArrow(
            _classes(size, numerator, denominator),
            "doc_id bigint, n_shingles bigint, node bigint, class string, point binary, keys array<bigint>",
        ),
        "classes",
    )
    classes = kept.filter("n_shingles IS NOT NULL").drop("keys")
    shards = kept.filter("n_shingles IS NULL").select(F.explode("keys").alias("key"), "node")
    # A range of (key, node) may end inside a shard, so that a hot shard is spread over tasks.
    # Kept, so that the shuffle of all keys is gone before points are dealt to the shards.
    meetings = shared_table(
        shards.repartitionByRange("key", "node")
        .sortWithinPartitions("key", "node")
        .mapInArrow(_meetings, "shard bigint, node bigint")
        .distinct(),
        "meetings",
    )
    # The texts of a hot shard are joined with one of them, wherever they lie; points go to the others only.
    hot = (
        meetings.groupBy("shard")
        .agg(F.count("*").alias("texts"), F.min("node").alias("leader"))
        .filter(F.col("texts") > SHARD_TEXTS)
    )
    whole = meetings.join(hot, "shard").select(F.col("leader").alias("u"), F.col("node").alias("v"))
    meetings = meetings.join(hot, "shard", "left_anti")
    representatives = classes.filter("class IS NOT NULL").groupBy("class", "node").agg(
        F.min("doc_id").alias("doc_id"), F.max("n_shingles").alias("n"), F.max("point").alias("point")
    )
    near = (
        meetings.join(representatives.select("node", "n", "point"), "node")
        .select("shard", "node", "n", "point")
        .repartition("shard")
        .sortWithinPartitions("shard", "node")
        .mapInArrow(_near(numerator, denominator), "u bigint, v bigint")
    )
    blocks = components(near.union(whole))

    candidates = representatives.join(blocks, "node").select("class", "doc_id", "n", F.col("root").alias("block"))
    weights = candidates.groupBy("block").agg(F.count("*").alias("texts"), F.sum("n").alias("shingles"))
    weights = weights.filter("texts > 1").select(
        "block",
        F.greatest(F.ceil(F.col("texts") / CELL_TEXTS), F.ceil(F.col("shingles") / CELL_SHINGLES)).alias("chunks"),
    )
    members = shared_checkpoint(
        candidates.join(weights, "block").withColumn("chunk", F.pmod(F.xxhash64("class"), "chunks"))
    )
    # A block of one chunk is one cell. In a larger one, chunk 0 meets every chunk first.
    first = members.select(
        "doc_id",
        "class",
        "block",
        F.when(F.col("chunk") == 0, F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1))
        .otherwise(F.array("chunk"))
        .alias("cells"),
        F.col("class").alias("label"),
    )
    links = shared_checkpoint(_cells(source, first, "text", size, numerator, denominator))
    large = members.filter("chunks > 1")
    if not large.isEmpty():
        # Only texts outside the largest component of their block can have further links to others of it.
        labels = components(links)
        known = large.join(labels, F.col("class") == F.col("node"), "left").select(
            "doc_id", "class", "n", "block", "chunk", "chunks", F.coalesce("root", "class").alias("label")
        )
        sizes = known.groupBy("block", "label").agg(F.count("*").alias("texts"))
        main = sizes.groupBy("block").agg(F.max(F.struct("texts", "label")).alias("main"), F.count("*").alias("parts"))
        known = known.join(main.filter("parts > 1").select("block", F.col("main.label").alias("main")), "block")
        rest = known.filter("label != main").groupBy("block").agg(
            F.greatest(F.ceil(F.count("*") / CELL_TEXTS), F.ceil(F.sum("n") / CELL_SHINGLES)).alias("parts")
        )
        known = known.join(rest, "block").withColumn("part", F.pmod(F.xxhash64("class", F.lit(1)), "parts"))
        cells = F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("parts") - 1), lambda part: part * F.col("chunks") + F.col("chunk")
        )
        probes = F.transform(
            F.sequence(F.lit(0).cast("bigint"), F.col("chunks") - 1), lambda chunk: F.col("part") * F.col("chunks") + chunk
        )
        second = known.select(
            "doc_id",
            "class",
            "block",
            F.when(F.col("label") == F.col("main"), cells).otherwise(F.array_union(cells, probes)).alias("cells"),
            "label",
        )
        links = links.union(_cells(source, second, "text", size, numerator, denominator))
    roots = components(links).select(F.col("node").alias("class"), "root")
    ids = (
        representatives.join(roots, "class", "left")
        .select("class", "doc_id", F.coalesce("root", "class").alias("root"))
    )
    least = ids.groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = ids.join(least, "root").select("class", "component_id")
    return classes.join(named, "class", "left").select(
        "doc_id",
        "n_shingles",
        F.when(F.col("n_shingles") == 0, F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
    )


def drop_near_copies(
    docs: DataFrame, numerator: int = 80, denominator: int = 100, size: int = 5, text: str = "text"
) -> DataFrame:
    """One row of `docs` of each component, with the same columns: the least doc_id, and of its rows one text.

    Rows without shingles stay, each of them. So do all rows of a component
    that has no doc_id but NULL, except for repeated texts.
    """
    joined = ngram_join(docs, numerator, denominator, size, text)
    kept = joined.filter("n_shingles > 0 AND doc_id <=> component_id").select("doc_id").distinct()
    mark = fresh(docs, "kept_id")
    least = docs.join(kept.withColumnRenamed("doc_id", mark), docs["doc_id"].eqNullSafe(F.col(mark)), "left_semi")
    least = least.filter(F.col(text).rlike(_WORD)).dropDuplicates(["doc_id", text])
    blank = docs.filter(~F.coalesce(F.col(text).rlike(_WORD), F.lit(False)))
    return least.union(blank)


def op2_ngram_join(spark, sf_dir: str) -> DataFrame:
    """Three-word shingles, similarity 0.9, over all of `documents`."""
    return ngram_join(table(spark, sf_dir, "documents"), 90, 100, size=3)


ORACLE = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS words
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE
    WHEN words IS NULL OR len(words) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(words) < 3 THEN [concat_ws(' ', len(words), array_to_string(words, ' '))]
    ELSE list_transform(range(1, len(words) - 1), lambda i: words[i] || ' ' || words[i + 1] || ' ' || words[i + 2])
  END) AS shingle
  FROM w
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), common AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS k
  FROM s a JOIN s b ON a.shingle = b.shingle AND a.doc_id <> b.doc_id
  GROUP BY ALL
), links AS (
  SELECT a, b FROM common JOIN n x ON x.doc_id = a JOIN n y ON y.doc_id = b
  WHERE 100 * k >= 90 * (x.n + y.n - k)
), reach(a, b) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT reach.a, links.b FROM reach JOIN links ON links.a = reach.b
)
SELECT d.doc_id, coalesce(max(n.n), 0)::BIGINT AS n_shingles, min(reach.b) AS component_id
FROM documents d LEFT JOIN n USING (doc_id) JOIN reach ON reach.a = d.doc_id
GROUP BY d.doc_id
"""
