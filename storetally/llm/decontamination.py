"""Benchmark decontamination by size-partitioned MinHash containment search.

A text is its set of distinct word shingles. An item is contained in a document
if `numerator / denominator` or more of the item's shingles are in the document.

Items are sketched by the smallest values of their shingle hashes under one
permutation. An item of q shingles that needs n of them takes the q - n + 1
smallest: a document holding n shingles of the item cannot miss all of these,
however long it is, so the search has no false negatives. Items are partitioned
by size (powers of two); a document is searched only in partitions whose least
item it is large enough to contain: its shingles are looked up in the sorted sketch values, whose
postings name the candidates. Only these are verified, by their exact
shingle containment in the same pass.

Items are a stated query set: they are taken in blocks of bounded size, each
broadcast to one narrow pass over the documents; the driver holds one block at a time. Nothing is shuffled.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storetally.llm.texts import (
    fresh,
    mix,
    portions,
    shared_checkpoint,
    shared_table,
    shingle_hashes,
    slices,
    table,
    word_hashes,
)

# Shingles of the items of one block, at most (an item beyond it is a block of its own).
BLOCK_SHINGLES = 2_000_000
# Bits of the filter that sketch values pass, beyond those that number them, and at least.
_FILTER_SPARE, _FILTER_LEAST = 5, 16


def _item_sets(size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = []
            for _, data, offsets in slices(batch.column(1)):
                shingles, first = shingle_hashes(*word_hashes(data, offsets), size)
                found += [np.unique(shingles[a:b]).tobytes() for a, b in zip(first, first[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(found, pa.binary()), pa.array([len(one) // 8 for one in found], pa.int64())],
                ["item_id", "shingles", "n"],
            )

    return run


@dataclass
class _Partition:
    """Items of similar size: sorted sketch values, each with the item that it is of."""

    least: int
    sketch: np.ndarray
    items: np.ndarray


class Index:
    """Sketches of one block of items."""

    def __init__(self, items: list[tuple[int | None, np.ndarray]], numerator: int, denominator: int):
        self.ids = [item for item, _ in items]
        self.sizes = np.array([len(hashes) for _, hashes in items], dtype=np.int64)
        self.needed = -(-self.sizes * numerator // denominator)
        self.shingles = [hashes for _, hashes in items]
        self.partitions = []
        classes = np.floor(np.log2(np.maximum(self.sizes, 1))).astype(int)
        for size_class in np.unique(classes[self.sizes > 0]):
            own = np.flatnonzero((classes == size_class) & (self.sizes > 0))
            sketches = []
            for item in own:
                hashes = items[item][1]
                order = np.argsort(mix(hashes))[: len(hashes) - self.needed[item] + 1]
                sketches.append(hashes[order])
            sketch, of = np.concatenate(sketches), np.repeat(own, [len(one) for one in sketches])
            order = np.argsort(sketch, kind="stable")
            self.partitions.append(_Partition(int(self.needed[own].min()), sketch[order], of[order]))
        values = sum(len(part.sketch) for part in self.partitions)
        self.mask = np.uint64((1 << max(_FILTER_LEAST, values.bit_length() + _FILTER_SPARE)) - 1)
        self.filter = np.zeros(int(self.mask) + 1, dtype=bool)
        for part in self.partitions:
            self.filter[part.sketch & self.mask] = True

    def passed(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each of `hashes` may be a sketch value."""
        return self.filter[hashes & self.mask]

    def search(self, hashes: np.ndarray) -> list[tuple[int, int]]:
        """(item, shared shingles) of the items contained in the set `hashes` (sorted, distinct)."""
        found = []
        likely = hashes[self.passed(hashes)]
        for part in self.partitions:
            if len(hashes) < part.least:
                continue
            begin, stop = (np.searchsorted(part.sketch, likely, side) for side in ("left", "right"))
            hit = np.flatnonzero(stop > begin)
            if not len(hit):
                continue
            postings = np.concatenate([part.items[a:b] for a, b in zip(begin[hit], stop[hit])])
            # Verify the candidates: every shingle of theirs, exactly.
            for item in np.unique(postings):
                own = self.shingles[item]
                near = np.minimum(np.searchsorted(hashes, own), len(hashes) - 1)
                shared = int((hashes[near] == own).sum())
                if shared >= self.needed[item]:
                    found.append((int(item), shared))
        return found


def _hits(index: Index, size: int, column: pa.Array) -> Iterator[tuple[int, int, int]]:
    """(row, item, shared shingles) of the items contained in the texts of `column`."""
    for row, data, offsets in slices(column):
        shingles, first = shingle_hashes(*word_hashes(data, offsets), size)
        hits = np.flatnonzero(index.passed(shingles))
        for text in np.unique(np.searchsorted(first, hits, side="right") - 1):
            for item, count in index.search(np.unique(shingles[first[text] : first[text + 1]])):
                yield row + int(text), item, count


def _search(index: Index, size: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hits = list(_hits(index, size, batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0).take(pa.array([row for row, _, _ in hits], pa.int64())),
                    pa.array([index.ids[item] for _, item, _ in hits], pa.int64()),
                    pa.array([int(index.sizes[item]) for _, item, _ in hits], pa.int64()),
                    pa.array([count for _, _, count in hits], pa.int64()),
                ],
                ["doc_id", "item_id", "n_item", "n_shared"],
            )

    return run


def _marked(index: Index, size: int, place: int, mark: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = np.zeros(batch.num_rows, dtype=bool)
            for row, _, _ in _hits(index, size, batch.column(place)):
                found[row] = True
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, mark])

    return run


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    numerator: int = 80,
    denominator: int = 100,
    size: int = 5,
    text: str = "text",
) -> DataFrame:
    """(doc_id, item_id, n_item, n_shared) for every row of `docs` and item it contains.

    n_item counts the item's distinct shingles, n_shared those in the document.
    A text with fewer than `size` words has its whole sequence as its only
    shingle. NULL, empty and blank texts have none: such items are in nothing,
    such documents contain nothing. Repeated rows, on either side, each give
    their own result rows; NULL ids are carried along; empty tables give no rows.
    Other columns are ignored.
    """
    sets = (
        items.select(F.col("item_id").cast("bigint").alias("item_id"), F.col("text"))
        .mapInArrow(_item_sets(size), "item_id bigint, shingles binary, n bigint")
        .filter("n > 0")
    )
    source = docs.select("doc_id", F.col(text).alias("text"))
    schema = "doc_id bigint, item_id bigint, n_item bigint, n_shared bigint"

    def found(block: list[tuple[int | None, np.ndarray]]) -> DataFrame:
        return source.mapInArrow(_search(Index(block, numerator, denominator), size), schema)

    blocks = _blocks(sets)
    result, following = found(next(blocks, [])), next(blocks, None)
    if following is not None:
        # The driver holds one block at a time; each one's results are kept in the shared folder.
        result = shared_checkpoint(result)
    while following is not None:
        result, following = result.union(shared_checkpoint(found(following))), next(blocks, None)
    return result


def _blocks(sets: DataFrame) -> Iterator[list[tuple[int | None, np.ndarray]]]:
    block: list[tuple[int | None, np.ndarray]] = []
    held = 0
    for row in sets.toLocalIterator():
        if block and held + row["n"] > BLOCK_SHINGLES:
            yield block
            block, held = [], 0
        block.append((row["item_id"], np.frombuffer(row["shingles"], dtype=np.uint64)))
        held += row["n"]
    if block:
        yield block


def drop_contaminated(docs: DataFrame, items: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that contain no item of five words, 0.8 or more, with the same columns.

    NULL, empty and blank texts contain nothing and stay. Each row is judged by
    its own text, whatever its doc_id; repeated rows alike. Empty tables drop nothing. Between
    blocks of items, what is left is kept in the shared folder.
    """
    mark = fresh(docs, "contaminated")
    place = docs.columns.index(text)
    schema = docs.select("*", F.lit(False).alias(mark)).schema
    sets = items.select(F.lit(0).cast("bigint").alias("item_id"), F.col("text")).mapInArrow(
        _item_sets(5), "item_id bigint, shingles binary, n bigint"
    )
    kept = docs
    blocks = _blocks(sets.filter("n > 0"))
    block = next(blocks, None)
    while block is not None:
        kept = kept.mapInArrow(_marked(Index(block, 80, 100), 5, place, mark), schema).filter(~F.col(mark)).drop(mark)
        block = next(blocks, None)
        if block is not None:
            kept = shared_table(kept, "decontaminated")
    return kept


def op10_decontamination(spark, sf_dir: str) -> DataFrame:
    """Every item of `benchmark` contained in a row of `documents`: five words, 0.8 or more of the item."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE = r"""
WITH t AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL SELECT 'i', item_id, text FROM benchmark
), w AS (
  SELECT kind, id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                      '[^\x20\x09-\x0D]+') AS words
  FROM t
), s AS (
  SELECT DISTINCT kind, id, unnest(CASE
    WHEN words IS NULL OR len(words) = 0 THEN CAST([] AS VARCHAR[])
    WHEN len(words) < 5 THEN [concat_ws(' ', len(words), array_to_string(words, ' '))]
    ELSE list_transform(range(1, len(words) - 3), lambda i: array_to_string(words[i:i + 4], ' '))
  END) AS shingle
  FROM w
), n AS (
  SELECT id, count(*) AS n FROM s WHERE kind = 'i' GROUP BY id
)
SELECT d.id AS doc_id, i.id AS item_id, any_value(n.n)::BIGINT AS n_item, count(*)::BIGINT AS n_shared
FROM s d JOIN s i ON d.kind = 'd' AND i.kind = 'i' AND d.shingle = i.shingle JOIN n ON n.id = i.id
GROUP BY d.id, i.id
HAVING 100 * count(*) >= 80 * any_value(n.n)
"""
