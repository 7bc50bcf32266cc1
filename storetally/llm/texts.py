"""Vectorised word hashing and Arrow helpers shared by the text operators.

Words are runs of bytes other than space and 0x09 to 0x0D; A to Z count as a to z.
A word, and a run of words (shingle), is known by a 64-bit hash.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from storetally.session import remove_at_end, shared_base

# A Python worker holds about 90 bytes for each of these while it hashes, and the powers for as long as it lives.
SLICE_BYTES = 1 << 18
# Rows of whole texts that go back to Spark at once.
PORTION_ROWS = 500

_RANDOM = np.random.Generator(np.random.PCG64(20240229))
# Bytes that words are made of: all but white space; or letters, digits and bytes beyond ASCII.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[32, *range(9, 14)]] = False
LETTERS = np.array([chr(b).isalnum() or b > 127 for b in range(256)])
_TERM = _RANDOM.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_TERM[65:91] = _TERM[97:123]
_BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 2**64))
_PLACE = _RANDOM.integers(1, 2**63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _powers(base: np.uint64, count: int) -> np.ndarray:
    factors = np.full(count, base, dtype=np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


_POWERS = _powers(_BASE, 2 * SLICE_BYTES)
_INVERSES = _powers(_BASE_INVERSE, 2 * SLICE_BYTES)


def mix(values: np.ndarray) -> np.ndarray:
    """Spreads each 64-bit value over all 64 bits."""
    values = (values ^ (values >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    values = (values ^ (values >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return values ^ (values >> np.uint64(31))


def slices(column: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets) of runs of whole texts, about `limit` bytes or one text each; NULL is empty."""
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    buffers = column.buffers()
    offsets = np.frombuffer(buffers[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(buffers[2], dtype=np.uint8) if buffers[2] is not None else np.empty(0, dtype=np.uint8)
    row = 0
    while row < len(column):
        stop = int(np.searchsorted(offsets, offsets[row] + limit, side="right")) - 1
        stop = min(max(stop, row + 1), len(column))
        yield row, data[offsets[row] : offsets[stop]], offsets[row : stop + 1] - offsets[row]
        row = stop


def portions(batches: Iterator[pa.RecordBatch], rows: int = PORTION_ROWS) -> Iterator[pa.RecordBatch]:
    """All rows in runs of at most `rows`, so that the executor never holds a large batch of results."""
    for batch in batches:
        for begin in range(0, batch.num_rows, rows):
            yield batch.slice(begin, rows)


def word_hashes(
    data: np.ndarray, offsets: np.ndarray, kind: np.ndarray = NOT_SPACE, prefix: int = 0
) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words in order, and for each text the index of its first word (one more at the end).

    With a `prefix`, only the first so many bytes of a longer word count.
    """
    size = len(data)
    if not size:
        return np.empty(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    solid = kind[data]
    edge = np.zeros(size + 1, dtype=bool)
    edge[offsets] = True
    before = np.empty(size, dtype=bool)
    before[0] = False
    before[1:] = solid[:-1]
    start = np.flatnonzero(solid & (~before | edge[:-1]))
    after = np.empty(size, dtype=bool)
    after[-1] = False
    after[:-1] = solid[1:]
    last = np.flatnonzero(solid & (~after | edge[1:]))
    if prefix:
        last = np.minimum(last, start + prefix - 1)
    powers, inverses = _POWERS, _INVERSES
    if size > len(powers):
        powers, inverses = _powers(_BASE, size), _powers(_BASE_INVERSE, size)
    terms = _TERM[data] * powers[:size]
    sums = np.cumsum(terms, dtype=np.uint64)
    words = (sums[last] - sums[start] + terms[start]) * inverses[start]
    words = mix(words + (last - start).astype(np.uint64) * _BASE)
    return words, np.searchsorted(start, offsets)


def shingle_hashes(words: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of `size` words inside a text, in order, and each text's first index.

    A text with fewer words has its whole sequence as its only shingle, one without words has none.
    """
    counts = np.diff(first)
    runs = np.zeros(len(words), dtype=np.uint64)
    for place in range(min(size, len(words))):
        runs[: len(words) - place] += words[place:] * _PLACE[place]
    inside = np.ones(len(words), dtype=bool)
    cut = np.minimum(counts, size - 1)
    # The last size - 1 words of a text begin no whole run.
    for place in range(1, size):
        ends = first[1:][cut >= place] - place
        inside[ends] = False
    short = np.flatnonzero((counts > 0) & (counts < size))
    for text in short:
        begin, stop = first[text], first[text + 1]
        # Unlike a whole run, the sequence is marked by its length.
        runs[begin] = (words[begin:stop] * _PLACE[size : size + stop - begin]).sum(dtype=np.uint64) + np.uint64(
            stop - begin
        )
        inside[begin] = True
    starts = np.concatenate([[0], np.cumsum(inside)])[first]
    return mix(runs[inside]), starts


def signed(values: np.ndarray) -> np.ndarray:
    return values.view(np.int64)


def sorted_groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The runs of rows with equal keys, of batches that are sorted by them; the keys are longs without NULL."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not batch.num_rows:
            continue
        columns = [batch.column(batch.schema.get_field_index(key)).to_numpy(zero_copy_only=False) for key in keys]
        change = np.zeros(batch.num_rows, dtype=bool)
        for column in columns:
            change[1:] |= column[1:] != column[:-1]
        bounds = [0, *np.flatnonzero(change).tolist(), batch.num_rows]
        for begin, stop in zip(bounds, bounds[1:]):
            key = tuple(column[begin] for column in columns)
            if key != current and held:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(begin, stop - begin))
    if held:
        yield pa.Table.from_batches(held)


def fresh(frame: DataFrame, name: str) -> str:
    """`name`, lengthened until no column of `frame` has it."""
    taken = {column.lower() for column in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@contextmanager
def _own_shuffles(spark: SparkSession) -> Iterator[None]:
    """What runs inside leaves no shuffle files: its result is kept elsewhere, so nothing reads them again."""
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "true")
    try:
        yield
    finally:
        spark.conf.set(setting, before)


def shared_checkpoint(frame: DataFrame) -> DataFrame:
    """`frame` computed once and kept in the shared folder, so that no later stage repeats it."""
    spark = frame.sparkSession
    if spark.sparkContext.getCheckpointDir() is None:
        spark.sparkContext.setCheckpointDir(shared_base(spark))
    with _own_shuffles(spark):
        return frame.checkpoint(eager=True)


def shared_table(frame: DataFrame, label: str, rows: int = 0) -> DataFrame:
    """Like `shared_checkpoint`, for larger data: written as Parquet and read again; removed when Python ends.

    A file has at most `rows` rows, if given: a reader holds thousands at once, which is too much of large ones.
    """
    spark = frame.sparkSession
    path = f"{shared_base(spark)}/{label}-{uuid.uuid4().hex}"
    with _own_shuffles(spark):
        (frame.write.option("maxRecordsPerFile", rows) if rows else frame.write).parquet(path)
    remove_at_end(spark, path)
    return spark.read.parquet(path)
