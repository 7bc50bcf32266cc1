"""Whitening of embeddings by the leading eigenvectors of their covariance (block Jacobi-Davidson).

Every entry c of a vector becomes the whole number floor(64 c) + 1,000,000; sums are exact.
The covariance matrix is never formed: the solver sees it through products with a few
vectors at a time, each one Spark job over the packed vectors, which are centred before
they are multiplied. Tasks return sums as large as the block of vectors, folded in two
steps; the driver holds matrices of a vector's width times a few times the number of components.

The solver expands a subspace by solutions of the projected correction equations

    (I - Z Z') (A - t I) (I - Z Z') s = -r

of all open pairs at once (Z: locked and open Ritz vectors), each by a few steps of MINRES,
takes Ritz pairs of the subspace, locks those whose residual is at double precision, and
restarts with the best Ritz vectors when the subspace is full.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storetally.llm.texts import shared_table, table

SCALE, SHIFT = 64, 1_000_000
COMPONENTS = 32
# Residuals as a share of the largest eigenvalue: rounding errors of a product, no more.
PRECISION = 2e-14
# Eigenvalues below this share of the largest are rounding errors: no variance in their direction.
NO_VARIANCE = 1e-12
MINRES_STEPS = 8
MINRES_GAIN = 0.02
MOST_ROUNDS = 300

_PACK_BYTES = 1 << 21
_PARTIAL = "part bigint, partial binary"


def _pack(width: int):
    """Rows of (id, whole numbers) as rows of many: ids and one matrix."""
    most = max(1, _PACK_BYTES // (8 * width))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for begin in range(0, batch.num_rows, most):
                own = batch.slice(begin, most)
                ids = pa.array([own.column(0).to_pylist()], pa.list_(pa.int64()))
                entries = own.column(1).flatten().to_numpy(zero_copy_only=False).astype(np.int64)
                yield pa.RecordBatch.from_arrays([ids, pa.array([entries.tobytes()], pa.binary())], ["ids", "entries"])

    return run


def _matrices(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[tuple[list, np.ndarray]]:
    for batch in batches:
        for ids, entries in zip(batch.column("ids").to_pylist(), batch.column("entries").to_pylist()):
            yield ids, np.frombuffer(entries, dtype=np.int64).reshape(-1, width)


@dataclass
class Packed:
    """The fit list: a table of packed vectors of one width, their number and exact sums."""

    rows: DataFrame
    width: int
    n: int
    sums: list[int]

    def centred(self) -> Callable[[np.ndarray], np.ndarray]:
        """What turns whole numbers into doubles less their mean."""
        whole = np.array([total // self.n for total in self.sums], dtype=np.int64)
        rest = np.array([total % self.n for total in self.sums], dtype=np.float64) / self.n
        return lambda entries: (entries - whole).astype(np.float64) - rest

    def folded(self, partial: Callable[[Iterator[np.ndarray]], np.ndarray]) -> np.ndarray:
        """The sum over all tasks of what `partial` makes of a task's matrices, in a fixed order."""
        width = self.width

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            own = np.asarray(partial(entries for _, entries in _matrices(batches, width)), dtype=np.float64)
            part = TaskContext.get().partitionId()
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([own.tobytes()])], ["part", "partial"])

        def fold(parts: pa.Table) -> pa.Table:
            parts = parts.sort_by("part")
            total = sum(np.frombuffer(own) for own in parts.column("partial").to_pylist())
            return pa.table({"part": parts.column("part").slice(0, 1), "partial": pa.array([total.tobytes()])})

        partials = self.rows.mapInArrow(run, _PARTIAL)
        tasks = self.rows.rdd.getNumPartitions()
        if tasks > 64:
            partials = partials.groupBy((F.col("part") % int(tasks**0.5)).alias("group")).applyInArrow(fold, _PARTIAL)
        found = sorted(partials.collect(), key=lambda row: row["part"])
        return sum(np.frombuffer(row["partial"]) for row in found)

    def product(self, vectors: np.ndarray) -> np.ndarray:
        """The covariance matrix times `vectors`."""
        centred, shape = self.centred(), vectors.shape

        def partial(matrices: Iterator[np.ndarray]) -> np.ndarray:
            total = np.zeros(shape)
            for entries in matrices:
                own = centred(entries)
                total += own.T @ (own @ vectors)
            return total

        return self.folded(partial).reshape(shape) / self.n

    def trace(self) -> float:
        centred = self.centred()
        total = self.folded(lambda matrices: np.array([sum(np.square(centred(one)).sum() for one in matrices)]))
        return float(total[0]) / self.n


def _exact_sums(rows: DataFrame, width: int) -> tuple[int, list[int]]:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, high, low = 0, np.zeros(width, dtype=np.int64), np.zeros(width, dtype=np.int64)
        for _, entries in _matrices(batches, width):
            count += len(entries)
            high += (entries >> 32).sum(axis=0)
            low += (entries & 0xFFFFFFFF).sum(axis=0)
        places = np.arange(width)
        yield pa.RecordBatch.from_arrays(
            [pa.array(places), pa.array(high), pa.array(low), pa.array(np.full(width, count))], ["place", "high", "low", "n"]
        )

    parts = rows.mapInArrow(run, "place bigint, high bigint, low bigint, n bigint")
    wide = [F.sum(F.col(name).cast("decimal(20,0)")).alias(name) for name in ("high", "low", "n")]
    found = parts.groupBy("place").agg(*wide).orderBy("place").collect()
    return (int(found[0]["n"]) if found else 0), [(int(row["high"]) << 32) + int(row["low"]) for row in found]


def pack(frame: DataFrame, ids: str = "vec_id", vector: str = "embedding") -> Packed | None:
    """The vectors of `frame` that take part, packed in the shared folder; None if there are none."""
    entry = F.transform(F.col(vector), lambda c: c.cast("double"))
    rows = frame.select(F.col(ids).cast("bigint").alias("id"), entry.alias("v")).filter(
        F.col("v").isNotNull() & (F.size("v") > 0)
        & F.forall("v", lambda c: F.coalesce(~F.isnan(c) & (F.abs(c) < F.lit(float("inf"))), F.lit(False)))
    )
    widths = rows.groupBy(F.size("v").alias("width")).count().orderBy(F.desc("count"), F.desc("width")).limit(1).collect()
    if not widths:
        return None
    width = widths[0]["width"]
    whole = F.transform("v", lambda c: F.floor(c * SCALE) + F.lit(SHIFT).cast("bigint"))
    packed = rows.filter(F.size("v") == width).select("id", whole.alias("x"))
    kept = shared_table(packed.mapInArrow(_pack(width), "ids array<bigint>, entries binary"), "whitening-vectors")
    return Packed(kept, width, *_exact_sums(kept, width))


def minres(apply: Callable, right: np.ndarray, steps: int, gain: float) -> np.ndarray:
    """Each column x with least |right - A x| after some steps of MINRES, all columns in step.

    Stops when every residual is below `gain` times its right side.
    """

    def dot(a, b):
        return np.einsum("ij,ij->j", a, b)

    def ratio(a, b):
        return np.divide(a, b, out=np.zeros_like(a), where=b > 0)

    x, rest = np.zeros_like(right), right.copy()
    begin = np.sqrt(dot(right, right))
    p, s = rest, apply(rest)
    before: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
    for step in range(steps):
        length = dot(s, s)
        # A column whose direction has vanished is solved.
        length[length <= (1e-30 * begin) ** 2] = 0
        alpha = ratio(dot(rest, s), length)
        x = x + alpha * p
        rest = rest - alpha * s
        if step + 1 == steps or (np.sqrt(dot(rest, rest)) <= gain * begin).all():
            break
        before = [(p, s, length), *before[:1]]
        p, s = s, apply(s)
        for old_p, old_s, old_length in before:
            beta = ratio(dot(s, old_s), old_length)
            p, s = p - beta * old_p, s - beta * old_s
    return x


def _added(vectors: np.ndarray, *bases: np.ndarray) -> np.ndarray:
    """An orthonormal basis of what `vectors` add to orthonormal `bases`."""
    lengths = np.linalg.norm(vectors, axis=0)
    vectors = vectors[:, lengths > 0] / lengths[lengths > 0]
    for _ in range(3):
        for base in bases:
            vectors = vectors - base @ (base.T @ vectors)
        left, sizes, _ = np.linalg.svd(vectors, full_matrices=False)
        vectors = left[:, sizes > 1e-9]
    return vectors


def jacobi_davidson(
    product: Callable[[np.ndarray], np.ndarray], width: int, wanted: int, seed: int = 12
) -> tuple[np.ndarray, np.ndarray]:
    """(values, vectors) of the `wanted` largest eigenvalues, falling, of a symmetric positive matrix.

    The matrix is only met as `product(block of vectors)`. Ends when all residuals are at most
    PRECISION * sqrt(width) times the largest eigenvalue and no larger Ritz value is open;
    raises RuntimeError if that is not reached within MOST_ROUNDS.
    """
    wanted = min(wanted, width)
    most = min(width, 3 * wanted + 16)
    kept = min(width, wanted + wanted // 2 + 8)
    start = np.random.default_rng(seed).standard_normal((width, min(width, wanted + 8)))
    locked, values = np.zeros((width, 0)), np.zeros(0)
    basis = _added(start)
    image = product(basis)
    for _ in range(MOST_ROUNDS):
        ritz, turn = np.linalg.eigh((basis.T @ image + image.T @ basis) / 2)
        ritz, turn = ritz[::-1], turn[:, ::-1]
        basis, image = basis @ turn, image @ turn
        top = max([0.0, *ritz[:1], *values])
        bound = PRECISION * np.sqrt(width) * top
        rest = image - basis * ritz
        # Locks the converged pairs among those that are wanted.
        head = np.arange(len(ritz)) < wanted
        done = head & (np.linalg.norm(rest, axis=0) <= bound)
        locked, values = np.hstack([locked, basis[:, done]]), np.concatenate([values, ritz[done]])
        head, ritz = head[~done], ritz[~done]
        basis, image, rest = basis[:, ~done], image[:, ~done], rest[:, ~done]
        least = np.sort(values)[::-1][wanted - 1] if len(values) >= wanted else -np.inf
        open_ = np.flatnonzero(head & (ritz > least))[:wanted]
        if len(values) >= wanted and not len(open_):
            order = np.argsort(-values, kind="stable")[:wanted]
            return values[order], locked[:, order]
        if basis.shape[1] > most - len(open_):
            basis, image = basis[:, :kept], image[:, :kept]
        pairs, thetas = basis[:, open_[open_ < basis.shape[1]]], ritz[open_[open_ < basis.shape[1]]]
        around = np.hstack([locked, pairs])

        def apply(vectors: np.ndarray) -> np.ndarray:
            found = product(vectors) - vectors * thetas
            return found - around @ (around.T @ found)

        right = -rest[:, open_[: pairs.shape[1]]]
        right = right - around @ (around.T @ right)
        new = _added(minres(apply, right, MINRES_STEPS, MINRES_GAIN), locked, basis) if pairs.shape[1] else np.zeros((width, 0))
        if not new.shape[1]:
            # Nothing left in these directions: go on from random ones.
            room = width - locked.shape[1] - basis.shape[1]
            new = _added(np.random.default_rng(seed + len(values)).standard_normal((width, min(room, wanted))), locked, basis)
        if new.shape[1]:
            basis, image = np.hstack([basis, new]), np.hstack([image, product(new)])
    raise RuntimeError(f"{len(values)} of {wanted} eigenvectors converged")


@dataclass
class Whitening:
    """What was fitted: falling eigenvalues, their unit eigenvectors as columns, and how well they whiten."""

    packed: Packed
    values: np.ndarray
    vectors: np.ndarray
    trace: float
    identity_error: float


def fit(packed: Packed, components: int = COMPONENTS) -> Whitening:
    """The leading components of the fit list, each vector's largest entry positive.

    There are fewer than `components` if the width or the number of directions with variance is smaller.
    """
    trace = packed.trace()
    if trace == 0:
        return Whitening(packed, np.zeros(0), np.zeros((packed.width, 0)), 0.0, 0.0)
    values, vectors = jacobi_davidson(packed.product, packed.width, components)
    some = values > NO_VARIANCE * values[0]
    values, vectors = values[some], vectors[:, some]
    vectors = vectors * np.sign(vectors[np.abs(vectors).argmax(axis=0), np.arange(vectors.shape[1])])
    centred, whitener = packed.centred(), vectors / np.sqrt(values)
    count = len(values)

    def moments(matrices: Iterator[np.ndarray]) -> np.ndarray:
        total = np.zeros((count + 1, count))
        for entries in matrices:
            own = centred(entries) @ whitener
            total[0] += own.sum(axis=0)
            total[1:] += own.T @ own
        return total

    total = packed.folded(moments).reshape(count + 1, count) / packed.n
    error = np.abs(total[1:] - np.outer(total[0], total[0]) - np.eye(count)).max()
    return Whitening(packed, values, vectors, trace, float(error))


def transform(model: Whitening) -> DataFrame:
    """(vec_id, deviation, whitened) of every vector of the fit list.

    `deviation` is the exact sum over dimensions of (n x - S)^2 as DECIMAL(38, 0), `whitened` an array
    with one number a component.
    """
    packed, centred = model.packed, model.packed.centred()
    whitener = model.vectors / np.sqrt(model.values)
    n, sums, width = packed.n, packed.sums, packed.width
    whole = np.array([total // n for total in sums], dtype=np.int64)
    rest = [total % n for total in sums]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for ids, entries in _matrices(batches, width):
            apart = entries - whole
            exact = np.array(rest, dtype=np.int64 if n < 1 << 62 else object)
            most = (int(np.abs(apart).max(initial=0)) + 1) * n
            if most * most * width >= 1 << 62:  # beyond 64 bits: whole numbers of any size
                apart, exact = apart.astype(object), np.array(rest, dtype=object)
            deviation = np.square(apart * n - exact).sum(axis=1)
            white = centred(entries) @ whitener
            offsets = pa.array(np.arange(len(ids) + 1) * white.shape[1], pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()),
                    pa.array([str(one) for one in deviation.tolist()]),
                    pa.ListArray.from_arrays(offsets, pa.array(white.ravel())),
                ],
                ["vec_id", "deviation", "whitened"],
            )

    found = packed.rows.mapInArrow(run, "vec_id bigint, deviation string, whitened array<double>")
    return found.withColumn("deviation", F.col("deviation").cast("decimal(38,0)"))


def whiten(frame: DataFrame, components: int = COMPONENTS, ids: str = "vec_id", vector: str = "embedding") -> DataFrame:
    """(vec_id, component, n, deviation, whitened, explained, identity_error) of each vector and component.

    Vectors that are NULL, empty or hold a NULL or non-finite entry take no part; if widths
    differ, only the most frequent one does (the larger of equally frequent ones). NULL ids are carried
    along, repeated rows count as often as they are there. Directions without variance give no
    component; an empty table, one vector, or equal vectors alone give no rows. Entries beyond
    2**63 / 64, and a `deviation` beyond a BIGINT, raise an error. Other columns are ignored.
    """
    schema = (
        "vec_id bigint, component int, n bigint, deviation bigint, whitened double, explained double, identity_error double"
    )
    packed = pack(frame, ids, vector)
    model = fit(packed, components) if packed else None
    if model is None or not len(model.values):
        return frame.sparkSession.createDataFrame([], schema)
    shares = F.array(*[F.lit(float(value / model.trace)) for value in model.values])
    rows = transform(model).select("*", F.posexplode("whitened").alias("place", "one"))
    return rows.select(
        "vec_id",
        (F.col("place") + 1).alias("component"),
        F.lit(packed.n).cast("bigint").alias("n"),
        F.col("deviation").cast("bigint").alias("deviation"),
        F.col("one").alias("whitened"),
        shares[F.col("place")].alias("explained"),
        F.lit(model.identity_error).alias("identity_error"),
    )


def op12_whitening(spark, sf_dir: str) -> DataFrame:
    """Every row of `embeddings` on the 32 leading components of their covariance."""
    return whiten(table(spark, sf_dir, "embeddings"))
