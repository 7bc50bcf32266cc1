"""Toxicity scores by a factorization machine over hashed terms.

A text is its set of terms, hashed into 2^18 buckets: runs of letters and digits,
A-Z as a-z, and the first four and five bytes of longer ones, which stand for compounds. The score is sigmoid(b + sum of weights + sum over pairs of terms
of the products of their factors), so two terms together, such as an insult and
the mention of a group, may weigh more or less than their sum.

The machine is fitted in one task on at most `SAMPLE` labelled rows, the first
by a hash of doc_id. Terms that `LEAST_TEXTS` of them hold are features, whatever their labels: a term that
matters only in pairs is one, too. The machine weighs them by itself, by follow-the-regularised-leader:
a weight leaves 0, and a factor its random start near 0, only once the slopes that speak for that
have summed up to `LASSO` times the root of the number of rows. Scoring reads every whole text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storetally.llm.texts import LETTERS, fresh, mix, portions, slices, table, word_hashes

SAMPLE = 20_000
BITS = 18
PREFIXES = (4, 5)
FACTORS = 4
# Toxic rows are fewer and count so many times.
TOXIC_WEIGHT = 4.0
EPOCHS = 6
LEAST_TEXTS = 10
LASSO = 0.36
# A row whose score errs by less teaches nothing more.
SURE = 0.03
# Steps of weights and factors, the pull towards their start, and the spread of the factors' start.
STEP, FACTOR_STEP, RIDGE, SPREAD = 1.0, 0.1, 0.1, 0.01


def _terms(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, rows, buckets, row of each bucket) of runs of texts."""
    for row, data, offsets in slices(column):
        words, first = word_hashes(data, offsets, LETTERS)
        rows = len(offsets) - 1
        of = np.repeat(np.arange(rows), np.diff(first))
        kinds = [words, *(word_hashes(data, offsets, LETTERS, prefix)[0] + np.uint64(prefix) for prefix in PREFIXES)]
        buckets = np.stack([(mix(kind) >> np.uint64(64 - BITS)).astype(np.int64) for kind in kinds], axis=1)
        yield row, rows, buckets.ravel(), np.repeat(of, len(kinds))


def _labelled_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found: list[bytes] = []
        for _, rows, buckets, of in _terms(batch.column(2)):
            cuts = np.searchsorted(of, np.arange(rows + 1))
            found += [np.unique(buckets[a:b]).astype(np.int32).tobytes() for a, b in zip(cuts, cuts[1:])]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(found, pa.binary())], ["place", "label", "terms"]
        )


@dataclass(frozen=True)
class Machine:
    """Weights by feature; `feature` has a bucket's feature, or -1."""

    bias: float
    feature: np.ndarray
    weights: np.ndarray
    factors: np.ndarray

    def scores(self, buckets: np.ndarray, rows: np.ndarray, count: int) -> np.ndarray:
        features = self.feature[buckets]
        used = features >= 0
        size = max(1, len(self.weights))
        pairs = np.unique(rows[used] * size + features[used])
        of, features = pairs // size, pairs % size
        total = self.bias + np.bincount(of, self.weights[features], minlength=count)
        for factor in self.factors.T:
            sums = np.bincount(of, factor[features], minlength=count)
            total += 0.5 * (sums**2 - np.bincount(of, factor[features] ** 2, minlength=count))
        return 1.0 / (1.0 + np.exp(-np.clip(total, -30, 30)))


class _Leader:
    """Numbers by feature that follow the regularised leader, each from its start."""

    def __init__(self, start: np.ndarray, step: float, lasso: float):
        self.start, self.step, self.lasso = start, step, lasso
        self.now = start.copy()
        self.sums, self.squares = np.zeros_like(start), np.zeros_like(start)

    def move(self, features: np.ndarray, slopes: np.ndarray) -> None:
        before = self.squares[features]
        after = before + slopes**2
        turn = (np.sqrt(after) - np.sqrt(before)) / self.step
        sums = self.sums[features] + slopes - turn * (self.now[features] - self.start[features])
        self.sums[features], self.squares[features] = sums, after
        pulled = np.sign(sums) * np.maximum(np.abs(sums) - self.lasso, 0)
        self.now[features] = self.start[features] - pulled / ((1 + np.sqrt(after)) / self.step + RIDGE)


def train(terms: list[np.ndarray], labels: np.ndarray) -> Machine:
    """A machine fitted on logistic loss, `EPOCHS` times over the rows; no toxic rows give scores near 0."""
    feature = np.full(1 << BITS, -1, dtype=np.int32)
    toxic = labels.astype(bool)
    ones, zeros = int(toxic.sum()), int((~toxic).sum())
    if not ones:
        return Machine(-30.0, feature, np.zeros(0), np.zeros((0, FACTORS)))
    texts = np.zeros(1 << BITS, dtype=np.int64)
    for own in terms:
        texts[own] += 1
    chosen = np.flatnonzero(texts >= LEAST_TEXTS)
    feature[chosen] = np.arange(len(chosen))
    rows = [feature[own][feature[own] >= 0] for own in terms]
    rng = np.random.Generator(np.random.PCG64(7))
    lasso = LASSO * len(rows) ** 0.5
    weights = _Leader(np.zeros(len(chosen)), STEP, lasso)
    factors = _Leader(rng.normal(0, SPREAD, (len(chosen), FACTORS)), FACTOR_STEP, lasso)
    bias, seen = float(np.log((ones + 0.5) / (zeros + 0.5))), 1.0
    for _ in range(EPOCHS):
        for row in rng.permutation(len(rows)):
            own = rows[row]
            mine = factors.now[own]
            sums = mine.sum(axis=0)
            score = bias + weights.now[own].sum() + 0.5 * ((sums**2).sum() - (mine**2).sum())
            slope = 1.0 / (1.0 + np.exp(-min(max(score, -30.0), 30.0))) - float(toxic[row])
            if abs(slope) < SURE:
                continue
            slope *= TOXIC_WEIGHT if toxic[row] else 1.0
            seen += slope**2
            bias -= 0.5 * slope / seen**0.5
            if len(own):
                weights.move(own, np.full(len(own), slope))
                factors.move(own, slope * (sums - mine))
    # What never left its start says nothing; terms of which nothing is left are not looked up.
    moved = np.where(factors.now != factors.start, factors.now, 0.0)
    used = (weights.now != 0) | moved.any(axis=1)
    feature[:] = -1
    feature[chosen[used]] = np.arange(used.sum())
    return Machine(bias, feature, weights.now[used], moved[used])


def _fit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    rows = [row for batch in batches for row in batch.to_pylist()]
    rows.sort(key=lambda row: (row["place"], row["label"], row["terms"]))
    machine = train(
        [np.frombuffer(row["terms"], dtype=np.int32) for row in rows], np.array([row["label"] for row in rows], dtype=int)
    )
    used = np.flatnonzero(machine.feature >= 0).astype(np.int32)
    yield pa.RecordBatch.from_arrays(
        [
            pa.array([machine.bias]),
            pa.array([used.tobytes()], pa.binary()),
            pa.array([machine.weights.tobytes()], pa.binary()),
            pa.array([machine.factors.tobytes()], pa.binary()),
        ],
        ["bias", "buckets", "weights", "factors"],
    )


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learnt from; a NULL doc_id is not among them."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit(docs: DataFrame, labels: DataFrame, text: str = "text", sample: int = SAMPLE) -> Machine:
    """The machine for `labels` (doc_id, toxic 0 or 1) on the texts of `docs`.

    Held out rows, NULL ids and NULL labels are left out; of repeated ids in
    `labels` the greatest label counts. At most `sample` labels are used. The
    machine has at most 2^18 features, so it passes through the driver.
    """
    chosen = (
        labels.filter("doc_id IS NOT NULL AND toxic IS NOT NULL")
        .filter(~held_out(F.col("doc_id")))
        .groupBy("doc_id")
        .agg(F.max(F.col("toxic").cast("int")).alias("label"))
        .select(F.xxhash64("doc_id").alias("place"), F.col("doc_id").alias("label_id"), "label")
        .orderBy("place", "label_id")
        .limit(sample)
    )
    rows = (
        docs.select("doc_id", F.col(text).alias("text"))
        # At most `sample` rows of three numbers.
        .join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id"))
        .select("place", "label", "text")
        .mapInArrow(_labelled_terms, "place bigint, label int, terms binary")
    )
    model = rows.repartition(1).mapInArrow(_fit, "bias double, buckets binary, weights binary, factors binary").first()
    if model is None:
        return train([], np.zeros(0, dtype=int))
    used = np.frombuffer(model["buckets"], dtype=np.int32)
    feature = np.full(1 << BITS, -1, dtype=np.int32)
    feature[used] = np.arange(len(used))
    return Machine(
        model["bias"],
        feature,
        np.frombuffer(model["weights"]),
        np.frombuffer(model["factors"]).reshape(len(used), FACTORS),
    )


def score(docs: DataFrame, machine: Machine, text: str = "text", name: str = "score") -> DataFrame:
    """`docs` with the score of each whole text, 0 to 1, as a last column `name`.

    A NULL or empty text has no terms and gets the machine's bias as its score.
    Repeated rows score alike, an empty table gives no rows; other columns stay.
    """
    place = docs.columns.index(text)
    schema = docs.select("*", F.lit(0.0).alias(name)).schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            found = np.zeros(batch.num_rows)
            for row, rows, buckets, of in _terms(batch.column(place)):
                found[row : row + rows] = machine.scores(buckets, of, rows)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found)], [*batch.schema.names, name])

    return docs.mapInArrow(run, schema)


def drop_toxic(docs: DataFrame, labels: DataFrame, text: str = "text") -> DataFrame:
    """The rows of `docs` that score below 0.5, with the same columns.

    NULL and empty texts score by the machine's bias; without toxic labels all rows stay. Repeated rows
    are judged alike, an empty table stays empty.
    """
    name = fresh(docs, "toxicity_score")
    return score(docs, fit(docs, labels, text), text, name).filter(F.col(name) < 0.5).select(*docs.columns)


def op9_toxicity(spark, sf_dir: str) -> DataFrame:
    """Scores of all of `documents`, learnt from `labels` outside the held out fifth."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    machine = fit(docs, table(spark, sf_dir, "labels"))
    return score(docs, machine).select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"),
    )
