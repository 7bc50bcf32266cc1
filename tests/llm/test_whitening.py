import math
from collections import defaultdict

import numpy as np
import pytest
from corpus import MIDDLE, read

from storetally.llm import whitening as w

COLUMNS = ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]


def plain(rows):
    """(vec_id, deviation, x - mean) and the eigenpairs of the covariance, from its definition."""
    fit = [(i, [math.floor(64 * float(c)) + 1_000_000 for c in v]) for i, v in rows if v and all(c is not None and math.isfinite(c) for c in v)]
    n = len(fit)
    sums = [sum(x[j] for _, x in fit) for j in range(len(fit[0][1]))]
    away = [[n * a - s for a, s in zip(x, sums)] for _, x in fit]
    centred = np.array(away, dtype=float) / n
    values, vectors = np.linalg.eigh(centred.T @ centred / n)
    return fit, [sum(a * a for a in one) for one in away], centred, values[::-1], vectors[:, ::-1]


def check(found, rows, components, tolerance=1e-8):
    fit, deviations, centred, values, vectors = plain(rows)
    components = min(components, len(values))
    assert len(found) == len(fit) * components
    by = defaultdict(list)
    for row in found:
        assert row["n"] == len(fit)
        assert row["identity_error"] <= 1e-10
        by[row["component"]].append(row)
    assert sorted(by) == list(range(1, components + 1))
    for component, own in by.items():
        e, u = values[component - 1], vectors[:, component - 1]
        want = sorted(zip([i for i, _ in fit], deviations, centred @ u / np.sqrt(e)), key=lambda one: (one[0] is None, one[:2], abs(one[2])))
        own = sorted(own, key=lambda row: (row["vec_id"] is None, (row["vec_id"], row["deviation"]), abs(row["whitened"])))
        assert [(row["vec_id"], row["deviation"]) for row in own] == [one[:2] for one in want]
        got, exact = np.array([row["whitened"] for row in own]), np.array([one[2] for one in want])
        assert min(np.abs(got - exact).max(), np.abs(got + exact).max()) < tolerance
        assert own[0]["explained"] == pytest.approx(e / values.sum(), rel=1e-10)


def vectors(spark, rows):
    return spark.createDataFrame([(*row, "x", 1) for row in rows], "vec_id bigint, embedding array<float>, ids string, n int")


def test_table(spark):
    rows = [row[:2] for row in read("embeddings", MIDDLE)]
    found = w.op12_whitening(spark, MIDDLE)
    assert found.columns == COLUMNS
    check(found.collect(), rows, 32)


def random_rows(count, width, seed=2):
    made = np.random.default_rng(seed).standard_normal((count, width)) * np.linspace(1, 3, width)
    return [(i, np.float32(one).tolist()) for i, one in enumerate(made)]


def test_awkward_rows(spark):
    rows = random_rows(200, 6)
    rows += [(500, None), (501, []), (502, [None] * 6), (503, [1.0, 2.0, 3.0, 4.0, 5.0, float("nan")])]
    rows += [(504, [float("inf")] + [0.0] * 5), rows[3], (3, rows[4][1]), (None, rows[5][1])]
    check(w.whiten(vectors(spark, rows).repartition(5)).collect(), rows, 32, 1e-10)
    check(w.whiten(vectors(spark, rows), 2).collect(), rows, 2, 1e-10)


def test_other_widths_take_no_part(spark):
    rows = random_rows(50, 4)
    found = w.whiten(vectors(spark, rows + [(900, [1.0]), (901, [1.0, 2.0])])).collect()
    check(found, rows, 4, 1e-10)


@pytest.mark.parametrize("rows", [[], [(1, None)], [(1, [1.0, 2.0])], [(1, [1.0, 2.0])] * 3])
def test_without_variance(spark, rows):
    found = w.whiten(vectors(spark, rows))
    assert found.columns == COLUMNS and found.collect() == []


def test_directions_without_variance(spark):
    rows = [(i, [a, b, a + b, 7.0]) for i, (a, b) in enumerate([(0.0, 1.0), (2.0, 5.0), (3.0, 1.0), (8.0, 2.0)])]
    found = w.whiten(vectors(spark, rows)).collect()
    assert {row["component"] for row in found} == {1, 2}
    assert all(row["identity_error"] < 1e-10 for row in found)


def test_many_tasks_fold(spark):
    rows = random_rows(300, 5)
    check(w.whiten(vectors(spark, rows).repartition(80)).collect(), rows, 5, 1e-10)


def test_large_sums_are_exact(spark):
    rows = [(i, [2.0**40 * (i % 3), float(i), 1.0 - i]) for i in range(9)]
    found = w.transform(w.fit(w.pack(vectors(spark, rows)))).collect()
    assert {row["vec_id"]: int(row["deviation"]) for row in found} == {
        i: d for (i, _), d in zip(rows, plain(rows)[1])
    }


@pytest.mark.parametrize("width, wanted", [(300, 10), (120, 32), (64, 32), (40, 40), (7, 32)])
def test_solver(width, wanted):
    """Subspaces far below the width: rounds, restarts and locking."""
    rng = np.random.default_rng(5)
    turn = np.linalg.qr(rng.standard_normal((width, width)))[0]
    values = np.sort(np.concatenate([rng.uniform(0, 1, width - 3), [1.5, 1.5, 20]]))[::-1]
    matrix = (turn * values) @ turn.T
    blocks = []
    found, vectors = w.jacobi_davidson(lambda x: blocks.append(x.shape[1]) or matrix @ x, width, wanted)
    wanted = min(wanted, width)
    assert np.abs(found - values[:wanted]).max() < 1e-12 * 20
    assert np.abs(vectors.T @ vectors - np.eye(wanted)).max() < 1e-12
    assert np.linalg.norm(matrix @ vectors - vectors * found, axis=0).max() < 1e-12 * 20
    assert max(blocks) < width or width <= wanted + 8


def test_minres_solves_indefinite():
    rng = np.random.default_rng(6)
    turn = np.linalg.qr(rng.standard_normal((12, 12)))[0]
    matrix = (turn * np.linspace(-3, 4, 12)) @ turn.T
    right = rng.standard_normal((12, 5))
    assert np.allclose(matrix @ w.minres(lambda x: matrix @ x, right, 40, 1e-12), right, atol=1e-9)
