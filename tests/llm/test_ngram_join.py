import random
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest
from compare import compare
from corpus import MIDDLE, SMALL, awkward, connect, frame, plain_components, read

from storetally.llm import ngram_join
from storetally.llm.components import components
from storetally.llm.ngram_join import ORACLE, drop_near_copies, join_cell, op2_ngram_join


def expected(rows, size, similarity):
    found, sets = plain_components([text for _, text in rows], size, similarity)
    least = {}
    for (doc_id, _), root in zip(rows, found):
        if doc_id is not None:
            least[root] = min(least.get(root, doc_id), doc_id)
    return Counter(
        (doc_id, len(one), least.get(root) if one else doc_id) for (doc_id, _), root, one in zip(rows, found, sets)
    )


def result(frame):
    return Counter(tuple(row) for row in frame.select("doc_id", "n_shingles", "component_id").collect())


def test_matches_sql(spark):
    assert compare(op2_ngram_join(spark, MIDDLE), connect(), ORACLE) == []


@pytest.mark.parametrize(("size", "similarity"), [(5, (80, 100)), (3, (90, 100)), (2, (1, 2))])
def test_awkward_texts(spark, size, similarity):
    rows = awkward()
    found = ngram_join.ngram_join(frame(spark, rows), *similarity, size=size)
    assert result(found) == expected(rows, size, similarity)


def test_cells_of_a_large_block(spark, monkeypatch):
    """Blocks of many cells give the same components as one cell."""
    monkeypatch.setattr(ngram_join, "CELL_TEXTS", 3)
    rng = random.Random(5)
    rows, base = [], [f"w{rng.randrange(500)}" for _ in range(60)]
    for doc_id in range(60):
        if doc_id % 20 == 0:
            base = list(base)
            rng.shuffle(base[:30])
        text = list(base)
        for _ in range(rng.randrange(4)):
            text[rng.randrange(60)] = f"x{rng.randrange(99)}"
        rows.append((doc_id, " ".join(text)))
    rows += [row for row in awkward() if row[0] is None]
    found = ngram_join.ngram_join(frame(spark, rows), 80, 100, size=5)
    assert result(found) == expected(rows, 5, (80, 100))


def test_hot_shards_are_blocks(spark, monkeypatch):
    """Shards of more texts than are searched by bounds give the same components."""
    monkeypatch.setattr(ngram_join, "SHARD_TEXTS", 2)
    rng = random.Random(6)
    footer = [f"f{k}" for k in range(40)]
    rows = [(k, " ".join([*footer, *(f"w{rng.randrange(k % 7 + 1)}" for _ in range(20))])) for k in range(80)]
    rows += awkward()
    found = ngram_join.ngram_join(frame(spark, rows), 80, 100, size=5)
    assert result(found) == expected(rows, 5, (80, 100))


def test_shard_of_many_bytes_is_a_star():
    points = [bytes([1] * 64)] * 4
    columns = [pa.array([9, 9, 9, 9]), pa.array([1, 2, 3, 4]), pa.array([64] * 4), pa.array(points)]
    batch = pa.RecordBatch.from_arrays(columns, ["shard", "node", "n", "point"])
    for most_bytes in (0, 1 << 20):
        edges = pa.Table.from_batches(ngram_join._near(80, 100, most_bytes)(iter([batch])))
        assert {(u, v) for u, v in zip(*edges.to_pydict().values()) if u != v} == {(1, 2), (1, 3), (1, 4)}


def test_keys_of_a_class_are_given_once_a_task():
    long = " ".join(f"w{k}" for k in range(60_000))
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array([long, None, "a b", long])], ["doc_id", "text"])
    found = list(ngram_join._classes(5, 80, 100)(iter([batch, batch])))
    rows = [row for one in found for row in one.to_pylist()]
    texts = [row for row in rows if row["n_shingles"] is not None]
    listed = [row for row in rows if row["n_shingles"] is None]
    assert [row["n_shingles"] for row in texts] == [59_996, 0, 1, 59_996] * 2
    assert all(row["keys"] is None for row in texts) and all(row["doc_id"] is None for row in listed)
    assert max(len(row["keys"]) for row in listed) == ngram_join.KEYS_A_ROW
    keys = [(row["node"], key) for row in listed for key in row["keys"]]
    assert len(keys) == len(set(keys)) > ngram_join.KEYS_A_ROW
    assert {node for node, _ in keys} == {row["node"] for row in texts if row["n_shingles"]}


def test_small_table_at_five_words(spark):
    rows = [(row[0], row[1]) for row in read("documents")]
    found = ngram_join.ngram_join(spark.read.parquet(f"{SMALL}/documents.parquet"))
    assert result(found) == expected(rows, 5, (80, 100))


def test_empty_table(spark):
    assert ngram_join.ngram_join(frame(spark, [])).collect() == []


def test_one_of_each_group_stays(spark):
    rows = awkward()
    kept = drop_near_copies(frame(spark, rows), 80, 100, size=5)
    assert kept.columns == frame(spark, []).columns
    found = Counter((row["doc_id"], row["text"]) for row in kept.collect())
    want = Counter()
    for (doc_id, count, component), _ in expected(rows, 5, (80, 100)).items():
        if count and doc_id == component:
            for one in {text for i, text in rows if i == doc_id and (text or "").encode().split()}:
                want[(doc_id, one)] = 1
    for row in rows:
        if not (row[1] or "").encode().split():
            want[row] += 1
    assert found == want


def test_cell_against_all_pairs():
    rng = np.random.default_rng(2)
    base = np.unique(rng.integers(0, 2**63, 400, dtype=np.uint64))
    sets = [np.unique(np.concatenate([rng.choice(base, 300, replace=False), rng.integers(0, 2**63, 20, dtype=np.uint64)])) for _ in range(40)]
    links = join_cell(sets, np.arange(40), 60, 100)
    joined = {(i, j) for i in range(40) for j in range(i) if 100 * len(np.intersect1d(sets[i], sets[j])) >= 60 * len(np.union1d(sets[i], sets[j]))}
    assert all((max(pair), min(pair)) in joined for pair in links)
    from corpus import roots

    assert roots(40, links) == roots(40, joined)


@pytest.mark.parametrize("edges_per_task", [5, 10**6])
def test_components(spark, edges_per_task):
    rng = random.Random(1)
    pairs = [(rng.randrange(80), rng.randrange(80)) for _ in range(60)] + [(i, i + 1) for i in range(100, 160)]
    edges = spark.createDataFrame([*pairs, (None, 3), (7, 7)], "u bigint, v bigint")
    found = {row["node"]: row["root"] for row in components(edges, edges_per_task).collect()}
    from corpus import roots

    want = roots(200, pairs)
    nodes = {i for a, b in pairs if a != b for i in (a, b)}
    assert found == {i: want[i] for i in nodes}
    assert components(edges.limit(0)).collect() == []


@pytest.mark.parametrize("path", [[1, 3, 4, 5, 2], [2, 5, 4, 3, 1, 6], [1, 4, 7, 5, 8, 6, 2, 3]])
def test_chain_over_several_tasks(spark, path):
    """A node may be left with edges to two roots when no root has an edge of its own."""
    edges = spark.createDataFrame(list(zip(path, path[1:])), "u bigint, v bigint")
    for edges_per_task in (1, 2):
        assert {tuple(row) for row in components(edges, edges_per_task).collect()} == {(node, 1) for node in path}
