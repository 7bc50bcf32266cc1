import numpy as np
import pytest
from corpus import MIDDLE, read

from storetally.llm import ann
from storetally.llm.texts import shared_table


def plain(ids, vectors, every, nearest):
    """query: [(score, vec_id)] by comparing with all."""
    found = {}
    norms = np.sqrt((vectors * vectors).sum(axis=1))
    for row in np.flatnonzero(ids % every == 0):
        scores = vectors @ vectors[row] / (norms * norms[row])
        order = np.lexsort((ids, -scores))
        found[int(ids[row])] = [(float(scores[i]), int(ids[i])) for i in order if ids[i] != ids[row]][:nearest]
    return found


def recall(rows, want):
    found = {}
    for row in rows:
        found.setdefault(row["query_id"], []).append((row["rank"], row["vec_id"], row["score"]))
    assert set(found) == set(want)
    hits = 0
    for query, best in want.items():
        own = sorted(found[query])
        assert [rank for rank, _, _ in own] == list(range(1, len(best) + 1))
        assert [score for _, _, score in own] == sorted((score for _, _, score in own), reverse=True)
        hits += len({i for _, i, _ in own} & {i for _, i in best})
    return hits / sum(map(len, want.values()))


def test_recall_on_the_table(spark):
    rows = read("embeddings", MIDDLE)
    ids, vectors = np.array([row[0] for row in rows]), np.array([row[1] for row in rows], dtype=np.float64)
    assert recall(ann.op6_ann(spark, MIDDLE).collect(), plain(ids, vectors, 50, 5)) >= 0.99


def test_recall_over_shards(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 1500)
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(5000, 48)) + 2 * rng.normal(size=(20, 48))[rng.integers(0, 20, 5000)]
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    assert recall(ann.nearest_vectors(table).collect(), plain(np.arange(5000), vectors, 50, 5)) >= 0.9


@pytest.fixture(scope="module")
def awkward(spark):
    same, nan = [1.0, 2.0], float("nan")
    rows = [(i, same) for i in range(0, 40)] + [(40, [2.0, 4.0]), (50, [0.0, 0.0]), (51, None), (52, [None, 1.0]), (53, [nan, 1.0])]
    rows += [(54, [float("inf"), 1.0]), (55, []), (None, same), (100, [-1.0, 0.5]), (100, [-1.0, 0.5]), (150, [1.0, 1.0, 1.0]), (0, same)]
    return spark.createDataFrame([(*row, 1, 2, "x") for row in rows], "vec_id bigint, embedding array<double>, shard int, width int, vector string")


def test_awkward_vectors(spark, awkward):
    found = ann.nearest_vectors(awkward).orderBy("query_id", "rank").collect()
    assert [(row["query_id"], row["rank"], row["vec_id"]) for row in found if row["query_id"] == 0] == [(0, r, r) for r in range(1, 6)]
    assert {row["query_id"] for row in found} == {0, 100}  # 50 is zero; 150 is alone among vectors of three
    assert sum(row["query_id"] == 100 for row in found) == 5


def test_empty_table(spark, awkward):
    assert ann.nearest_vectors(awkward.limit(0)).collect() == []


def test_blocks_and_graphs_meet_without_a_shuffle(spark, monkeypatch):
    monkeypatch.setattr(ann, "SHARD_ROWS", 100)
    monkeypatch.setattr(ann, "BLOCK_ROWS", 10)
    vectors = np.random.default_rng(2).normal(size=(2000, 8))
    table = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id bigint, embedding array<double>")
    found = ann.nearest_vectors(table)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert plan.count("CartesianProduct") == 1
    below = plan[plan.index("CartesianProduct") :]
    # No query is copied to every shard, and neither side is held as a whole.
    assert "Exchange" not in below and "Generate" not in below and below.count("FileScan parquet") == 2
    assert recall(found.collect(), plain(np.arange(2000), vectors, 50, 5)) == 1


def test_repeated_id_takes_one_rank(spark):
    rows = [(0, [1.0, 0.0])] + [(7, [1.0, 0.001 * i]) for i in range(1, 9)] + [(i, [1.0, 0.1 * i]) for i in range(1, 5)]
    table = spark.createDataFrame(rows, "vec_id bigint, embedding array<double>")
    found = [(row["rank"], row["vec_id"]) for row in ann.nearest_vectors(table).orderBy("rank").collect()]
    assert found == [(1, 7), (2, 1), (3, 2), (4, 3), (5, 4)]


def test_a_file_holds_few_graphs(spark):
    kept = shared_table(spark.range(10, numPartitions=1), "few", 4)
    assert len(kept.inputFiles()) == 3 and kept.count() == 10


def test_links_of_a_hub():
    rng = np.random.default_rng(3)
    centre = rng.normal(size=16)
    vectors = ann._units(np.concatenate([[centre], 0.9 * centre + rng.normal(size=(900, 16))]))
    links = ann.build_layer(vectors, 32)
    for row, own in enumerate(links):
        own = own[own >= 0]
        assert len(set(own.tolist())) == len(own) and row not in own
        sims = vectors[own] @ vectors[row]
        assert (np.diff(sims) <= 1e-6).all()
    assert (links[0] >= 0).all()
