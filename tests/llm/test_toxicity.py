import zlib

import numpy as np
from corpus import MIDDLE, awkward, frame, read

from storetally.llm import toxicity as t


def test_held_out_accuracy(spark):
    labels = {row[0]: row[2] for row in read("labels", "/root/testdata/sf0.1")}
    found = t.op9_toxicity(spark, "/root/testdata/sf0.1").collect()
    assert len(found) == len(read("documents", "/root/testdata/sf0.1"))
    for row in found[:200]:
        assert row["held_out"] == (zlib.crc32(str(row["doc_id"]).encode()) % 5 == 0)
        assert row["predicted"] == (row["score"] >= 0.5) and 0 <= row["score"] <= 1
    held = [row for row in found if row["held_out"] and row["doc_id"] in labels]
    toxic = [row["predicted"] for row in held if labels[row["doc_id"]]]
    clean = [row["predicted"] for row in held if not labels[row["doc_id"]]]
    assert np.mean(toxic) >= 0.85 and np.mean(clean) <= 0.02


def test_learns_a_pair_that_weights_cannot(spark):
    """Toxic is either both terms or none, among other words: neither term tells anything by itself."""
    rng = np.random.default_rng(1)
    texts, labels = [], {}
    for doc_id in range(4000):
        one, other = rng.random(2) < 0.5
        words = [f"word{i}" for i in rng.integers(0, 300, 30)] + ["insult"] * int(one) + ["group"] * int(other)
        texts.append((doc_id, " ".join(rng.permutation(words))))
        labels[doc_id] = int(one == other)
    docs = frame(spark, texts)
    known = spark.createDataFrame([(i, 1, one) for i, one in labels.items()], "doc_id bigint, quality int, toxic int")
    scored = t.score(docs, t.fit(docs, known), name="toxicity").filter(t.held_out(t.F.col("doc_id"))).collect()
    assert len(scored) > 600
    assert np.mean([(row["toxicity"] >= 0.5) == labels[row["doc_id"]] for row in scored]) > 0.95


def test_scores_sum_all_pairs():
    """The machine's score from its definition: every pair of distinct terms."""
    rng = np.random.default_rng(2)
    feature = np.full(1 << t.BITS, -1, dtype=np.int32)
    feature[:20] = np.arange(20)
    machine = t.Machine(-0.3, feature, rng.normal(size=20), rng.normal(size=(20, t.FACTORS)))
    rows = [rng.integers(0, 40, n) for n in (0, 1, 5, 30)]
    found = machine.scores(np.concatenate(rows), np.repeat(np.arange(4), [len(row) for row in rows]), 4)
    for row, score in zip(rows, found):
        own = [int(one) for one in set(row.tolist()) if one < 20]
        total = machine.bias + sum(machine.weights[i] for i in own)
        total += sum(machine.factors[i] @ machine.factors[j] for i in own for j in own if i < j)
        assert np.isclose(score, 1 / (1 + np.exp(-np.clip(total, -30, 30))))


def test_awkward_tables(spark):
    rows = awkward()
    docs = frame(spark, rows)
    labels = spark.createDataFrame([(None, 1, 1), (3, 1, None), (5, 0, 0), (5, 0, 0), (6, 1, 1), (99, 1, 1)], "doc_id bigint, quality int, toxic int")
    scored = t.score(docs, t.fit(docs, labels), name="toxicity")
    assert scored.columns == [*docs.columns, "toxicity"]
    assert scored.count() == len(rows)
    kept = t.drop_toxic(docs, labels.limit(0))
    assert kept.count() == len(rows) and kept.schema == docs.schema
    assert t.score(docs.limit(0), t.fit(docs.limit(0), labels), name="toxicity").collect() == []


def test_same_scores_twice(spark):
    one, two = ({row["doc_id"]: row["score"] for row in t.op9_toxicity(spark, MIDDLE).collect()} for _ in range(2))
    assert one == two
