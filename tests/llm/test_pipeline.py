from collections import Counter

import corpus_pipeline
from corpus import SMALL, awkward, frame, plain_components, read, shingles
from test_pii import base

from storetally.llm import toxicity


def test_stages_one_after_the_other(spark):
    """The whole run against plain versions of its stages."""
    rows = [(row[0], row[1]) for row in read("documents")]
    docs = spark.read.parquet(f"{SMALL}/documents.parquet")
    machine = toxicity.fit(docs, spark.read.parquet(f"{SMALL}/labels.parquet"))
    toxic = {row["doc_id"] for row in toxicity.score(docs, machine).filter("score >= 0.5").collect()}
    rows = [row for row in rows if row[0] not in toxic]
    roots, sets = plain_components([text for _, text in rows], 5, (80, 100))
    least = {}
    for (doc_id, _), root in zip(rows, roots):
        least[root] = min(least.get(root, doc_id), doc_id)
    rows = [row for row, root, one in zip(rows, roots, sets) if not one or least[root] == row[0]]
    items = [shingles(row[1], 5) for row in read("benchmark")]
    rows = [row for row in rows if not any(one and 100 * len(one & shingles(row[1], 5)) >= 80 * len(one) for one in items)]
    found = corpus_pipeline.run(spark, SMALL).collect()
    assert sorted(row["doc_id"] for row in found) == sorted(doc_id for doc_id, _ in rows)
    texts = dict(rows)
    for row in found:
        assert row["round_trip"] and row["n_pieces"] == len(row["ids"])
        assert not base(row["text"])
        if not base(texts[row["doc_id"]]):
            assert row["text"] == texts[row["doc_id"]]


def test_every_stage_takes_awkward_rows(spark):
    rows = awkward()
    for name, stage in corpus_pipeline.STAGES:
        docs = frame(spark, rows)
        found = stage(spark, docs, SMALL)
        assert found.columns[: len(docs.columns)] == docs.columns, name
        assert found.count() <= len(rows)
        if name != "sentencepiece":
            assert found.schema == docs.schema, name
        empty = stage(spark, frame(spark, []), SMALL)
        assert empty.collect() == [], name
    assert [name for name, _ in corpus_pipeline.STAGES] == ["toxicity", "ngram_join", "decontamination", "pii", "sentencepiece"]


def test_queries_are_registered():
    import __spark_entry__ as entry

    names = Counter(name.split("_")[0] for name in entry.queries())
    assert all(names[f"op{n}"] == 1 for n in range(1, 11)) and "pipeline" in entry.queries()
    assert set(entry.oracle_sql()) <= set(entry.queries())
