import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import pytest
from compare import compare
from corpus import MIDDLE, awkward, connect, frame
from hypothesis import given
from hypothesis import strategies as st

from storetally.llm import exact_dedup as e


def spaced(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def expected(rows):
    groups = defaultdict(list)
    for doc_id, text in rows:
        groups[spaced(text)].append(doc_id)
    found = Counter()
    for text, ids in groups.items():
        least = min((i for i in ids if i is not None), default=None)
        sha = hashlib.sha256(text.encode()).hexdigest()
        found[(least, least, len(ids), True, sha)] += 1
        ids.remove(least)
        for i in ids:
            found[(i, least, len(ids) + 1, False, sha)] += 1
    return found


def marked(spark, rows, parts=4):
    return Counter(tuple(row) for row in e.mark_copies(frame(spark, rows).repartition(parts)).collect())


@pytest.fixture(scope="module")
def rows():
    rows = awkward() + [(700 + i, "the same  \t text " + "\n" * (i % 3 + 1)) for i in range(60)]
    long = "long text of a megabyte and more " * 40_000
    return rows + [(900, long), (901, long.replace(" ", "\r\n")), (902, long + "x"), (903, " "), (904, "   ")]


def test_matches_sql(spark):
    assert compare(e.op11_exact_dedup(spark, MIDDLE), connect(), e.ORACLE) == []


@pytest.mark.parametrize("size", [e.BLOCK_ROWS, 3])
def test_awkward_texts(spark, monkeypatch, rows, size):
    monkeypatch.setattr(e, "BLOCK_ROWS", size)
    assert marked(spark, rows) == expected(rows)


def test_small_senders_and_wrong_suspects(spark, monkeypatch, rows):
    monkeypatch.setattr(e, "BLOCK_ROWS", 5)
    monkeypatch.setattr(e, "SENDER_PRINTS", 12)
    monkeypatch.setattr(e, "SPARE", -4)  # many texts share a fingerprint; their bytes tell them apart
    assert marked(spark, rows, 2) == expected(rows)


def test_hot_group(spark):
    rows = [(i, "hot" if i % 3 else f"text {i}") for i in range(3000)]
    assert marked(spark, rows, 16) == expected(rows)


def test_empty_and_single(spark):
    assert marked(spark, []) == Counter()
    assert marked(spark, [(None, None)]) == expected([(None, None)])
    assert e.drop_copies(frame(spark, [])).count() == 0


def test_drop_copies(spark, rows):
    docs = frame(spark, rows)
    kept = e.drop_copies(docs)
    assert kept.columns == docs.columns
    texts = [spaced(row["text"]) for row in kept.collect()]
    assert sorted(texts) == sorted({spaced(text) for _, text in rows})


def test_nothing_is_left(spark, rows):
    before = {row["tableName"] for row in spark.sql("SHOW TABLES").collect()}
    marked(spark, rows)
    assert {row["tableName"] for row in spark.sql("SHOW TABLES").collect()} == before


def test_texts_are_shuffled_only_if_suspected(spark):
    docs = spark.range(4000).selectExpr("id AS doc_id", "concat('text ', id, repeat(' word', 200)) AS text")
    rows = docs.repartition(8)
    path = rows.mapInArrow(e._blocks, e._TEXTS).write.bucketBy(8, "block").format("parquet")
    path.mode("overwrite").saveAsTable("dedup_plan_test")
    plan = e._suspects(spark.table("dedup_plan_test"))._jdf.queryExecution().executedPlan().toString()
    spark.sql("DROP TABLE dedup_plan_test")
    above_texts = plan.split("ShuffledHashJoin")[1].split("FileScan")[0]
    assert "Exchange" not in above_texts, plan


@given(st.lists(st.integers(0, 2**40), max_size=200), st.integers(0, 45))
def test_codes(gaps, k):
    gaps = [gap >> max(0, 30 - k) for gap in gaps]
    values = np.array(gaps, dtype=np.uint64)
    assert e.decode(e.encode(values, k), len(values), k).tolist() == gaps


def test_codes_are_short():
    prints = np.sort(np.random.default_rng(1).integers(0, 2**28, 100_000).astype(np.uint64))
    k = e.rice_parameter(2**28, len(prints))
    payload = e.encode(np.diff(prints, prepend=np.uint64(0)), k)
    assert 8 * len(payload) < len(prints) * 13.5  # log2(2**28 / 100000) = 11.4 bits a gap and 1.5 more


@pytest.mark.parametrize("text", ["", " ", "a", " a", "a ", "\ta\n\nb\r", "a\x0b\x0cb", "\x1ca", "a\u0085b", "  "])
def test_normal(text):
    assert e.normal(text.encode()).decode() == spaced(text)
