import time
from collections import Counter

import numpy as np
import pytest
from compare import compare
from corpus import MIDDLE, awkward, connect, frame, shingles

from storetally.llm import decontamination as d

ITEM = "one two three four five six seven eight nine ten eleven twelve"


def items(spark, rows):
    return spark.createDataFrame([(*row, "x", 1) for row in rows], "item_id bigint, text string, shingles string, n int")


@pytest.fixture(scope="module")
def rows():
    long = " ".join(f"w{i}" for i in range(30_000))
    words = ITEM.split()
    return awkward() + [
        (501, long + " " + ITEM.upper() + " " + long),
        (502, "x " + " ".join(words[:6]) + " y " + " ".join(words[6:])),
        (503, " ".join(words[:11])),
        (504, "one"),
        (505, ITEM + "\n" + ITEM),
    ]


ITEMS = [(1, ITEM), (2, "one"), (3, None), (4, ""), (None, ITEM), (1, ITEM), (6, "not there at all in any text"), (7, "two words")]


def expected(rows, benchmark):
    found = Counter()
    for item_id, item in benchmark:
        own = shingles(item, 5)
        for doc_id, text in rows:
            shared = len(own & shingles(text, 5))
            if own and 100 * shared >= 80 * len(own):
                found[(doc_id, item_id, len(own), shared)] += 1
    return found


def test_matches_sql(spark):
    assert compare(d.op10_decontamination(spark, MIDDLE), connect(), d.ORACLE) == []


@pytest.mark.parametrize("block", [d.BLOCK_SHINGLES, 10])
def test_awkward_texts(spark, monkeypatch, rows, block):
    monkeypatch.setattr(d, "BLOCK_SHINGLES", block)
    found = d.contained_items(frame(spark, rows), items(spark, ITEMS))
    assert Counter(tuple(row) for row in found.collect()) == expected(rows, ITEMS)
    kept = d.drop_contaminated(frame(spark, rows), items(spark, ITEMS))
    assert kept.columns == frame(spark, []).columns
    want = [row for row in rows if not expected([row], ITEMS)]
    assert Counter((row["doc_id"], row["text"]) for row in kept.collect()) == Counter(want)


def test_cost_does_not_grow_with_the_items():
    """Documents of 500 shingles against 100,000 items, some of which they contain."""
    rng = np.random.default_rng(7)
    items = [(i, np.unique(rng.integers(0, 2**63, 20).astype(np.uint64))) for i in range(100_000)]
    index = d.Index(items, 80, 100)
    documents = [np.unique(np.concatenate([rng.integers(0, 2**63, 480).astype(np.uint64), items[i][1]])) for i in range(300)]
    begin = time.perf_counter()
    found = [index.search(document) for document in documents]
    assert time.perf_counter() - begin < 0.3 * 3  # three times 1 ms a document
    assert found == [[(i, 20)] for i in range(300)]


def test_empty_tables(spark, rows):
    assert d.contained_items(frame(spark, rows), items(spark, [])).collect() == []
    assert d.contained_items(frame(spark, []), items(spark, ITEMS)).collect() == []
    assert d.drop_contaminated(frame(spark, rows), items(spark, [])).count() == len(rows)
