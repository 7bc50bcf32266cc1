from collections import Counter

import pytest
from corpus import SMALL, awkward, frame, read

from storetally.llm import token_counts as t


@pytest.fixture(scope="module")
def ranks():
    return t.load_ranks()


def lengths(texts, ranks):
    encode = t.encoding(ranks).encode_ordinary
    return [len(encode(text)) if text else 0 for text in texts]


def expected(counts):
    total, rows = sum(counts), []
    for limit, n in sorted(Counter(counts).items()):
        within = [c for c in counts if c <= limit]
        cut = sum(min(c, limit) for c in counts)
        rows.append((limit, n, len(within), sum(within), len(counts) - len(within), total - sum(within), cut, len(within) / len(counts), sum(within) / total if total else 1.0))
    return rows


def test_limits(spark, ranks, monkeypatch):
    monkeypatch.setattr(t, "BUCKET", 16)
    rows = awkward()
    histogram = t.length_histogram(frame(spark, rows), ranks)
    counts = lengths([text for _, text in rows], ranks)
    assert [tuple(row) for row in t.limits(histogram).orderBy("n_tokens").collect()] == expected(counts)
    for limit in (0, 1, 50, 10**6):
        row = t.truncated_total(histogram, limit).first()
        assert tuple(row) == (len(counts), sum(counts), sum(min(c, limit) for c in counts))
    found = {row["share"]: row["n_tokens"] for row in t.quantiles(histogram, [0.1, 0.5, 0.99, 1.0]).collect()}
    ordered = sorted(counts)
    assert found == {share: next(c for i, c in enumerate(ordered, 1) if sum(x <= c for x in ordered) / len(ordered) >= share) for share in found}


def test_whole_table(spark, ranks):
    counts = lengths([row[1] for row in read("documents")], ranks)
    found = t.op3_token_counts(spark, SMALL).orderBy("n_tokens").collect()
    assert [tuple(row) for row in found] == expected(counts)


def test_empty_table(spark, ranks):
    histogram = t.length_histogram(frame(spark, []), ranks)
    assert t.limits(histogram).collect() == []
    assert tuple(t.truncated_total(histogram, 5).first()) == (0, 0, 0)
