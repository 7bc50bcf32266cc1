import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from corpus import MIDDLE, awkward, frame, read

from storetally.llm import suffix_dedup as s


def expected(rows):
    """Row results by marking every window that begins earlier elsewhere."""
    first = {}
    order = lambda row: -(2**63) if row[0] is None else row[0]
    texts = [(order(row), (row[1] or "").encode()) for row in rows]
    for doc, text in texts:
        for start in range(len(text) - s.LENGTH + 1):
            window = text[start : start + s.LENGTH]
            first[window] = min(first.get(window, (doc, start)), (doc, start))
    found = Counter()
    for (doc_id, _), (doc, text) in zip(rows, texts):
        out = np.zeros(len(text) + s.LENGTH, dtype=bool)
        for start in range(len(text) - s.LENGTH + 1):
            if first[text[start : start + s.LENGTH]] < (doc, start):
                out[start : start + s.LENGTH] = True
        out = out[: len(text)]
        kept = np.frombuffer(text, dtype=np.uint8)[~out].tobytes()
        spans = int((np.diff(np.concatenate([[0], out.astype(int)])) == 1).sum())
        found[(doc_id, len(text), int(out.sum()), spans, hashlib.sha256(kept).hexdigest())] += 1
    return found


def result(frame):
    return Counter(tuple(row) for row in frame.collect())


@pytest.mark.parametrize("hot", [s.HOT_CONTEXTS, 2])
def test_awkward_texts(spark, monkeypatch, hot):
    monkeypatch.setattr(s, "HOT_CONTEXTS", hot)
    rows = awkward()
    found = s.remove_repeats(frame(spark, rows))
    assert result(found.drop("kept")) == expected(rows)
    for row in found.collect():
        assert hashlib.sha256(row["kept"]).hexdigest() == row["kept_sha256"]


def test_whole_table(spark):
    rows = [(row[0], row[1]) for row in read("documents", MIDDLE)]
    found = result(s.op5_suffix_dedup(spark, MIDDLE))
    assert found == expected(rows)
    assert sum(row[2] for row in found) > 0


def test_empty_table(spark):
    assert s.remove_repeats(frame(spark, [])).collect() == []


@pytest.mark.parametrize("alphabet", [b"a", b"ab", b"abc\xff", bytes(range(256))])
def test_suffix_array(alphabet):
    rng = random.Random(7)
    for size in (1, 2, 3, 50, 400):
        text = bytes(rng.choice(alphabet) for _ in range(size))
        found = s.suffix_array(np.frombuffer(text, dtype=np.uint8), depth=size + 8)
        assert found.tolist() == sorted(range(size), key=lambda i: text[i:])
    period = b"abcab" * 60
    order = s.suffix_array(np.frombuffer(period, dtype=np.uint8), depth=104)
    assert sorted(order.tolist()) == list(range(300))
    heads = [period[i : i + 104] for i in order]
    assert heads == sorted(heads)


def test_common_prefixes():
    text = np.frombuffer(b"banana_bananas_ban" + b"x" * 120 + b"y" + b"x" * 120, dtype=np.uint8)
    places = np.array([0, 7, 15, 18, 139, 19])
    assert s.common_prefixes(text, places).tolist() == [0, 6, 3, 0, 100, 100]


def test_runs_cover_every_window_once():
    rng = np.random.default_rng(4)
    data = rng.integers(97, 101, 3000).astype(np.uint8)
    offsets = np.array([0, 40, 40, 900, 999, 3000])
    _, _, first, count = s.runs(data, offsets)
    windows = np.concatenate([np.arange(a, a + n) for a, n in zip(first, count)])
    want = [i for a, b in zip(offsets, offsets[1:]) for i in range(a, b - s.LENGTH + 1)]
    assert windows.tolist() == want
