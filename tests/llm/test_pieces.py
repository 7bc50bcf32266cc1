import random

import numpy as np
import pyarrow as pa
import pytest
from corpus import MIDDLE, awkward, frame, read

from storetally.llm import pieces as p


@pytest.fixture(scope="module")
def vocabulary():
    return p.Vocabulary.load()


def plain(vocabulary, text):
    """Ids by trying every piece at every place."""
    codec = p.Codec(vocabulary)
    size = len(text)
    best = [(0.0, [])] + [None] * size
    longest = max(map(len, vocabulary.pieces))
    for stop in range(1, size + 1):
        for start in range(max(0, stop - longest), stop):
            piece = vocabulary.pieces.get(text[start:stop])
            if piece:
                total = best[start][0] + piece[1]
                if best[stop] is None or total > best[stop][0]:
                    best[stop] = (total, best[start][1] + [piece[0]])
        if text[stop - 1] not in vocabulary.pieces:
            total = best[stop - 1][0] + codec.penalty
            if best[stop] is None or total > best[stop][0]:
                best[stop] = (total, best[stop - 1][1] + [vocabulary.byte_ids[b] for b in text[stop - 1].encode()])
    return best[size][1]


def ids(codec, text):
    return np.frombuffer(codec.encode(text), dtype="<i4").tolist()


def test_against_all_segmentations(vocabulary):
    codec = p.Codec(vocabulary)
    texts = [text for _, text in awkward() if text] + [row[1] for row in read("documents", MIDDLE)[:60]]
    texts += ["   three   spaces ", "\n\nlines\n", "日本語 😀 ☃", "x\x00y", "a" * 500, "été_été"]
    for text in texts:
        marked = p.MARK + text[:3000].replace(" ", p.MARK)
        assert ids(codec, text[:3000]) == plain(vocabulary, marked)


def test_small_vocabulary():
    rng = random.Random(3)
    for apart in (True, False):
        found = {}
        for piece in [*"abc", p.MARK, "ab", "abc", "bca", p.MARK + "a", p.MARK + "ab", "cab"] + ([] if apart else ["a" + p.MARK + "b"]):
            found[piece] = (len(found), -rng.random() * 5)
        vocabulary = p.Vocabulary(found, tuple(range(100, 356)), 99, 400)
        codec = p.Codec(vocabulary)
        for _ in range(300):
            text = "".join(rng.choice("abc é") for _ in range(rng.randint(1, 14)))
            assert ids(codec, text) == plain(vocabulary, p.MARK + text.replace(" ", p.MARK))
            assert codec.decode(codec.encode(text)) == text


def test_round_trip_of_marks(vocabulary):
    codec = p.Codec(vocabulary)
    for text in (p.MARK, "a" + p.MARK + " b" + p.MARK, p.MARK * 3 + " x", " ", "\n"):
        assert codec.decode(codec.encode(text)) == text


def test_table(spark):
    found = p.op8_sentencepiece(spark, MIDDLE).collect()
    assert len(found) == len(read("documents", MIDDLE))
    assert all(row["round_trip"] and row["n_pieces"] == len(row["ids"]) for row in found)


def test_rows_and_columns_stay(spark, vocabulary):
    rows = awkward()
    docs = frame(spark, rows)
    encoded = p.encode(docs, vocabulary, ids="piece_ids")
    decoded = p.decode(encoded, vocabulary, ids="piece_ids").select("doc_id", "text", "decoded", "round_trip").collect()
    assert len(decoded) == len(rows)
    assert all(row["round_trip"] and row["decoded"] == (row["text"] or "") for row in decoded)
    assert p.encode(docs.limit(0), vocabulary, ids="piece_ids").collect() == []


def test_words_end_with_their_task(vocabulary):
    """A Python worker lives on through later stages; what it keeps counts as the executor's memory there."""
    texts = [f"word{i} other{i % 7}" for i in range(1200)]
    batch = pa.RecordBatch.from_arrays([pa.array(texts)], ["text"])
    found = list(p._encoded(vocabulary, 0, "ids", "same")(iter([batch])))
    codec = p._codec(vocabulary)
    assert not codec.kept and not codec.older
    assert [one for rows in found for one in rows.column(1).to_pylist()] == [ids(codec, text) for text in texts]


def test_words_end_with_a_task_that_stops_early(vocabulary):
    batch = pa.RecordBatch.from_arrays([pa.array(["some words"] * 1200)], ["text"])
    task = p._encoded(vocabulary, 0, "ids", "same")(iter([batch]))
    next(task)
    task.close()
    assert not p._codec(vocabulary).kept
