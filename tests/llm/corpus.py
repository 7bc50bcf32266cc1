"""Small texts with the awkward cases, and plain versions of shared notions."""

from __future__ import annotations

import random
from pathlib import Path

import duckdb

SMALL = "/root/testdata/sf0.001"
MIDDLE = "/root/testdata/sf0.01"

# Columns of documents plus names that operators might use themselves.
SCHEMA = (
    "doc_id bigint, text string, lang string, source string, n_chars bigint, score double, key string, place int, "
    "class string, contaminated string, kept_id string, ids string, terms_to_replace string, toxicity_score string"
)


def frame(spark, texts):
    """A documents table of (doc_id, text) pairs, with extra columns that are NULL."""
    rows = [(i, t, "en", "src", None if t is None else len(t), *[None] * 9) for i, t in texts]
    return spark.createDataFrame(rows, SCHEMA)


def words(text):
    return (text or "").encode().lower().split()


def shingles(text, size):
    found = words(text)
    if len(found) < size:
        return {(len(found), *found)} if found else set()
    return {tuple(found[i : i + size]) for i in range(len(found) - size + 1)}


def awkward(seed=3):
    """(doc_id, text) with NULLs, empty, blank and long texts, repeated rows, exact and near copies, shared passages."""
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdeé") for _ in range(rng.randint(2, 7))) for _ in range(300)]

    def prose(count):
        return " ".join(rng.choice(vocabulary) for _ in range(count))

    texts = [None, "", " \n\t ", "one", "two words", "ONE", " ", "tab\tand\x0bfeed"]
    passage = prose(70)
    for _ in range(6):
        base = prose(rng.randint(20, 150))
        texts += [base, base.upper().replace("É", "é"), base]
        copy = base.split()
        for _ in range(4):
            copy = list(copy)
            copy[rng.randrange(len(copy))] = "changed" + str(rng.randrange(9))
            texts.append(" ".join(copy))
    texts += [prose(30) + "\n" + passage + "\n" + prose(40) for _ in range(6)]
    texts += [prose(4000), "abcabcabc" * 60, "a" * 700, "a" * 300 + "b" + "a" * 300]
    ids = list(range(len(texts)))
    rng.shuffle(ids)
    rows = list(zip(ids, texts))
    # Repeated rows, a repeated id with another text, NULL ids.
    return rows + rows[10:13] + [(ids[20], prose(25)), (None, prose(30)), (None, None), (None, rows[12][1])]


def read(name, folder=SMALL):
    return duckdb.sql(f"SELECT * FROM '{folder}/{name}.parquet'").fetchall()


def connect(folder=MIDDLE):
    connection = duckdb.connect()
    for name in "documents embeddings pages benchmark labels".split():
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{Path(folder) / name}.parquet'")
    return connection


def roots(count, links):
    """The component of each of `count` nodes."""
    found = list(range(count))

    def root(i):
        while found[i] != i:
            i = found[i]
        return i

    for a, b in links:
        a, b = root(a), root(b)
        found[max(a, b)] = min(a, b)
    return [root(i) for i in range(count)]


def plain_components(texts, size, similarity):
    """component number of each text, by comparing all pairs; similarity is (p, q)."""
    sets = [shingles(text, size) for text in texts]
    links = []
    for i, a in enumerate(sets):
        for j in range(i):
            common = len(a & sets[j])
            if common and similarity[1] * common >= similarity[0] * len(a | sets[j]):
                links.append((i, j))
    return roots(len(texts), links), sets
