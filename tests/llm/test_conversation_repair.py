import hashlib
import random
import re
import zlib
from functools import cache

import pytest
from corpus import MIDDLE, SMALL, read
from hypothesis import given, settings
from hypothesis import strategies as st

from storetally.llm import conversation_repair as c

COLUMNS = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
# What may follow what: (roles so far as a state, next role) -> state.
LEGAL = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
NAMES = {"u": "user", "a": "assistant"}


def cheapest(rows):
    """(cost, audit, lines) from the definition, over suffixes with whole strings; rows: (role, text, must go, cut)."""

    @cache
    def best(i, state, inserted):
        found = []
        if i == len(rows) and state in ("", "a"):
            found.append((0, "", ()))
        if inserted < 3:
            for role, name in NAMES.items():
                if (state, role) in LEGAL:
                    cost, audit, lines = best(i, LEGAL[state, role], inserted + 1)
                    found.append((cost + 3, "I" + audit, (name + ":", *lines)))
        if i < len(rows):
            role, text, must, cut = rows[i]
            cost, audit, lines = best(i + 1, state, 0)
            found.append((cost + 4, "D" + audit, lines))
            if not must:
                options = [("K", 0, role[:1], role)] + [("R", 3, r, name) for r, name in NAMES.items()]
                for edit, price, r, name in options:
                    if (state, r) in LEGAL:
                        cost, audit, lines = best(i + 1, LEGAL[state, r], 0)
                        found.append((cost + price + 3 * cut, edit + audit, (f"{name}:{text}", *lines)))
        return min(found, key=lambda one: one[:2], default=(10**9, "", ()))

    return best(0, "", 0)


def expected(conv_id, rows):
    """The result row of one conversation's rows (turn, role, text)."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda row: (row[0] is not None, row[0] or 0, row[1].encode(), row[2].encode()))
    turns = [t for t, _, _ in rows if t is not None]
    seen, marked, counts = set(), [], [0, 0, 0]
    for _, role, text in rows:
        solid = re.findall(r"[^\x20\x09-\x0D]", text)
        fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        marked.append((role, text, fault in (0, 1), fault == 2))
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
    cost, audit, lines = cheapest(tuple(marked))
    gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
    return (conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest())


def damaged(rows):
    for conv_id, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv_id is None else conv_id}:{' ' if turn is None else turn}"
        code = zlib.crc32(key.encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        for _ in range([0, 1, 1, 2, 1][code] if code < 5 else 1):
            yield conv_id, turn, "user" if code == 4 else role, text


def by_conversation(rows, ids):
    own = {conv_id: [] for conv_id in ids}
    for conv_id, *row in rows:
        own[conv_id].append(row)
    return sorted((expected(*one) for one in own.items()), key=str)


def found(frame):
    assert frame.columns == COLUMNS
    return sorted((tuple(row) for row in frame.collect()), key=str)


def frame(spark, rows):
    schema = "conv_id bigint, turn bigint, role string, text string, chunk string, digest int, present string, at string"
    return spark.createDataFrame([(*row, "x", 1, None, "y") for row in rows], schema)


@pytest.mark.parametrize("folder", [SMALL, MIDDLE])
def test_table(spark, folder):
    rows = read("conversations", folder)
    assert found(c.op13_conversation_repair(spark, folder)) == by_conversation(damaged(rows), {row[0] for row in rows})


def awkward(seed=4, conversations=60):
    rng = random.Random(seed)
    texts = ["One.", "Two!", "cut", "", " \n", None, "Three? ", "é.", "cut\t", " .", "a" * 300]
    roles = ["system", "user", "assistant", "tool", "", None, "User"]
    rows = []
    for conv_id in [None, *range(conversations)]:
        for turn in range(rng.randrange(9)):
            rows.append((conv_id, rng.choice([turn, turn, turn, 1, None, turn * 3]), rng.choice(roles[:3] * 4 + roles), rng.choice(texts)))
    return rows + rows[5:20]


@pytest.mark.parametrize("size", [c.CHUNK_ROWS, 1, 3])
def test_awkward_rows(spark, monkeypatch, size):
    monkeypatch.setattr(c, "CHUNK_ROWS", size)
    rows = awkward()
    assert found(c.audit(frame(spark, rows))) == by_conversation(rows, {row[0] for row in rows})
    lost = c.audit(c.damage(frame(spark, rows)), c.F.col("present"))
    assert found(lost) == by_conversation(damaged(rows), {row[0] for row in rows})


def test_empty_and_lost(spark):
    assert found(c.audit(frame(spark, []))) == []
    gone = c.audit(frame(spark, [(1, 0, "user", "Hello.")]), c.F.lit(False))
    assert found(gone) == [(1, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest())]


def test_giant_conversation(spark, monkeypatch):
    """One conversation with most of all rows, in many chunks, with a text of two megabytes."""
    monkeypatch.setattr(c, "CHUNK_ROWS", 500)
    rng = random.Random(8)
    rows = [(7, i, rng.choice(["user", "assistant", "system"]), f"Text {rng.randrange(3000)}" + rng.choice(["", ".", "!"])) for i in range(6000)]
    rows += [(7, 6001, "user", "long " * 400_000)]
    rows += [(8 + i, j, "user", "Same.") for i in range(300) for j in range(3)]
    (one,) = [row for row in found(c.audit(frame(spark, rows))) if row[0] == 7]
    assert one == from_the_end(7, rows)


def from_the_end(conv_id, rows):
    """As `expected`, for a long conversation in the order of its turns: whole strings, filled from the end."""
    own = [row[1:] for row in rows if row[0] == conv_id]
    seen, marked, counts = set(), [], [0, 0, 0]
    for _, role, text in own:
        solid = text.strip(" \t\n\x0b\x0c\r")
        fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else None
        seen.add((role, text))
        if fault is not None:
            counts[fault] += 1
        marked.append((role, text, fault in (0, 1), fault == 2))

    def closed(best):
        """With inserts before what `best` holds."""
        for _ in range(3):
            for state in ("", "s", "u", "a"):
                for r, name in NAMES.items():
                    if (state, r) in LEGAL and best.get(LEGAL[state, r]):
                        cost, audit, lines = best[LEGAL[state, r]]
                        one = (cost + 3, "I" + audit, (name + ":", lines))
                        best[state] = min(best.get(state) or one, one, key=lambda x: x[:2])
        return best

    best = closed({"": (0, "", None), "a": (0, "", None)})
    for role, text, must, cut in reversed(marked):
        new = {}
        for state in ("", "s", "u", "a"):
            options = []
            if best.get(state):
                cost, audit, lines = best[state]
                options.append((cost + 4, "D" + audit, lines))
            if not must:
                for edit, price, r, name in [("K", 0, role[:1], role)] + [("R", 3, r, n) for r, n in NAMES.items()]:
                    after = best.get(LEGAL.get((state, r)))
                    if after:
                        options.append((after[0] + price + 3 * cut, edit + after[1], (f"{name}:{text}", after[2])))
            if options:
                new[state] = min(options, key=lambda x: x[:2])
        best = closed(new)
    cost, audit, lines = best[""]
    whole = []
    while lines:
        whole.append(lines[0])
        lines = lines[1]
    turns = [t for t, _, _ in own]
    illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(own, own[1:]))
    gaps = max(turns) - min(turns) + 1 - len(set(turns))
    return (conv_id, gaps, *counts, illegal, cost, audit, hashlib.sha256("\n".join(whole).encode()).hexdigest())


def test_repaired_rows(spark, monkeypatch):
    monkeypatch.setattr(c, "CHUNK_ROWS", 2)
    rows = awkward(9, 30)
    repaired = c.repair(frame(spark, rows)).collect()
    digests = {row[0]: row[-1] for row in found(c.audit(frame(spark, rows)))}
    for conv_id, digest in digests.items():
        own = sorted((row for row in repaired if row["conv_id"] == conv_id), key=lambda row: row["place"])
        assert hashlib.sha256("\n".join(f"{row['role']}:{row['text']}" for row in own).encode()).hexdigest() == digest
        assert re.fullmatch("(s?(ua)+)?", "".join(row["role"][:1] for row in own))


@settings(max_examples=400, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["system", "user", "assistant", "x"]), st.booleans(), st.booleans()), max_size=9))
def test_program(rows):
    """The states of the program against whole strings."""
    conversation = c._Conversation(1)
    for place, (role, must, cut) in enumerate(rows):
        conversation.add(place, role, f"{place}", must, False, cut)
    row = conversation.row(True)
    edits = list(c._applied(*row[9:12], row[15], row[14]))
    cost, audit, lines = cheapest(tuple((role, f"{place}", must, cut and not must) for place, (role, must, cut) in enumerate(rows)))
    assert (row[8], "".join(edit[0] for edit in edits)) == (cost, audit)
    assert tuple(f"{edit[2]}:{edit[3]}" for edit in edits if edit[2] is not None) == lines
