import hashlib
import math
import re
from collections import Counter, defaultdict

import pytest
from corpus import MIDDLE, awkward, frame, read

from storetally.llm import pii

EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+"
IP = r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)"
CARD = r"[0-9]([\x20-]?[0-9])+"
PHONE = r"\+[0-9][\x20().0-9-]+[0-9]"


def luhn(digits):
    total = 0
    for place, digit in enumerate(map(int, reversed(digits))):
        digit = digit * 2 if place % 2 else digit
        total += digit - 9 if digit > 9 else digit
    return total % 10 == 0


def base(text):
    """(kind number, start, stop, match) of the valid matches."""
    text = text or ""
    found = [(0, m.start(), m.end(), m[0].lower()) for m in re.finditer(EMAIL, text)]
    found += [(1, m.start(), m.end(), m[0]) for m in re.finditer(IP, text) if all(int(p) <= 255 for p in m[0].split("."))]
    for kind, pattern in ((2, CARD), (3, PHONE)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == 2 and 16 <= len(digits) <= 19 and luhn(digits) or kind == 3 and 8 <= len(digits) <= 15:
                found.append((kind, m.start(), m.end(), digits))
    return found


def disclosing(texts):
    """(entity, term): disclosure, from its definition over documents."""
    n_term, n_entity, n_both = Counter(), Counter(), Counter()
    for text in texts:
        text = text or ""
        n_term.update(set(re.findall(r"[^\W\d_]{3,}", text.lower())))
        near = defaultdict(set)
        for kind, start, stop, match in base(text):
            ends = [m.span() for m in re.finditer((EMAIL, IP, CARD, PHONE)[kind], text)]
            left = max([end for _, end in ends if end <= start], default=0)
            right = min([begin for begin, _ in ends if begin >= stop], default=len(text))
            before, after = text[left:start], text[stop:right]
            if len(before) > pii.NEAR:
                before = re.sub(r"^[^\W\d_]+", "", before[-pii.NEAR :])
            if len(after) > pii.NEAR:
                after = re.sub(r"[^\W\d_]+$", "", after[: pii.NEAR])
            near[(kind, match)].update(re.findall(r"[^\W\d_]{3,}", f"{before} {after}".lower()))
        n_entity.update(near.keys())
        n_both.update((entity, term) for entity, terms in near.items() for term in terms)
    found = {}
    for (entity, term), both in n_both.items():
        if both >= pii.LEAST_DOCUMENTS and n_entity[entity] < len(texts):
            ic = math.log(len(texts) / n_entity[entity])
            value = (ic - math.log(n_term[term] / both)) / ic
            if value >= pii.GENERALISE:
                found[(entity, term)] = value
    return found


def expected(rows):
    shown = disclosing([text for _, text in rows])
    found = Counter()
    for doc_id, text in rows:
        spans = base(text)
        entities = {(kind, match) for kind, _, _, match in spans}
        terms = {term for (entity, term) in shown if entity in entities}
        every = sorted((kind, start, stop) for kind, start, stop, _ in spans)
        names = ["email", "ip", "card", "phone"]
        written = [f"{names[kind]}:{start}:{stop}" for kind, start, stop in every]
        digest = hashlib.sha256(",".join(written).encode()).hexdigest()
        hits = [m for m in re.finditer(r"[^\W\d_]{3,}", text or "") if m[0].lower() in terms]
        written += [f"term:{m.start()}:{m.end()}" for m in hits]
        counts = Counter(kind for kind, _, _ in every)
        found[(doc_id, *(counts[k] for k in range(4)), digest, ",".join(written), len(hits))] += 1
    return found


PLANTED = [
    "mail me: a.b+c@x-y.example.com, or A.B+C@X-Y.example.com.",
    "a@b.c._x@y.zz a@@b.cc x@y@z.com no@dot @.a a@b..c é@b.co",
    "1.2.3.4.5.6.7.8 256.1.1.1 001.02.3.00255 1.2.3 9.9.9.9999",
    "4111 1111 1111 1111 and 4111-1111-1111-1112, 4111111111111111 1 5500 0000 0000 0004",
    "+1 (212) 555-0100 +44.20.7946.0958 +1 2 +123456789012345678 ++1 234 5678 +1-",
    "x" * 300 + "@" + "a." * 300 + "com " + "1" * 400 + " " + "1.2." * 300 + "+" + "1 " * 300,
    "😀 mail😀me@example.org 😀 10.0.0.1",
]


@pytest.fixture(scope="module")
def rows():
    shared = [(1000 + i, f"Dr Quimby works at clinic{i}\nquimby can be reached: q.imby@mail.example.com today {i}\nend") for i in range(14)]
    return awkward() + list(enumerate(PLANTED, 500)) + shared + [shared[0], (2000, shared[1][1]), (2001, None)]


def test_finds_what_plain_python_finds(spark, rows):
    found = pii.find_personal_data(frame(spark, rows))
    assert Counter(tuple(row) for row in found.collect()) == expected(rows)
    assert found.columns == ["doc_id", "n_email", "n_ip", "n_card", "n_phone", "base_sha256", "spans", "n_term"]
    assert sum(row[-1] * n for row, n in expected(rows).items()) > 5  # quimby is a term


def test_whole_table(spark):
    rows = [(row[0], row[1]) for row in read("documents", MIDDLE)]
    assert Counter(tuple(row) for row in pii.op1_pii(spark, MIDDLE).collect()) == expected(rows)


FILLER = ["the project of a team", "some words about the weather and the sea", "contact us for more", None]
LINE = "Project Zebrafish contact jane@corp.example"


@pytest.mark.parametrize(
    "planted",
    [
        [LINE] * 20,
        [f"{LINE}\nnote {'abcdefghijklmnopqrst'[i]}" for i in range(20)],
        [line for i in range(4) for line in [f"{LINE} {'one two six ten'.split()[i]}"] * 10],
        ["Project Zebrafish\njane@corp.example"] * 5,
        ["Lead: Zebrafish\n\nMail:\njane@corp.example\nProject Aurora" + " x" * i for i in range(4)],
    ],
    ids=["copies", "one line", "four lines", "line before", "block"],
)
def test_terms_of_copies_and_neighbouring_lines(spark, planted):
    """A term that occurs only near its entity is found however it is copied or broken into lines."""
    texts = planted + [FILLER[i % 4] for i in range(400)]
    found = pii.find_personal_data(frame(spark, list(enumerate(texts)))).collect()
    for row in found:
        text, spans = texts[row["doc_id"]] or "", [span.split(":") for span in row["spans"].split(",") if span]
        terms = {text[int(start) : int(stop)] for kind, start, stop in spans if kind == "term"}
        assert ("Zebrafish" in terms) == ("Zebrafish" in text)
        assert not terms & {"the", "weather", "sea"}
    clean = pii.sanitise(frame(spark, list(enumerate(texts)))).collect()
    assert not [row for row in clean if row["text"] and "zebrafish" in row["text"].lower()]
    assert Counter(row["text"] for row in clean if row["doc_id"] >= len(planted)) == Counter(texts[len(planted) :])


def test_terms_beyond_other_matches(spark):
    """What is near an entity goes on behind other matches of its kind, valid or not."""
    texts = [
        f"Zebrafish card issued 2024-{i}, limit 1500: 4111 1111 1111 1111, renew 31 or 12 with Aurora" for i in range(10, 15)
    ]
    texts += [f"Quimby office{'abcde'[i]}@x.zz, jane@corp.example, b.{'abcde'[i]}@y.zz (Tolliver)" for i in range(5)]
    # Matches side by side, code points, and a border within a word.
    texts += ["Nebulous " + "12x" * 33 + " 😀 10.0.0.1 " + "😀" * 112 + " Borderline" + " x" * i for i in range(4)]
    texts += ["Outside " + "1.2.3 " * 20 + "10.0.0.9 " + "9.9.9.999 " * 12 + "Beyond" + " x" * i for i in range(4)]
    rows = list(enumerate(texts + [FILLER[i % 4] for i in range(400)]))
    shown = {(row["entity"], row["term"]): row["disclosure"] for row in pii.disclosing_terms(frame(spark, rows)).collect()}
    plain = {}
    for text in texts:
        for kind, start, stop, match in base(text):
            before, after = text[:start], text[stop:]
            if len(before) > pii.NEAR:
                before = re.sub(r"^[^\W\d_]+", "", before[-pii.NEAR :])
            if len(after) > pii.NEAR:
                after = re.sub(r"[^\W\d_]+$", "", after[: pii.NEAR])
            entity = f"{['email', 'ip', 'card', 'phone'][kind]}:{match}"
            for term in set(re.findall(r"[^\W\d_]{3,}", f"{before} {after}".lower())):
                plain.setdefault((entity, term), []).append(text)
    assert {pair for pair, where in plain.items() if len(where) >= pii.LEAST_DOCUMENTS and pair[1] not in ("the", "with")} == {
        pair for pair in shown if pair[1] not in ("the", "with")
    }
    terms = {term for _, term in shown}
    assert {"zebrafish", "aurora", "quimby", "tolliver", "nebulous"} <= terms
    assert not terms & {"borderline", "outside", "beyond"}


def test_only_built_in_functions(spark):
    plan = pii.op1_pii(spark, MIDDLE)._jdf.queryExecution().toString()
    assert not re.search("Python|Arrow|Pandas", plan)


def test_sanitised_texts(spark, rows):
    docs = frame(spark, rows)
    found = pii.sanitise(docs)
    assert found.schema == docs.schema
    texts = Counter(row["text"] for row in found.collect())
    assert sum(texts.values()) == len(rows)
    for row in found.collect():
        assert not base(row["text"])
        assert row["n_chars"] == (None if row["text"] is None else len(row["text"]))
    clean = [text for _, text in rows if not base(text)]
    for text in clean:
        assert texts[text] >= 1
    assert any(text and "[EMAIL]" in text for text in texts)
    assert not any(text and "quimby" in text.lower() for text in texts)


def test_very_long_runs(spark):
    """Runs that a matcher could retry from every place or recurse into."""
    texts = ["x" * 400_000 + " a@b.cc", "1" * 400_000, "1.2." * 100_000, "+" + "1 " * 200_000, "a@" + "b." * 200_000 + "c", "4 " * 200_000]
    found = pii.find_personal_data(frame(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [tuple(row)[1:5] for row in found] == [(1, 0, 0, 0), (0, 0, 0, 0), (0, 50_000, 0, 0), (0, 0, 0, 0), (1, 0, 0, 0), (0, 0, 0, 0)]


def test_empty_table(spark):
    assert pii.find_personal_data(frame(spark, [])).collect() == []
    assert pii.sanitise(frame(spark, [])).collect() == []


def test_overlapping_kinds(spark):
    """Every base span of the original text goes, also where another kind is found in it."""
    texts = {
        "call +33.1.23.45.67.89 now": "call [PHONE] now",
        "😀 +33 1 23 45 67 89a@b.cc, 1.2.3.4": "😀 [PHONE], [IP]",
        "x@y.zz +33.1.23.45.67.89 and 4111 1111 1111 1111": "[EMAIL] [PHONE] and [CARD]",
        "1.2.3.4": "[IP]",
    }
    found = pii.sanitise(frame(spark, list(enumerate(texts)))).orderBy("doc_id").collect()
    assert [row["text"] for row in found] == list(texts.values())
