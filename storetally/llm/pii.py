"""Personal data: patterns, and terms that reveal the entities found by them.

Base spans are matches of four patterns (email, ip, card, phone) that pass their
checks. On top of them, corpus co-occurrence tells how strongly a term reveals
an entity. All shares are shares of documents (rows): p(t) of those that hold term t, p(e) of
those that hold entity e, p(t, e) of those that hold t near e, that is within `NEAR` characters before
or after it, across line breaks and other matches. Then

    disclosure(t, e) = PMI(t; e) / IC(e) = log(p(t, e) / (p(t) p(e))) / -log p(e)

is 1 when the term occurs only near the entity and falls as it occurs elsewhere, however
often documents are copied. A term needs `LEAST_DOCUMENTS` documents with the entity near it.
In the documents that hold the entity,
terms of disclosure `GENERALISE` or more are replaced by a placeholder, those of
`REMOVE` or more are taken out; both count as spans of kind term.

Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from storetally.llm.texts import fresh, shared_checkpoint, table

KINDS = ("email", "ip", "card", "phone")
LEAST_DOCUMENTS = 3
NEAR = 120
# Matches of one kind, with the text before them, that fill what is near: each has two characters at least.
REACH = NEAR // 2 + 1
GENERALISE = 0.9
REMOVE = 0.99
# Documents with terms to replace are joined by broadcast up to so many rows.
BROADCAST_ROWS = 20_000

# A match starts at the first character of a run, or where the last match ended;
# possessive repeats need neither backtracking nor a stack, however long a text is.
_PATTERNS = {
    "email": r"(?:\G|(?<![A-Za-z0-9._%+-]))[A-Za-z0-9._%+-]++@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++",
    "ip": r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++",
    "card": r"[0-9](?:[\x20-]?[0-9])++",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}
_TERM = r"\p{L}{3,}"


def _digits(match: Column) -> Column:
    return F.regexp_replace(match, "[^0-9]", "")


def _luhn(digits: Column) -> Column:
    """Whether the digits pass the Luhn check; every second one from the right is doubled."""
    backwards = F.split(F.reverse(digits), "")

    def add(total: Column, place: Column) -> Column:
        digit = F.ascii(F.element_at(backwards, place)) - 48
        twice = digit * 2
        return total + F.when(place % 2 == 1, digit).otherwise(F.when(twice > 9, twice - 9).otherwise(twice))

    return F.aggregate(F.sequence(F.lit(1), F.length(digits)), F.lit(0), add) % 10 == 0


def _valid(kind: str, match: Column) -> Column:
    if kind == "email":
        return F.lit(True)
    if kind == "ip":
        parts = F.split(match, r"\.")
        trimmed = F.transform(parts, lambda part: F.regexp_replace(part, "^0+", ""))
        return F.forall(trimmed, lambda part: (F.length(part) <= 3) & (F.lpad(part, 3, "0") <= "255"))
    digits = _digits(match)
    if kind == "card":
        return F.length(digits).between(16, 19) & F.when(F.length(digits).between(16, 19), _luhn(digits)).otherwise(False)
    return F.length(digits).between(8, 15)


def _guard(kind: str, text: Column) -> Column:
    """Cheap and true wherever the kind can match."""
    return text.contains({"email": "@", "ip": ".", "phone": "+"}[kind]) if kind != "card" else text.rlike("[0-9]")


def _pieces(text: Column, pattern: str) -> Column:
    """Array of (gap, match): the text before each match, and at the end the rest with a NULL match."""
    return F.arrays_zip(
        F.split(text, pattern, -1).alias("gap"), F.regexp_extract_all(text, F.lit(pattern), F.lit(0)).alias("match")
    )


def _entity(kind: Column, match: Column) -> Column:
    """The entity a match names: letters of an email without case, card and phone by their digits."""
    return F.concat_ws(
        ":",
        kind,
        F.when(kind == "email", F.lower(match)).when(kind == "ip", match).otherwise(_digits(match)),
    )


def _text_key(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def _numbered(text: Column, number: int, kind: str) -> Column:
    return F.transform(
        _pieces(text, _PATTERNS[kind]),
        lambda piece, place: F.struct(
            F.lit(number).alias("kind"),
            place.alias("number"),
            F.length(piece["gap"]).alias("gap"),
            F.length(piece["match"]).alias("length"),
            piece["match"].alias("match"),
        ),
    )


def _matches(docs: DataFrame) -> DataFrame:
    """(doc_id, key, kind, number, gap, length, match) of all pattern matches of distinct (doc_id, text), valid or not."""
    text = F.coalesce("text", F.lit(""))
    nothing = F.array().cast("array<struct<kind:int,number:int,gap:int,length:int,match:string>>")
    found = []
    for number, kind in enumerate(KINDS):
        found.append(F.when(_guard(kind, text), _numbered(text, number, kind)).otherwise(nothing))
    return (
        docs.select("doc_id", _text_key(F.col("text")).alias("key"), F.explode(F.concat(*found)).alias("m"))
        .select("doc_id", "key", "m.*")
        .filter("match IS NOT NULL")
        .dropDuplicates(["doc_id", "key", "kind", "number"])
    )


def base_spans(docs: DataFrame) -> DataFrame:
    """(doc_id, key, kind, start, stop, entity) of the valid matches; offsets count code points, stop is exclusive.

    `docs` has doc_id and text; key tells texts of the same doc_id apart.
    """
    before = Window.partitionBy("doc_id", "key", "kind").orderBy("number")
    valid = F.lit(False)
    for number, kind in enumerate(KINDS):
        valid = F.when(F.col("kind") == number, _valid(kind, F.col("match"))).otherwise(valid)
    names = F.element_at(F.array(*map(F.lit, KINDS)), F.col("kind") + 1)
    return (
        _matches(docs)
        .withColumn("stop", F.sum(F.col("gap") + F.col("length")).over(before))
        .filter(valid)
        .select(
            "doc_id",
            "key",
            "kind",
            (F.col("stop") - F.col("length")).alias("start"),
            "stop",
            _entity(names, F.col("match")).alias("entity"),
        )
    )


def _terms(text: Column) -> Column:
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(_TERM), F.lit(0)))


def _placed(text: Column, kind: str) -> Column:
    """Array of (gap, match, after, place): the matches of one kind, valid or not, each with the text up to its neighbours.

    The last has no match.
    """
    gaps = F.split(text, _PATTERNS[kind], -1)
    matches = F.regexp_extract_all(text, F.lit(_PATTERNS[kind]), F.lit(0))
    pieces = F.arrays_zip(gaps.alias("gap"), matches.alias("match"), F.slice(gaps, 2, 1 << 30).alias("after"))
    numbered = F.transform(
        pieces,
        lambda piece, place: F.struct(piece["gap"].alias("gap"), piece["match"].alias("match"), piece["after"].alias("after"), place.alias("place")),
    )
    return F.when(_guard(kind, text), numbered).otherwise(
        F.array().cast("array<struct<gap:string,match:string,after:string,place:int>>")
    )


def _near(pieces: Column, kind: str) -> Column:
    """Array of (entity, words): the valid ones of `pieces` (a column, see `_placed`), each with the words near it.

    What is near may hold other matches. A word that reaches across its border is left out.
    """

    def around(piece: Column) -> Column:
        # Neighbours enough to fill what is near, each cut to the part that can be in it.
        first = F.greatest(piece["place"] - REACH, F.lit(0))
        left = F.transform(
            F.slice(pieces, first + 1, piece["place"] - first), lambda one: F.right(F.concat(one["gap"], one["match"]), F.lit(NEAR + 1))
        )
        right = F.transform(
            F.slice(pieces, piece["place"] + 2, F.lit(REACH)), lambda one: F.left(F.concat(one["match"], one["after"]), F.lit(NEAR + 1))
        )
        before = F.concat(F.array_join(left, ""), F.right(piece["gap"], F.lit(NEAR + 1)))
        after = F.concat(F.left(piece["after"], F.lit(NEAR + 1)), F.array_join(right, ""))
        before = F.when(F.length(before) > NEAR, F.regexp_replace(F.right(before, F.lit(NEAR)), r"^\p{L}+", "")).otherwise(before)
        after = F.when(F.length(after) > NEAR, F.regexp_replace(F.left(after, F.lit(NEAR)), r"\p{L}+$", "")).otherwise(after)
        return F.struct(
            _entity(F.lit(kind), piece["match"]).alias("entity"),
            _terms(F.concat_ws(" ", before, after)).alias("terms"),
        )

    valid = F.filter(pieces, lambda piece: piece["match"].isNotNull() & _valid(kind, piece["match"]))
    return F.transform(valid, around)


def disclosing_terms(docs: DataFrame) -> DataFrame:
    """(entity, term, disclosure) of the terms that reveal an entity, of all texts of `docs`."""
    placed = docs.filter(F.col("text").rlike("[0-9@]")).select(*(_placed(F.col("text"), kind).alias(kind) for kind in KINDS))
    found = placed.select(F.concat(*(_near(F.col(kind), kind) for kind in KINDS)).alias("found"))
    # Filtered when kept: Spark would push the filter below and take the matches again for each of them.
    found = shared_checkpoint(found).filter(F.size("found") > 0)
    entities = (
        found.select(F.explode(F.array_distinct(F.transform("found", lambda one: one["entity"]))).alias("entity"))
        .groupBy("entity")
        .agg(F.count("*").alias("n_entity"))
        .filter(F.col("n_entity") >= LEAST_DOCUMENTS)
    )
    pairs = F.flatten(
        F.transform(
            "found",
            lambda one: F.transform(one["terms"], lambda term: F.struct(one["entity"].alias("entity"), term.alias("term"))),
        )
    )
    together = (
        found.select(F.explode(F.array_distinct(pairs)).alias("pair"))
        .groupBy("pair.entity", "pair.term")
        .agg(F.count("*").alias("n_both"))
        .filter(F.col("n_both") >= LEAST_DOCUMENTS)
        .join(entities, "entity")
    )
    documents = docs.select(F.explode(_terms(F.col("text"))).alias("term")).groupBy("term").agg(F.count("*").alias("n_term"))
    total = docs.count()
    ic = F.log(F.lit(total) / F.col("n_entity"))
    disclosure = (ic - F.log(F.col("n_term") / F.col("n_both"))) / ic
    return (
        shared_checkpoint(together)
        .join(documents, "term")
        .filter(F.col("n_entity") < total)
        .select("entity", "term", disclosure.alias("disclosure"))
        .filter(F.col("disclosure") >= GENERALISE)
    )


def _terms_by_text(spans: DataFrame, terms: DataFrame) -> DataFrame:
    """(term_id, term_key, terms): by document and text, the terms to replace with what replaces them."""
    by_text = (
        spans.join(terms, "entity")
        .groupBy("doc_id", "key", "term")
        .agg(F.max("disclosure").alias("disclosure"))
        .select(
            F.col("doc_id").alias("term_id"),
            F.col("key").alias("term_key"),
            F.struct(
                F.col("term").alias("key"),
                F.when(F.col("disclosure") >= REMOVE, "").otherwise("[TERM]").alias("value"),
            ).alias("term"),
        )
        .groupBy("term_id", "term_key")
        .agg(F.sort_array(F.collect_set("term")).alias("terms"))  # bounded by the words of one text
    )
    kept = shared_checkpoint(by_text)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def _same_text(docs: DataFrame, text: str) -> Column:
    return docs["doc_id"].eqNullSafe(F.col("term_id")) & (_text_key(docs[text]) == F.col("term_key"))


def term_spans(docs: DataFrame, by_text: DataFrame) -> DataFrame:
    """(doc_id, key, kind, start, stop) of the terms to replace."""
    pieces = (
        docs.join(by_text, _same_text(docs, "text"))
        .select("doc_id", F.col("term_key").alias("key"), "terms", F.posexplode(_pieces(F.col("text"), _TERM)).alias("number", "piece"))
        .select(
            "doc_id",
            "key",
            "number",
            F.length("piece.gap").alias("gap"),
            F.length("piece.match").alias("length"),
            F.exists("terms", lambda term: term["key"] == F.lower(F.col("piece.match"))).alias("hit"),
        )
        .filter("length IS NOT NULL")
        .dropDuplicates(["doc_id", "key", "number"])
    )
    before = Window.partitionBy("doc_id", "key").orderBy("number")
    return (
        pieces.withColumn("stop", F.sum(F.col("gap") + F.col("length")).over(before))
        .filter("hit")
        .select("doc_id", "key", F.lit(len(KINDS)).alias("kind"), (F.col("stop") - F.col("length")).alias("start"), "stop")
    )


def find_personal_data(docs: DataFrame, text: str = "text") -> DataFrame:
    """Per row of `docs`: doc_id, n_email, n_ip, n_card, n_phone, base_sha256, spans, n_term.

    Spans are `kind:start:stop`, by kind (email, ip, card, phone, term), then
    start, joined by commas; base_sha256 hashes those without terms. A NULL text
    is empty; empty texts have no spans. Repeated rows give repeated rows. Rows
    that share a doc_id are told apart by their texts; a NULL doc_id is a value
    like any other. Repeated rows count as often as they are there. An empty table gives
    no rows. Other columns are ignored.
    """
    source = docs.select("doc_id", F.col(text).alias("text"))
    spans = shared_checkpoint(base_spans(source))
    by_text = _terms_by_text(spans, disclosing_terms(source))
    every = spans.drop("entity").union(term_spans(source, by_text))
    names = F.array(*map(F.lit, [*KINDS, "term"]))

    def written(span: Column) -> Column:
        return F.concat_ws(":", F.element_at(names, span["kind"] + 1), span["start"], span["stop"])

    grouped = every.groupBy(F.col("doc_id").alias("span_id"), F.col("key").alias("span_key")).agg(
        F.sort_array(F.collect_list(F.struct("kind", "start", "stop"))).alias("found")
    )
    rows = source.select("doc_id", _text_key(F.col("text")).alias("key")).join(
        grouped, F.col("doc_id").eqNullSafe(F.col("span_id")) & (F.col("key") == F.col("span_key")), "left"
    )
    nothing = F.array().cast("array<struct<kind:int,start:bigint,stop:bigint>>")
    rows = rows.select("doc_id", F.coalesce("found", nothing).alias("found"))

    def count(kind: int) -> Column:
        return F.size(F.filter("found", lambda span: span["kind"] == kind)).cast("bigint")

    base = F.filter("found", lambda span: span["kind"] < len(KINDS))
    return rows.select(
        "doc_id",
        *(count(number).alias(f"n_{kind}") for number, kind in enumerate(KINDS)),
        F.sha2(F.array_join(F.transform(base, written), ","), 256).alias("base_sha256"),
        F.array_join(F.transform("found", written), ",").alias("spans"),
        count(len(KINDS)).alias("n_term"),
    )


def _base_masks(spans: DataFrame) -> DataFrame:
    """(mask_id, mask_key, masks): the base spans of texts with several kinds, overlapping ones merged, by place.

    With one kind, replacing its matches replaces its spans; with several, a
    match replaced first may break one that overlaps it. A merged span is named
    by the kind of its first.
    """
    text = Window.partitionBy("doc_id", "key")
    before = text.orderBy("start", F.desc("stop"), "kind")
    several = spans.withColumn("least", F.min("kind").over(text)).withColumn("most", F.max("kind").over(text))
    apart = F.col("start") >= F.coalesce(F.max("stop").over(before.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    merged = (
        several.filter("least < most")
        .withColumn("apart", apart.cast("int"))
        .withColumn("number", F.sum("apart").over(before.rowsBetween(Window.unboundedPreceding, 0)))
        .groupBy("doc_id", "key", "number")
        .agg(F.min("start").alias("start"), F.max("stop").alias("stop"), F.max(F.when(F.col("apart") == 1, F.col("kind"))).alias("kind"))
    )
    masks = merged.groupBy(F.col("doc_id").alias("mask_id"), F.col("key").alias("mask_key")).agg(
        F.sort_array(F.collect_list(F.struct("start", "stop", "kind"))).alias("masks")  # bounded by one text
    )
    kept = shared_checkpoint(masks)
    return F.broadcast(kept) if kept.count() <= BROADCAST_ROWS else kept


def _masked(text: Column, masks: Column) -> Column:
    """The text with the spans of `masks` replaced by their kinds."""
    names = F.array(*(F.lit(f"[{kind.upper()}]") for kind in KINDS))
    last = F.element_at(masks, -1)["stop"]

    def piece(mask: Column, place: Column) -> Column:
        stop = F.when(place == 0, 0).otherwise(F.get(masks, place - 1)["stop"])
        return F.concat(
            F.substring(text, (stop + 1).cast("int"), (mask["start"] - stop).cast("int")),
            F.element_at(names, mask["kind"] + 1),
        )

    rest = F.substring(text, (last + 1).cast("int"), F.length(text))
    return F.when(masks.isNull(), text).otherwise(F.concat(F.array_join(F.transform(masks, piece), ""), rest))


def _without(text: Column, kind: str) -> Column:
    masked = F.transform(
        _pieces(text, _PATTERNS[kind]),
        lambda piece: F.concat(
            piece["gap"],
            F.when(piece["match"].isNull(), "")
            .when(_valid(kind, piece["match"]), f"[{kind.upper()}]")
            .otherwise(piece["match"]),
        ),
    )
    return F.when(_guard(kind, text), F.array_join(masked, "")).otherwise(text)


def sanitise(docs: DataFrame, text: str = "text") -> DataFrame:
    """`docs` with personal data replaced by its kind and disclosing terms replaced or taken out.

    All base spans of a text are replaced, overlapping ones as one; then what the
    patterns find in the text that is left, one kind after the other. Every row stays, with the same columns; n_chars, if there, follows the new
    text. NULL and empty texts stay as they are. Repeated rows stay repeated and count as often
    as they are there; an empty table stays empty.
    """
    source = docs.select("doc_id", F.col(text).alias("text"))
    spans = shared_checkpoint(base_spans(source))
    by_text = _terms_by_text(spans.select("doc_id", "key", "entity").distinct(), disclosing_terms(source))
    terms = fresh(docs, "terms_to_replace")
    # Names of the join that no column of docs has.
    by_text = by_text.select(
        F.col("term_id").alias(fresh(docs, "term_id")), F.col("term_key").alias(fresh(docs, "term_key")), F.col("terms").alias(terms)
    )
    same = docs["doc_id"].eqNullSafe(by_text[fresh(docs, "term_id")]) & (
        _text_key(docs[text]) == by_text[fresh(docs, "term_key")]
    )
    masks = fresh(docs, "masks")
    by_place = _base_masks(spans).select(
        F.col("mask_id").alias(fresh(docs, "mask_id")), F.col("mask_key").alias(fresh(docs, "mask_key")), F.col("masks").alias(masks)
    )
    placed = docs["doc_id"].eqNullSafe(by_place[fresh(docs, "mask_id")]) & (
        _text_key(docs[text]) == by_place[fresh(docs, "mask_key")]
    )
    joined = (
        docs.join(by_text, same, "left")
        .join(by_place, placed, "left")
        .select(*(docs[name] for name in docs.columns), by_text[terms], by_place[masks])
        .withColumn(text, _masked(F.col(text), F.col(masks)))
    )
    for kind in ("email", "card", "ip", "phone"):
        joined = joined.withColumn(text, _without(F.col(text), kind))
    pieces = F.transform(
        _pieces(F.col(text), _TERM),
        lambda piece: F.concat(
            piece["gap"],
            F.when(piece["match"].isNull(), "").otherwise(
                F.coalesce(F.element_at(F.map_from_entries(terms), F.lower(piece["match"])), piece["match"])
            ),
        ),
    )
    joined = joined.withColumn(text, F.when(F.col(terms).isNull(), F.col(text)).otherwise(F.array_join(pieces, "")))
    if "n_chars" in docs.columns:
        joined = joined.withColumn("n_chars", F.length(text).cast(docs.schema["n_chars"].dataType))
    return joined.select(*docs.columns)


def op1_pii(spark, sf_dir: str) -> DataFrame:
    """Personal data of all of `documents`."""
    return find_personal_data(table(spark, sf_dir, "documents"))
