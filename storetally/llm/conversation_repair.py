"""Cheapest repair of conversations to an optional system turn and pairs of user and assistant.

Rows are dealt out by conversation and sorted by turn; one pass per task carries the state
of a dynamic program from Arrow batch to Arrow batch. The program has four states, the parts of
`(s?(ua)+)?`: begin, after system, after user, after assistant. What it knows of the rows so far is the
cheapest cost of each state, less the least of them, and the ASCII order of their edits:
so few values that a step is one look-up.

A conversation is written in chunks of bounded size. One that fits a chunk is traced back on
the spot. Of a longer one each chunk keeps four bytes a row, where each state's cheapest edits come
from; these go to the shared folder with the texts, a second pass reads them backwards, and a third one
applies the edits. So a task holds a chunk at most, however long the conversation.

Duplicates of earlier turns are found before, by grouping digests: no task holds the
texts that a conversation has had.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from storetally.llm.texts import shared_table, table

# A chunk ends with the row that reaches one of these.
CHUNK_ROWS = 1 << 14
CHUNK_BYTES = 1 << 22

KEEP, REROLE, DELETE, INSERT, CUT = 0, 3, 4, 3, 3
EDITS = "DKR"  # in ASCII order; I stands between D and K
BEGIN, SYSTEM, USER, ASSISTANT = range(4)
_NEXT = ((USER, "user"), (USER, "user"), (ASSISTANT, "assistant"), (USER, "user"))
_KEPT = {(BEGIN, "s"): SYSTEM} | {(state, _NEXT[state][1][0]): _NEXT[state][0] for state in range(4)}
_LEGAL = {"su", "ua", "au"}
_NONE = 255

_FOUND = "gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, cost bigint"
_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_BLANKS = " \t\n\x0b\x0c\r"


def _after(state: int, inserted: int) -> int:
    for _ in range(inserted):
        state = _NEXT[state][0]
    return state


@cache
def _step(costs: tuple, order: tuple, initial: str, must: bool, cut: bool) -> tuple[tuple, tuple, int, bytes]:
    """One row: (costs, order, least cost to add, four pointers) from the costs of the states and their ASCII order.

    Edits that end in a row's own edit are never the beginning of other such edits, so whichever is
    less stays less, whatever follows.
    """
    best: dict[int, tuple] = {}
    for rank, state in enumerate(order):
        for inserted in range(3):
            here = _after(state, inserted)
            before = costs[state] + INSERT * inserted
            moves = [(DELETE, "D", here)]
            if not must:
                if (here, initial) in _KEPT:
                    moves.append((KEEP + CUT * cut, "K", _KEPT[here, initial]))
                moves.append((REROLE + CUT * cut, "R", _NEXT[here][0]))
            for cost, edit, target in moves:
                found = (before + cost, rank, "I" * inserted + edit, state * 9 + inserted * 3 + EDITS.index(edit))
                best[target] = min(found, best.get(target, found))
    least = min(found[0] for found in best.values())
    pointers = bytes(best[state][3] if state in best else _NONE for state in range(4))
    costs = tuple(best[state][0] - least if state in best else None for state in range(4))
    return costs, tuple(sorted(best, key=lambda state: best[state][1:3])), least, pointers


@cache
def _end(costs: tuple, order: tuple) -> tuple[int, int, int]:
    """(cost to add, state, inserts) of the cheapest end."""
    ends = []
    for rank, state in enumerate(order):
        for inserted in range(3):
            if _after(state, inserted) in (BEGIN, ASSISTANT):
                ends.append((costs[state] + INSERT * inserted, rank, inserted, state))
    cost, _, inserted, state = min(ends)
    return cost, state, inserted


def _traced(pointers: bytes, state: int) -> tuple[bytes, int]:
    """The pointers of the cheapest path that ends in `state`, and the state that it begins in."""
    path = bytearray(len(pointers) // 4)
    for row in range(len(path) - 1, -1, -1):
        path[row] = pointers[4 * row + state]
        state = path[row] // 9
    return bytes(path), state


class _Conversation:
    """The rows of one conversation so far: counts, state of the program, rows of the open chunk."""

    def __init__(self, key):
        self.key = key
        self.chunk = 0
        self.counts = dict.fromkeys(_COUNTS, 0)
        self.least = self.last = None
        self.turns_met = 0
        self.initial = None
        self.former = None
        self.costs, self.order = (0, None, None, None), (BEGIN,)
        self._open()

    def _open(self):
        self.turns, self.roles, self.texts, self.pointers, self.size = [], [], [], bytearray(), 0

    def add(self, turn, role, text, blank, repeated, cut) -> None:
        if turn is not None:
            self.least = turn if self.least is None else self.least
            self.turns_met += turn != self.last or self.turns_met == 0
            self.last = turn
        same = self.former == (turn, role, text)
        self.former = (turn, role, text)
        duplicate = not blank and (repeated or same)
        cut = not blank and not duplicate and cut
        self.counts["blank"] += blank
        self.counts["duplicate"] += duplicate
        self.counts["truncated"] += cut
        initial = role[:1]
        if self.initial is not None:
            self.counts["illegal"] += self.initial + initial not in _LEGAL
        self.initial = initial
        known = initial if initial in ("s", "u", "a") else ""
        self.costs, self.order, cost, own = _step(self.costs, self.order, known, blank or duplicate, cut)
        self.counts["cost"] += cost
        self.turns.append(turn)
        self.roles.append(role)
        self.texts.append(text)
        self.pointers += own
        self.size += len(text)

    def full(self) -> bool:
        return len(self.turns) >= CHUNK_ROWS or self.size >= CHUNK_BYTES

    def row(self, last: bool) -> tuple:
        """The open chunk as a row; with the last one counts, end and, if it is the only one, the path."""
        rows = (self.turns, self.roles, self.texts)
        if not last:
            found = (self.key, self.chunk, False, *[None] * 6, *rows, bytes(self.pointers), None, None, None)
            self.chunk += 1
            self._open()
            return found
        cost, state, inserted = _end(self.costs, self.order)
        self.counts["cost"] += cost
        if self.least is not None:
            self.counts["gaps"] = self.last - self.least + 1 - self.turns_met
        only = self.chunk == 0
        path = _traced(self.pointers, state)[0] if only else None
        pointers = None if only else bytes(self.pointers)
        return (self.key, self.chunk, True, *self.counts.values(), *rows, pointers, state, inserted, path)


def _chunks(kind: str) -> str:
    return (
        f"conv_id {kind}, chunk int, last boolean, {_FOUND}, turns array<bigint>, roles array<string>, "
        "texts array<string>, pointers binary, state int, inserted int, path binary"
    )


def _arrow(batch_rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*batch_rows))
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, schema)], schema=schema)


def _forward(key_type: pa.DataType):
    kinds = [("conv_id", key_type), ("chunk", pa.int32()), ("last", pa.bool_())]
    kinds += [(name, pa.int64()) for name in _COUNTS]
    kinds += [("turns", pa.list_(pa.int64())), ("roles", pa.list_(pa.string())), ("texts", pa.list_(pa.string()))]
    kinds += [("pointers", pa.binary()), ("state", pa.int32()), ("inserted", pa.int32()), ("path", pa.binary())]
    schema = pa.schema(kinds)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows (conv_id, turn, role, text, present, blank, repeated, cut), sorted by conversation and turn."""
        now = None
        for batch in batches:
            rows, held = [], 0
            for key, turn, role, text, present, *flags in zip(*[column.to_pylist() for column in batch.columns]):
                if now is None or now.key != key:
                    if now is not None:
                        rows.append(now.row(True))
                        held += now.size
                    now = _Conversation(key)
                if present:
                    if now.full():
                        held += now.size
                        rows.append(now.row(False))
                    now.add(turn, role, text, *flags)
                if held >= CHUNK_BYTES:
                    yield _arrow(rows, schema)
                    rows, held = [], 0
            if rows:
                yield _arrow(rows, schema)
        if now is not None:
            yield _arrow([now.row(True)], schema)

    return run


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Paths of the chunks (conv_id, chunk, pointers, last, state) of long conversations, each last chunk first."""
    state = None
    for batch in batches:
        paths = []
        for pointers, last, end in zip(*[column.to_pylist() for column in batch.columns[2:]]):
            path, state = _traced(pointers, end if last else state)
            paths.append(path)
        yield pa.RecordBatch.from_arrays([*batch.columns[:2], pa.array(paths, pa.binary())], ["conv_id", "chunk", "path"])


def _applied(turns, roles, texts, path, inserted) -> Iterator[tuple[str, int | None, str | None, str | None]]:
    """(edit, turn, role, text) of every edit of a chunk; role and text are None for deleted rows."""
    state = BEGIN
    for turn, role, text, code in zip(turns, roles, texts, path):
        state = code // 9
        for _ in range(code // 3 % 3):
            state, name = _NEXT[state]
            yield "I", None, name, ""
        edit = EDITS[code % 3]
        if edit == "D":
            yield edit, turn, None, None
        elif edit == "K":
            yield edit, turn, role, text
            state = _KEPT[state, role[:1]]
        else:
            state, name = _NEXT[state]
            yield edit, turn, name, text
    for _ in range(inserted or 0):
        state, name = _NEXT[state]
        yield "I", None, name, ""


def _results(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row a conversation, of chunks (conv_id, last, counts, turns, roles, texts, path, inserted) in order."""
    audit: list[str] = []
    digest, first = hashlib.sha256(), True
    for batch in batches:
        audits, digests, ends = [], [], []
        columns = [batch.column(name).to_pylist() for name in ("last", "turns", "roles", "texts", "path", "inserted")]
        for place, (last, *rows) in enumerate(zip(*columns)):
            edits = []
            for edit, _, role, text in _applied(*rows):
                edits.append(edit)
                if role is not None:
                    digest.update(f"{'' if first else chr(10)}{role}:{text}".encode())
                    first = False
            audit.append("".join(edits))
            if last:
                audits.append("".join(audit))
                digests.append(digest.hexdigest())
                ends.append(place)
                audit, digest, first = [], hashlib.sha256(), True
        names = ["conv_id", *_COUNTS]
        kept = [batch.column(name).take(pa.array(ends, pa.int64())) for name in names]
        yield pa.RecordBatch.from_arrays(
            [*kept, pa.array(audits, pa.string()), pa.array(digests, pa.string())], [*names, "audit", "repaired_sha256"]
        )


def _rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The repaired rows of chunks (conv_id, chunk, turns, roles, texts, path, inserted)."""
    for batch in batches:
        found, source = [], []
        names = ("chunk", "turns", "roles", "texts", "path", "inserted")
        for place, (chunk, *rows) in enumerate(zip(*[batch.column(name).to_pylist() for name in names])):
            for nth, (edit, turn, role, text) in enumerate(_applied(*rows)):
                if role is not None:
                    source.append(place)
                    found.append(((chunk << 32) + nth, turn, role, text, edit))
        kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string()]
        columns = list(zip(*found)) or [[]] * 5
        yield pa.RecordBatch.from_arrays(
            [batch.column("conv_id").take(pa.array(source, pa.int64())), *(pa.array(c, k) for c, k in zip(columns, kinds))],
            ["conv_id", "place", "turn", "role", "text", "edit"],
        )


def _edited(turns: DataFrame, present: Column | None) -> tuple[DataFrame, DataFrame, str]:
    """Chunks with their paths: of conversations of one chunk, of longer ones, and the type of conv_id."""
    spaced = F.lit(" ")
    rows = turns.select(
        "conv_id",
        F.col("turn").cast("bigint").alias("turn"),
        F.coalesce("role", spaced).alias("role"),
        F.coalesce("text", spaced).alias("text"),
        (F.lit(True) if present is None else F.coalesce(present, F.lit(False))).alias("present"),
    )
    ended = F.rtrim(F.col("text"), F.lit(_BLANKS))
    rows = rows.select(
        "*",
        (ended == "").alias("blank"),
        (~F.right(ended, F.lit(1)).isin(".", "!", "?")).alias("cut"),
        F.sha2(F.encode("text", "UTF-8"), 256).alias("digest"),
        F.struct(F.col("turn").isNotNull().alias("given"), "turn").alias("at"),
    )
    met = (
        rows.filter("present AND NOT blank")
        .groupBy(F.col("conv_id").alias("c"), F.col("role").alias("r"), F.col("digest").alias("d"))
        .agg(F.min("at").alias("first"), F.count("*").alias("n"))
        .filter("n > 1")
    )
    same = rows["conv_id"].eqNullSafe(met["c"]) & (rows["role"] == met["r"]) & (rows["digest"] == met["d"])
    flagged = rows.join(met, same, "left").select(
        "conv_id", "turn", "role", "text", "present", "blank",
        F.coalesce(F.col("at") > F.col("first"), F.lit(False)).alias("repeated"), "cut",
    )
    ordered = flagged.repartition("conv_id").sortWithinPartitions("conv_id", F.asc_nulls_first("turn"), "role", "text")
    kind = turns.schema["conv_id"].dataType
    kept = shared_table(ordered.mapInArrow(_forward(to_arrow_type(kind)), _chunks(kind.simpleString())), "conversation-chunks")
    short = kept.filter("path IS NOT NULL").drop("pointers")
    long = kept.filter("path IS NULL")
    paths = (
        long.select("conv_id", "chunk", "pointers", "last", "state")
        .repartition("conv_id")
        .sortWithinPartitions("conv_id", F.desc("chunk"))
        .mapInArrow(_backward, f"conv_id {kind.simpleString()}, chunk int, path binary")
        .select(F.col("conv_id").alias("c"), F.col("chunk").alias("k"), F.col("path").alias("p"))
    )
    own = long["conv_id"].eqNullSafe(paths["c"]) & (long["chunk"] == paths["k"])
    joined = long.join(paths, own).withColumn("path", F.col("p")).drop("c", "k", "p", "pointers")
    return short, joined.select(*short.columns), kind.simpleString()


def audit(turns: DataFrame, present: Column | None = None) -> DataFrame:
    """(conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256), one row a conversation.

    `turns` has conv_id, turn, role and text. Rows are taken by turn, NULL first, then by
    role and text; equal rows are duplicates from the second on. A NULL role or text is one space (so such a text
    is blank), NULL conv_ids are one conversation, rows where `present` is not true count only as a sign
    that the conversation exists: without other rows it has zeros, no edits and the digest of
    nothing. Texts and conversations may have any length. An empty table gives no rows. Other columns are ignored.
    """
    short, long, kind = _edited(turns, present)
    schema = f"conv_id {kind}, {_FOUND}, audit string, repaired_sha256 string"
    names = ["conv_id", "last", *_COUNTS, "turns", "roles", "texts", "path", "inserted"]
    ordered = long.repartition("conv_id").sortWithinPartitions("conv_id", "chunk")
    return short.select(*names).mapInArrow(_results, schema).union(ordered.select(*names).mapInArrow(_results, schema))


def repair(turns: DataFrame) -> DataFrame:
    """(conv_id, place, turn, role, text, edit): the rows that the cheapest edits leave, NULLs and ties as in `audit`.

    `place` rises within a conversation. `edit` is K for kept rows, R for those with another
    role, I for inserted ones (empty text, no turn).
    """
    short, long, kind = _edited(turns, None)
    names = ["conv_id", "chunk", "turns", "roles", "texts", "path", "inserted"]
    schema = f"conv_id {kind}, place bigint, turn bigint, role string, text string, edit string"
    return short.union(long).select(*names).mapInArrow(_rows, schema)


def damage(conversations: DataFrame) -> DataFrame:
    """Rows with a column `present`, damaged by crc32 of `conv_id:turn` (NULL: one space) modulo 20.

    0 drops the row, 1 empties its text, 2 removes full stops, exclamation and question marks, 3 repeats it, 4
    makes its role user. NULL roles and texts are one space.
    """
    key = F.concat_ws(":", *(F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn")))
    code = F.crc32(F.encode(key, "UTF-8")) % 20
    role, text = F.coalesce("role", F.lit(" ")), F.coalesce("text", F.lit(" "))
    return conversations.select(
        "conv_id",
        "turn",
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.translate(text, ".!?", "")).otherwise(text).alias("text"),
        (code != 0).alias("present"),
        F.explode(F.when(code == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("copy"),
    ).drop("copy")


def op13_conversation_repair(spark, sf_dir: str) -> DataFrame:
    """Every conversation of `conversations` after damage: its faults and its cheapest repair."""
    return audit(damage(table(spark, sf_dir, "conversations")), F.col("present"))
