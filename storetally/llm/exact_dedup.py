"""Exact deduplication by an exchange of Golomb-coded fingerprints.

Texts are equal if they are the same bytes once every run of white space (space,
0x09 to 0x0D) is one space; NULL counts as empty.

1. *Blocks.* Each task reads its texts in blocks of bounded size, merges the equal ones of a
   block byte for byte and keeps what is left as a table bucketed by block, in the order
   of the texts' digests. A text that half of all rows hold is there once a block.
2. *Messages.* Senders (the blocks of one task) cut the digests to fingerprints of a few bits
   more than the texts' number has, and send each owner of a range of
   fingerprints the ones in its range: sorted, as Golomb-Rice codes of their gaps.
3. *Bitmaps.* An owner decodes all messages of its range and answers each with a bitmap of
   the fingerprints that it has met more than once.
4. *Suspects.* The bitmaps are joined to the blocks where these lie (the table's
   buckets are not shuffled). Only marked texts are shuffled, and grouped by their
   bytes: fingerprints that are equal by chance part here. One row a group and task leaves
   the map side.
5. The members' numbers, not their texts, are shuffled to give every row its group.

Fingerprints and bitmaps stay on the executors; the driver sees counts only.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from storetally.llm.texts import fresh, shared_table, table
from storetally.session import remove_folder, run_folder

# A block ends with the text that reaches one of these.
BLOCK_BYTES = 1 << 26
BLOCK_ROWS = 1 << 17
# Fingerprints of a sender, and of an owner on average, at most.
SENDER_PRINTS = 1 << 20
OWNER_PRINTS = 1 << 20
LEAST_OWNER_BITS = 3
# Bits of a fingerprint beyond those that number the texts: one text in 2**SPARE is suspected wrongly.
SPARE = 8
MOST_BUCKETS = 100_000

_BATCH_BYTES = 1 << 23
_SPACES = b" \t\n\x0b\x0c\r"
_TEXTS = "block bigint, place int, ids array<bigint>, digest binary, text string, prints binary"
_SENDERS = "sender bigint, blocks binary, of binary, prints binary"
_MESSAGES = "owner bigint, sender bigint, start bigint, n bigint, k int, payload binary"
_REPLIES = "sender bigint, start bigint, n bigint, bitmap binary"
_MARKS = "block bigint, marks array<bigint>"


def normal(text: bytes) -> bytes:
    """`text` with each run of white space as one space."""
    found = b" ".join(text.split())
    if text[:1] in _SPACES and text:
        found = b" " + found
    if found.strip() and text[-1:] in _SPACES:
        found += b" "
    return found


def _block(number: int, groups: dict[bytes, list]) -> Iterator[pa.RecordBatch]:
    """The distinct texts of a block in the order of their digests; the first row holds all of their first 8 bytes."""
    texts = sorted((hashlib.sha256(text).digest(), text) for text in groups)
    prints = b"".join(digest[7::-1] for digest, _ in texts)
    schema = pa.schema(
        [
            ("block", pa.int64()),
            ("place", pa.int32()),
            ("ids", pa.list_(pa.int64())),
            ("digest", pa.binary()),
            ("text", pa.string()),
            ("prints", pa.binary()),
        ]
    )
    begin = held = 0
    for place, (_, text) in enumerate(texts):
        held += len(text) + 64
        if held >= _BATCH_BYTES or place + 1 == len(texts):
            some = texts[begin : place + 1]
            columns = [
                [number] * len(some),
                range(begin, place + 1),
                [sorted(groups[text], key=lambda one: (one is None, one or 0)) for _, text in some],
                [digest for digest, _ in some],
                pa.array([text for _, text in some], pa.binary()).cast(pa.string()),
                [None if i or begin else prints for i in range(len(some))],
            ]
            yield pa.RecordBatch.from_arrays(
                [one if isinstance(one, pa.Array) else pa.array(one, kind.type) for one, kind in zip(columns, schema)],
                schema=schema,
            )
            begin, held = place + 1, 0


def _blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks of (id, text) rows."""
    number = TaskContext.get().partitionId() << 32
    groups: dict[bytes, list] = {}
    rows = held = 0
    for batch in batches:
        texts = batch.column(1).cast(pa.large_binary())
        for one, text in zip(batch.column(0).to_pylist(), texts):
            text = normal(text.as_py())
            own = groups.get(text)
            if own is None:
                groups[text] = [one]
                held += len(text)
            else:
                own.append(one)
            rows += 1
            if held >= BLOCK_BYTES or rows >= BLOCK_ROWS:
                yield from _block(number, groups)
                number, groups, rows, held = number + 1, {}, 0, 0
    if groups:
        yield from _block(number, groups)


def _senders(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Blocks (block, prints) merged to senders: sorted fingerprints, each with the index of its block."""

    def merged(blocks: list[int], prints: list[np.ndarray]) -> pa.RecordBatch:
        of = np.repeat(np.arange(len(blocks), dtype=np.uint32), [len(one) for one in prints])
        values = np.concatenate(prints)
        order = np.argsort(values, kind="stable")
        columns = [[blocks[0]], [np.array(blocks).tobytes()], [of[order].tobytes()], [values[order].tobytes()]]
        kinds = [pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        return pa.RecordBatch.from_arrays(
            [pa.array(one, kind) for one, kind in zip(columns, kinds)], ["sender", "blocks", "of", "prints"]
        )

    blocks: list[int] = []
    prints: list[np.ndarray] = []
    held = 0
    for batch in batches:
        for block, own in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            values = np.frombuffer(own, dtype="<u8")
            if blocks and held + len(values) > SENDER_PRINTS:
                yield merged(blocks, prints)
                blocks, prints, held = [], [], 0
            blocks.append(block)
            prints.append(values)
            held += len(values)
    if blocks:
        yield merged(blocks, prints)


def rice_parameter(span: int, count: int) -> int:
    """The bits of a gap that are written as they are: about log2 of the mean gap times ln 2."""
    return max(0, (int(span * 0.69) // max(1, count)).bit_length() - 1)


def encode(gaps: np.ndarray, k: int) -> bytes:
    """Golomb-Rice codes of `gaps`: all quotients by 2**k in unary, then all remainders in k bits."""
    quotients = (gaps >> np.uint64(k)).astype(np.int64)
    ends = np.cumsum(quotients + 1)
    unary = np.ones(int(ends[-1]) if len(ends) else 0, dtype=np.uint8)
    unary[ends - 1] = 0
    bits = np.empty((len(gaps), k), dtype=np.uint8)
    for place in range(k):
        bits[:, place] = (gaps >> np.uint64(k - 1 - place)) & np.uint64(1)
    first = np.packbits(unary).tobytes()
    return len(first).to_bytes(4, "little") + first + np.packbits(bits).tobytes()


def decode(payload: bytes, count: int, k: int) -> np.ndarray:
    """The gaps that `encode` got."""
    size = int.from_bytes(payload[:4], "little")
    unary = np.unpackbits(np.frombuffer(payload, dtype=np.uint8, count=size, offset=4))
    quotients = np.diff(np.flatnonzero(unary == 0)[:count], prepend=-1) - 1
    gaps = quotients.astype(np.uint64) << np.uint64(k)
    if k:
        bits = np.unpackbits(np.frombuffer(payload, dtype=np.uint8, offset=4 + size))[: count * k].reshape(count, k)
        for place in range(k):
            gaps |= bits[:, place].astype(np.uint64) << np.uint64(k - 1 - place)
    return gaps


def _messages(width: int, owner_bits: int):
    """One message for each owner that a sender has fingerprints for; fingerprints have `width` bits."""
    span = 1 << (width - owner_bits)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for sender, raw in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                prints = np.frombuffer(raw, dtype=np.uint64) >> np.uint64(64 - width)
                owners = prints >> np.uint64(width - owner_bits)
                starts = np.flatnonzero(np.diff(owners, prepend=owners[:1] + np.uint64(1)) != 0)
                rows = []
                for start, stop in zip(starts.tolist(), [*starts[1:].tolist(), len(prints)]):
                    base = owners[start : start + 1] << np.uint64(width - owner_bits)
                    k = rice_parameter(span, stop - start)
                    gaps = np.diff(prints[start:stop], prepend=base)
                    rows.append((int(owners[start]), sender, start, stop - start, k, encode(gaps, k)))
                kinds = [pa.int64()] * 4 + [pa.int32(), pa.binary()]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(column, kind) for column, kind in zip(zip(*rows), kinds)],
                    ["owner", "sender", "start", "n", "k", "payload"],
                )

    return run


def _replies(messages: pa.Table) -> pa.Table:
    """Of one owner's messages, those that hold a fingerprint met more than once, with a bitmap of these."""
    rows = messages.select(["sender", "start", "n", "k", "payload"]).to_pylist()
    prints = [np.cumsum(decode(row["payload"], row["n"], row["k"]), dtype=np.uint64) for row in rows]
    values = np.concatenate(prints)
    order = np.argsort(values, kind="stable")
    same = values[order[1:]] == values[order[:-1]]
    met = np.zeros(len(values), dtype=bool)
    met[order[1:][same]] = True
    met[order[:-1][same]] = True
    stops = np.cumsum([len(one) for one in prints])
    marks = [met[stop - len(one) : stop] for one, stop in zip(prints, stops)]
    found = [(row, own) for row, own in zip(rows, marks) if own.any()]
    return pa.Table.from_arrays(
        [
            *(pa.array([row[name] for row, _ in found], pa.int64()) for name in ("sender", "start", "n")),
            pa.array([np.packbits(own).tobytes() for _, own in found], pa.binary()),
        ],
        ["sender", "start", "n", "bitmap"],
    )


def _marks(senders: pa.Table, replies: pa.Table) -> pa.Table:
    """The bitmaps that one sender got, cut into one for each of its blocks (64 texts a number)."""
    blocks, marks = [], []
    if senders.num_rows and replies.num_rows:
        own = senders.select(["blocks", "of"]).to_pylist()[0]
        of = np.frombuffer(own["of"], dtype=np.uint32)
        met = np.zeros(len(of), dtype=bool)
        for row in replies.select(["start", "n", "bitmap"]).to_pylist():
            bits = np.unpackbits(np.frombuffer(row["bitmap"], dtype=np.uint8))[: row["n"]]
            met[row["start"] : row["start"] + row["n"]] = bits
        # The order of a block's fingerprints is the order of its places.
        order = np.argsort(of, kind="stable")
        stops = np.cumsum(np.bincount(of))
        for block, bits in zip(np.frombuffer(own["blocks"], dtype=np.int64), np.split(met[order], stops[:-1])):
            if bits.any():
                whole = np.zeros(-(-len(bits) // 64) * 64, dtype=bool)
                whole[: len(bits)] = bits
                blocks.append(int(block))
                marks.append(np.packbits(whole, bitorder="little").view(np.int64))
    return pa.Table.from_arrays([pa.array(blocks, pa.int64()), pa.array(marks, pa.list_(pa.int64()))], ["block", "marks"])


def _suspects(texts: DataFrame) -> DataFrame:
    """The rows of the table of blocks whose fingerprint was met more than once."""
    spark = texts.sparkSession
    heads = texts.filter("prints IS NOT NULL").select("block", "prints")
    count = heads.agg(F.sum(F.length("prints") / 8)).first()[0]
    count = int(count or 0)
    tasks = max(-(-count // SENDER_PRINTS), int(spark.conf.get("spark.sql.shuffle.partitions")))
    senders = shared_table(heads.coalesce(tasks).mapInArrow(_senders, _SENDERS), "dedup-senders")
    owner_bits = max(LEAST_OWNER_BITS, (count // OWNER_PRINTS).bit_length())
    width = min(64, max(count.bit_length() + SPARE, owner_bits))
    messages = senders.select("sender", "prints").mapInArrow(_messages(width, owner_bits), _MESSAGES)
    replies = messages.groupBy("owner").applyInArrow(_replies, _REPLIES)
    marks = (
        senders.select("sender", "blocks", "of")
        .groupBy("sender")
        .cogroup(replies.groupBy("sender"))
        .applyInArrow(_marks, _MARKS)
    )
    marked = F.expr("shiftright(marks[cast(place div 64 AS int)], place % 64) & 1 = 1")
    return texts.drop("prints").join(marks.hint("shuffle_hash"), "block").filter(marked).drop("marks")


def mark_copies(docs: DataFrame, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256), one row for each row of `docs`.

    Of the rows with equal texts the one with the smallest id stays: keep_id is
    its id, kept is true for it alone, group_size counts the rows. A NULL text is empty, and empty
    texts are copies of each other. NULL ids come after all others; if a group has no other,
    keep_id is NULL and one row stays. Of rows with one id and equal texts one stays. White space
    alone is one space, not empty. An empty table gives no rows. Other columns are ignored.

    The table of blocks takes about the room of `docs` in the shared folder and is removed on return.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(ids).cast("bigint").alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    path, name = run_folder(spark, "dedup-texts"), f"dedup_texts_{uuid.uuid4().hex}"
    buckets = min(MOST_BUCKETS, max(1, rows.rdd.getNumPartitions()))
    rows.mapInArrow(_blocks, _TEXTS).write.bucketBy(buckets, "block").option("path", path).format("parquet").saveAsTable(name)
    try:
        texts = spark.table(name)
        first = F.struct(F.col("ids")[0].isNull().alias("none"), F.col("ids")[0].alias("id"), "block", "place")
        groups = (
            _suspects(texts)
            .groupBy("digest", "text")
            .agg(
                F.min(first).alias("first"),
                F.sum(F.size("ids")).alias("n"),
                F.collect_list(F.struct("block", "place")).alias("members"),
            )
            .filter(F.size("members") > 1)
        )
        members = groups.select("first", "n", F.explode("members").alias("member")).select(
            "member.block", "member.place", "first", "n"
        )
        stays = F.col("first").isNull() | (
            (F.col("first.block") == F.col("block")) & (F.col("first.place") == F.col("place"))
        )
        own = texts.select("block", "place", "ids", "digest").join(members, ["block", "place"], "left")
        marked = own.select("*", F.posexplode("ids").alias("nth", "doc_id")).select(
            "doc_id",
            F.when(F.col("first").isNull(), F.col("ids")[0]).otherwise(F.col("first.id")).alias("keep_id"),
            F.coalesce("n", F.size("ids")).cast("bigint").alias("group_size"),
            (stays & (F.col("nth") == 0)).alias("kept"),
            F.lower(F.hex("digest")).alias("text_sha256"),
        )
        return shared_table(marked, "dedup-marked")
    finally:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        remove_folder(spark, path)


def drop_copies(docs: DataFrame, ids: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of `docs` that stay, with the same columns; NULLs, ties and empty texts as in `mark_copies`.

    Of repeated rows of one id and equal texts any one stays, with its own other columns.
    """
    mark = fresh(docs, "text_sha256")
    spaced = F.regexp_replace(F.coalesce(F.col(text), F.lit("")), "[\\x20\\x09-\\x0D]+", " ")
    keyed = docs.withColumn(mark, F.sha2(F.encode(spaced, "UTF-8"), 256))
    stay = mark_copies(docs, ids, text).filter("kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha"))
    same = keyed[ids].eqNullSafe(stay["_id"]) & (keyed[mark] == stay["_sha"])
    return keyed.join(stay, same, "left_semi").dropDuplicates([ids, mark]).drop(mark)


def op11_exact_dedup(spark, sf_dir: str) -> DataFrame:
    """Every row of `documents` with the row that stays of those with an equal text."""
    return mark_copies(table(spark, sf_dir, "documents"))


ORACLE = r"""
WITH t AS (
  SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS text FROM documents
)
SELECT doc_id, min(doc_id) OVER own AS keep_id, (count(*) OVER own)::BIGINT AS group_size,
       doc_id = min(doc_id) OVER own AS kept, sha256(text) AS text_sha256
FROM t WINDOW own AS (PARTITION BY text)
"""
