"""Removal of repeated byte strings with suffix arrays.

Every byte that is covered by a string of `LENGTH` bytes which also starts earlier
(smaller doc_id, or same document and earlier start) is removed.

1. *Anchors.* Of the `GRAM`-byte grams of a window of `LENGTH` bytes, the one with the
   least hash is its anchor, so equal windows have equal anchors wherever they
   are. Neighbouring windows with one anchor form a run of at most
   LENGTH - GRAM + 1 windows; its bytes are its context.
2. *Equal contexts.* Rows of a run (anchor hash, context hash, place) meet by
   anchor. Of equal contexts all but the earliest are removed; repeats inside a
   batch are found before the shuffle, so a passage that many documents share
   sends one row per batch.
3. *Suffix arrays.* Where one anchor has several different contexts, the first of each is
   cut out of its text. The contexts that a task meets are sorted by two stages:
   suffixes smaller than their successors directly, the rest induced by bucket
   scans. Adjacent common prefixes of LENGTH or more show which windows are
   equal; all but the earliest are removed.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from storetally.llm.texts import mix, shared_checkpoint, shared_table, slices, table

LENGTH = 100
GRAM = 24
# Bytes of contexts that one suffix array holds, about.
ARRAY_BYTES = 2_000_000
# An anchor with more different contexts is compared window by window.
HOT_CONTEXTS = 20_000
# Windows are numbered by 24 bits inside a piece of a text.
_PIECE = 1 << 23
_PLACES = np.uint64((1 << 24) - 1)
# UTF-8 has no byte 255, so it ends a context.
_END = 255

_MULTIPLIER = 0x9E3779B97F4A7C15
_SYMBOL = np.random.Generator(np.random.PCG64(5)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def _power(exponent: int) -> np.uint64:
    return np.uint64(pow(_MULTIPLIER, exponent, 2**64))


def _row_powers(base: int, count: int) -> np.ndarray:
    factors = np.full(count, base, dtype=np.uint64)
    factors[:1] = 1
    return np.multiply.accumulate(factors)


def _gram_hashes(symbols: np.ndarray, gram: int) -> np.ndarray:
    """Hash of the `gram` symbols from each place, by doubling."""
    hashes, width, whole, covered = symbols, 1, None, 0
    rest = gram
    while rest:
        if rest & 1:
            if whole is None:
                whole, covered = hashes, width
            else:
                size = len(hashes) - covered
                whole = whole[:size] * _power(width) + hashes[covered : covered + size]
                covered += width
        rest >>= 1
        if rest:
            hashes = hashes[:-width] * _power(width) + hashes[width:]
            width *= 2
    return mix(whole)


def runs(data: np.ndarray, offsets: np.ndarray, length: int = LENGTH, gram: int = GRAM) -> list[np.ndarray]:
    """Arrays (anchor hash, context hash, first window, windows) of the runs of some texts of up to 2^23 bytes in all."""
    size = len(data)
    if size < length:
        return [np.empty(0, dtype=np.uint64)] * 2 + [np.empty(0, dtype=np.int64)] * 2
    symbols = _SYMBOL[data]
    hashes = _gram_hashes(symbols, gram)
    # Least hash first, of equal ones the last.
    keys = (hashes & ~_PLACES) | (_PLACES - np.arange(len(hashes), dtype=np.uint64))
    window, width = length - gram + 1, 1
    while width * 2 <= window:
        keys = np.minimum(keys[:-width], keys[width:])
        width *= 2
    if width < window:
        keys = np.minimum(keys[: len(keys) - (window - width)], keys[window - width :])
    anchors = (_PLACES - (keys & _PLACES)).astype(np.int64)
    # Windows that lie inside one text.
    change = np.zeros(len(anchors) + 1, dtype=np.int64)
    long_enough = np.diff(offsets) >= length
    np.add.at(change, offsets[:-1][long_enough], 1)
    np.add.at(change, offsets[1:][long_enough] - length + 1, -1)
    inside = np.flatnonzero(np.cumsum(change[:-1]) > 0)
    if not len(inside):
        return [np.empty(0, dtype=np.uint64)] * 2 + [np.empty(0, dtype=np.int64)] * 2
    begins = np.ones(len(inside), dtype=bool)
    begins[1:] = (np.diff(anchors[inside]) != 0) | (np.diff(inside) != 1)
    starts = np.flatnonzero(begins)
    first = inside[starts]
    count = np.diff(np.append(starts, len(inside)))
    sums = np.zeros(size + 1, dtype=np.uint64)
    np.cumsum(symbols * _row_powers(_MULTIPLIER, size), out=sums[1:])
    inverse = _row_powers(pow(_MULTIPLIER, -1, 2**64), size)
    context = (sums[first + count - 1 + length] - sums[first]) * inverse[first]
    return [hashes[anchors[first]], mix(context + count.astype(np.uint64)), first, count]


def _pack(start: np.ndarray, key: np.ndarray, count: np.ndarray) -> np.ndarray:
    """One number for a run of windows: first window, 16 bits of the text's hash, number of windows (below 256)."""
    return (start << 24) | (key << 8) | count


def _unpack(place: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    return place >> 24, (place >> 8) & 0xFFFF, place & 0xFF


def _text_key(text: Column) -> Column:
    return F.pmod(F.xxhash64(F.coalesce(text, F.lit(""))), F.lit(1 << 16))


def _doc_order(doc_id: Column) -> Column:
    """doc_id with NULL before all others."""
    return F.coalesce(doc_id, F.lit(-(2**63)))


def _later(anchor: np.ndarray, context: np.ndarray, doc: np.ndarray, start: np.ndarray) -> np.ndarray:
    """Rows, sorted by all four, that come after the first place of an equal context."""
    begins = np.ones(len(anchor), dtype=bool)
    begins[1:] = (anchor[1:] != anchor[:-1]) | (context[1:] != context[:-1])
    first = np.flatnonzero(begins)[np.cumsum(begins) - 1]
    return (doc != doc[first]) | (start != start[first])


def _run_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(meet, anchor, context, doc, place) of all runs; those known to repeat have no anchor and meet anywhere."""
    for batch in batches:
        docs = batch.column(0).to_numpy(zero_copy_only=False)
        text_keys = batch.column(1).to_numpy(zero_copy_only=False)
        found: list[list[np.ndarray]] = []
        held = 0
        for row, data, offsets in slices(batch.column(2)):
            for piece in range(0, max(1, len(data)), _PIECE):
                # Only a single text is longer than a piece; windows that begin in a piece reach into the next.
                if len(data) > _PIECE:
                    part = data[piece : piece + _PIECE + LENGTH - 1]
                    bounds = np.array([0, len(part)], dtype=np.int64)
                else:
                    part, bounds = data, offsets
                anchor, context, first, count = runs(part, bounds)
                of = np.searchsorted(bounds, first, side="right") - 1
                start = first - bounds[of] + piece
                text = row + of
                found.append([anchor, context, docs[text], _pack(start, text_keys[text], count)])
                held += len(first)
            if held > 300_000:
                yield _sent(found)
                found, held = [], 0
        if held:
            yield _sent(found)


def _sent(found: list[list[np.ndarray]]) -> pa.RecordBatch:
    anchor, context, doc, place = (np.concatenate(column) for column in zip(*found))
    order = np.lexsort((place, doc, context, anchor))
    anchor, context, doc, place = anchor[order], context[order], doc[order], place[order]
    known = _later(anchor, context, doc, place >> 24)
    meet = np.where(known, mix(place.view(np.uint64) ^ mix(doc.view(np.uint64))), anchor)
    return pa.RecordBatch.from_arrays(
        [
            pa.array(meet.view(np.int64)),
            pa.array(anchor.view(np.int64), mask=known),
            pa.array(context.view(np.int64)),
            pa.array(doc),
            pa.array(place),
        ],
        ["meet", "anchor", "context", "doc", "place"],
    )


def _found(meets: list[np.ndarray], docs: list[np.ndarray], places: list[np.ndarray]) -> pa.RecordBatch:
    """Rows (anchor, doc, place): runs to remove have no anchor, contexts to compare have one."""
    meet, doc, place = np.concatenate(meets), np.concatenate(docs), np.concatenate(places)
    return pa.RecordBatch.from_arrays(
        [pa.array(meet, mask=meet == 0), pa.array(doc), pa.array(place)], ["anchor", "doc", "place"]
    )


def _met(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Repeats and different contexts of one anchor, of rows sorted by meet, context, doc, place.

    Only the first row of the anchor and of the context in work is kept between
    batches, however many rows an anchor has.
    """
    anchor = context = None
    first = waiting = None
    for batch in batches:
        if not batch.num_rows:
            continue
        meet, contexts, doc, place = (batch.column(k).to_numpy(zero_copy_only=False) for k in (0, 2, 3, 4))
        known = batch.column(1).is_null().to_numpy(zero_copy_only=False)
        new_anchor = np.ones(len(meet), dtype=bool)
        new_anchor[1:] = meet[1:] != meet[:-1]
        new_anchor[0] = anchor is None or meet[0] != anchor
        new_context = new_anchor.copy()
        new_context[1:] |= contexts[1:] != contexts[:-1]
        new_context[0] |= context is None or contexts[0] != context
        starts = np.flatnonzero(new_context)
        group = np.cumsum(new_context)
        first_doc, first_start = doc[starts], place[starts] >> 24
        if not new_context[0]:
            first_doc, first_start = np.append(first[0], first_doc), np.append(first[1], first_start)
            group = group + 1
        later = known | (doc != first_doc[group - 1]) | ((place >> 24) != first_start[group - 1])
        # Different contexts of one anchor: their first rows.
        rows = starts[~known[starts]]
        run = np.cumsum(new_anchor)
        several = np.bincount(run[rows], minlength=run[-1] + 1)
        chosen = rows[several[run[rows]] > 1]
        meets, docs, places = [np.zeros(int(later.sum()), dtype=np.int64)], [doc[later]], [place[later]]
        if not new_anchor[0]:
            # The first run goes on from the last batch.
            here = rows[run[rows] == 0]
            if len(here):
                if waiting is not None:
                    meets.append(np.array([anchor])), docs.append(np.array([waiting[0]])), places.append(np.array([waiting[1]]))
                    waiting = None
                chosen = np.union1d(chosen, here)
        meets.append(meet[chosen])
        docs.append(doc[chosen])
        places.append(place[chosen])
        last = rows[run[rows] == run[-1]]
        if new_anchor.any():
            waiting = (doc[last[0]], place[last[0]]) if len(last) == 1 else None
        anchor, context = meet[-1], contexts[-1]
        first = (first_doc[group[-1] - 1], first_start[group[-1] - 1])
        yield _found(meets, docs, places)


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(anchor, doc, place, bytes) of the contexts listed with each text."""
    for batch in batches:
        bounds = batch.column(2).offsets.to_numpy()
        listed = batch.column(2).flatten()
        anchors, places = (listed.field(name).to_numpy(zero_copy_only=False) for name in ("anchor", "place"))
        text_of = np.repeat(np.arange(batch.num_rows), np.diff(bounds))
        for row, data, offsets in slices(batch.column(1)):
            own = slice(*(bounds[[row, row + len(offsets) - 1]] - bounds[0]))
            start, _, count = _unpack(places[own])
            begin = offsets[text_of[own] - row] + start
            cut = [data[a:b].tobytes() for a, b in zip(begin.tolist(), (begin + count + LENGTH - 1).tolist())]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(anchors[own]),
                    batch.column(0).take(pa.array(text_of[own])),
                    pa.array(places[own]),
                    pa.array(cut, pa.binary()),
                ],
                ["anchor", "doc", "place", "bytes"],
            )


def _words(symbols: np.ndarray) -> np.ndarray:
    """The eight symbols from each place as one number."""
    wide = symbols.astype(np.uint64)
    for step, bits in ((1, 8), (2, 16), (4, 32)):
        wide = (wide[:-step] << np.uint64(bits)) | wide[step:]
    return wide


def suffix_array(symbols: np.ndarray, depth: int = LENGTH) -> np.ndarray:
    """Suffixes in order of their first `depth` bytes or more (two-stage sorting).

    A suffix smaller than its successor is of type B, any other of type A. Type
    B suffixes are sorted directly. In a bucket of one first byte, A comes
    before B; A suffixes are induced by a scan of the sorted suffixes: one with
    a smaller second byte takes the order of its successor in the buckets
    before, one with an equal second byte that in its own bucket.
    """
    size = len(symbols)
    padded = np.concatenate([symbols, np.full(depth + 16, 0, dtype=np.uint8)])
    words = _words(padded)
    after = padded[1 : size + 1]
    differs = symbols != after
    differs[-1] = True
    # Places of a run of equal bytes have the type of the run's last place.
    ends = np.flatnonzero(differs)
    decisive = ends[np.searchsorted(ends, np.arange(size))]
    smaller = symbols[decisive] < after[decisive]
    smaller[decisive == size - 1] = False

    b_places = np.flatnonzero(smaller)
    order = np.argsort(words[b_places], kind="stable")
    b_places = b_places[order]
    keys = words[b_places]
    tied = np.zeros(len(b_places), dtype=bool)
    if len(b_places) > 1:
        same = keys[1:] == keys[:-1]
        tied[1:] |= same
        tied[:-1] |= same
        group = np.concatenate([[0], np.cumsum(~same)])
    for offset in range(8, depth, 8):
        rows = np.flatnonzero(tied)
        if not len(rows):
            break
        more = words[b_places[rows] + offset]
        groups = group[rows]
        order = np.lexsort((more, groups))
        b_places[rows] = b_places[rows[order]]
        more, groups = more[order], groups[order]
        same = (more[1:] == more[:-1]) & (groups[1:] == groups[:-1])
        group[rows] = np.concatenate([[0], np.cumsum(~same)])
        tied[rows] = False
        keep = np.zeros(len(rows), dtype=bool)
        keep[1:] |= same
        keep[:-1] |= same
        tied[rows[keep]] = True

    rank = np.full(size + 1, -1, dtype=np.int64)
    result = np.empty(size, dtype=np.int64)
    heads = symbols[b_places]
    b_bounds = np.searchsorted(heads, np.arange(257))
    a_places = np.flatnonzero(~smaller)
    a_places = a_places[np.argsort(symbols[a_places], kind="stable")]
    a_bounds = np.searchsorted(symbols[a_places], np.arange(257))
    filled = 0
    for byte in np.unique(symbols).tolist():
        own = a_places[a_bounds[byte] : a_bounds[byte + 1]]
        layer = own[(after[own] != byte) | (own == size - 1)]
        layer = layer[np.argsort(rank[layer + 1], kind="stable")]
        while len(layer):
            result[filled : filled + len(layer)] = layer
            filled += len(layer)
            before = layer[layer > 0] - 1
            layer = before[(symbols[before] == byte) & ~smaller[before]]
        direct = b_places[b_bounds[byte] : b_bounds[byte + 1]]
        result[filled : filled + len(direct)] = direct
        filled += len(direct)
        placed = result[filled - len(own) - len(direct) : filled]
        rank[placed] = np.arange(filled - len(placed), filled)
    return result


def common_prefixes(symbols: np.ndarray, places: np.ndarray, most: int = LENGTH) -> np.ndarray:
    """Bytes that each place has in common with the one before it, up to `most`; 0 for the first."""
    words = _words(np.concatenate([symbols, np.full(most + 16, 0, dtype=np.uint8)]))
    found = np.zeros(len(places), dtype=np.int64)
    rows = np.arange(1, len(places))
    for offset in range(0, most, 8):
        if not len(rows):
            break
        apart = words[places[rows] + offset] ^ words[places[rows - 1] + offset]
        ended = rows[apart != 0]
        bits = np.zeros(len(ended), dtype=np.int64)
        rest = apart[apart != 0]
        for step in (32, 16, 8):  # leading equal bytes of the word
            clear = rest >> np.uint64(64 - step) == 0
            bits[clear] += step
            rest = np.where(clear, rest << np.uint64(step), rest)
        found[ended] = offset + bits // 8
        rows = rows[apart == 0]
        found[rows] = offset + 8
    return np.minimum(found, most)


def repeated_windows(contexts: list[bytes], docs: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """(context, window) of all windows that also begin at an earlier place, sorted."""
    sizes = np.array([len(one) for one in contexts], dtype=np.int64)
    symbols = np.frombuffer(bytes([_END]).join(contexts) + bytes([_END]), dtype=np.uint8)
    begins = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    suffixes = suffix_array(symbols)
    of = np.searchsorted(begins, suffixes, side="right") - 1
    window = suffixes - begins[of]
    whole = window <= sizes[of] - LENGTH
    suffixes, of, window = suffixes[whole], of[whole], window[whole]
    equal = common_prefixes(symbols, suffixes) >= LENGTH
    group = np.cumsum(~equal)
    doc, place = docs[of], starts[of] + window
    order = np.lexsort((place, doc, group))
    first = np.ones(len(order), dtype=bool)
    first[1:] = np.diff(group[order]) != 0
    lead = order[np.flatnonzero(first)[np.cumsum(first) - 1]]
    later = order[(doc[order] != doc[lead]) | (place[order] != place[lead])]
    found = np.stack([of[later], window[later]], axis=1)
    return found[np.lexsort((found[:, 1], found[:, 0]))]


def _compared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(doc, place) of the repeated windows of contexts sorted by anchor; all contexts of an anchor share one array."""

    def solve(held: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(held)
        docs, places = rows.column("doc").to_numpy(), rows.column("place").to_numpy()
        start, key, _ = _unpack(places)
        found = repeated_windows(rows.column("bytes").to_pylist(), docs, start)
        of, window = found[:, 0], found[:, 1]
        begins = np.ones(len(of), dtype=bool)
        begins[1:] = (np.diff(of) != 0) | (np.diff(window) != 1)
        heads = np.flatnonzero(begins)
        count = np.diff(np.append(heads, len(of)))
        own = of[heads]
        return pa.RecordBatch.from_arrays(
            [pa.array(docs[own]), pa.array(_pack(start[own] + window[heads], key[own], count))], ["doc", "place"]
        )

    held: list[pa.RecordBatch] = []
    size, last = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        anchors = batch.column(0).to_numpy(zero_copy_only=False)
        ends = np.concatenate([[0], np.cumsum(pc.binary_length(batch.column(3)).to_numpy())])
        starts = np.flatnonzero(anchors[1:] != anchors[:-1]) + 1
        if anchors[0] != last:
            starts = np.concatenate([[0], starts])
        begin = 0
        for cut in starts.tolist():
            if size + ends[cut] - ends[begin] >= ARRAY_BYTES:
                if cut > begin:
                    held.append(batch.slice(begin, cut - begin))
                yield solve(held)
                held, size, begin = [], 0, cut
        held.append(batch.slice(begin))
        size, last = size + int(ends[-1] - ends[begin]), anchors[-1]
    if held:
        yield solve(held)


def _window_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of contexts as runs of one window, known by two hashes."""
    for batch in batches:
        docs, places = (batch.column(k).to_numpy(zero_copy_only=False) for k in (1, 2))
        start, key, count = _unpack(places)
        for begin in range(0, batch.num_rows, 2000):
            rows = slice(begin, begin + 2000)
            data = np.frombuffer(b"".join(batch.column(3).slice(begin, 2000).to_pylist()), dtype=np.uint8)
            heads = np.concatenate([[0], np.cumsum(count[rows] + LENGTH - 1)[:-1]])
            of = np.repeat(np.arange(len(heads)), count[rows])
            window = np.arange(len(of)) - np.repeat(np.cumsum(count[rows]) - count[rows], count[rows])
            first = heads[of] + window
            hashes = []
            for symbols in (_SYMBOL, mix(_SYMBOL) | np.uint64(1)):
                sums = np.zeros(len(data) + 1, dtype=np.uint64)
                np.cumsum(symbols[data] * _row_powers(_MULTIPLIER, len(data)), out=sums[1:])
                inverse = _row_powers(pow(_MULTIPLIER, -1, 2**64), len(data))
                hashes.append(mix((sums[first + LENGTH] - sums[first]) * inverse[first]))
            place = _pack(start[rows][of] + window, key[rows][of], np.ones(len(of), dtype=np.int64))
            yield _sent([[*hashes, docs[rows][of], place]])


def _kept(with_bytes: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows: list[tuple[int, int, int, str]] = []
            kept: list[bytes] = []
            for row, data, offsets in slices(batch.column(1)):
                for text in range(len(offsets) - 1):
                    own = data[offsets[text] : offsets[text + 1]]
                    places = batch.column(2)[row + text]
                    count = spans = 0
                    if places.is_valid:
                        start, _, windows = _unpack(places.values.to_numpy(zero_copy_only=False))
                        change = np.zeros(len(own) + 1, dtype=np.int64)
                        np.add.at(change, start, 1)
                        np.add.at(change, start + windows + LENGTH - 1, -1)
                        out = np.cumsum(change[:-1]) > 0
                        count = int(out.sum())
                        spans = int(out[0]) + int((out[1:] & ~out[:-1]).sum())
                        own = own[~out]
                    rest = own.tobytes()
                    rows.append((int(offsets[text + 1] - offsets[text]), count, spans, hashlib.sha256(rest).hexdigest()))
                    if with_bytes:
                        kept.append(rest)
            columns = list(zip(*rows)) or [[], [], [], []]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.string())
            found = [batch.column(0), *(pa.array(column, kind) for column, kind in zip(columns, types))]
            names = ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"]
            if with_bytes:
                found, names = [*found, pa.array(kept, pa.binary())], [*names, "kept"]
            yield pa.RecordBatch.from_arrays(found, names)

    return run


def _with_places(docs: DataFrame, rows: DataFrame, listed: Column, how: str) -> DataFrame:
    """doc, text and the listed places of each text; one text has no more of them than bytes."""
    lists = rows.withColumn("key", F.expr("(place >> 8) & 65535")).groupBy("doc", "key").agg(F.collect_list(listed).alias("places"))
    lists = lists.select(F.col("doc").alias("list_doc"), F.col("key").alias("list_key"), "places")
    return docs.join(lists, (F.col("doc") == F.col("list_doc")) & (F.col("key") == F.col("list_key")), how)


def _repeats(sent: DataFrame) -> DataFrame:
    """What `_met` finds in rows of runs, dealt out by where they meet."""
    return (
        sent.repartition("meet")
        .sortWithinPartitions("meet", "context", "doc", "place")
        .mapInArrow(_met, "anchor bigint, doc bigint, place bigint")
    )


_RUNS = "meet bigint, anchor bigint, context bigint, doc bigint, place bigint"


def remove_repeats(docs: DataFrame, text: str = "text", with_bytes: bool = True) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept) of every row of `docs`.

    kept has the remaining bytes (left out unless `with_bytes`), n_spans counts
    maximal removed runs. A NULL text is empty; texts below LENGTH bytes lose
    nothing. A NULL doc_id comes before all others. Rows with the same doc_id
    count as one document: a string is repeated only by one that starts earlier,
    so identical rows lose the same bytes. Such rows are told apart by 16 bits
    of a hash of their texts. An empty table gives no rows; other columns are
    ignored. Equal contexts are known by two 64-bit hashes.

    An anchor with more than HOT_CONTEXTS different contexts is not given to one
    task: the windows of its contexts are compared one by one, dealt out by
    their hashes.
    """
    source = docs.select(
        "doc_id",
        _doc_order(F.col("doc_id")).alias("doc"),
        _text_key(F.col(text)).alias("key"),
        F.coalesce(text, F.lit("")).alias("text"),
    )
    sent = source.filter(F.octet_length("text") >= LENGTH).select("doc", "key", "text").mapInArrow(_run_rows, _RUNS)
    found = shared_table(_repeats(sent), "repeats")
    different = found.filter("anchor IS NOT NULL")
    contexts = shared_table(
        _with_places(source, different, F.struct("anchor", "place"), "inner")
        .select("doc", "text", "places")
        .mapInArrow(_contexts, "anchor bigint, doc bigint, place bigint, bytes binary"),
        "contexts",
    )
    repeats = found.filter("anchor IS NULL").select("doc", "place")
    hot = shared_checkpoint(different.groupBy("anchor").count().filter(F.col("count") > HOT_CONTEXTS).select("anchor"))
    if not hot.isEmpty():
        windows = contexts.join(hot, "anchor", "left_semi").mapInArrow(_window_rows, _RUNS)
        repeats = repeats.union(shared_checkpoint(_repeats(windows).select("doc", "place")))
        contexts = contexts.join(hot, "anchor", "left_anti")
    compared = (
        contexts.repartition("anchor")
        .sortWithinPartitions("anchor", "doc", "place")
        .mapInArrow(_compared, "doc bigint, place bigint")
    )
    repeats = repeats.union(shared_checkpoint(compared))
    schema = "doc_id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    return (
        _with_places(source, repeats, F.col("place"), "left")
        .select("doc_id", "text", "places")
        .mapInArrow(_kept(with_bytes), schema + ", kept binary" * with_bytes)
    )


def op5_suffix_dedup(spark, sf_dir: str) -> DataFrame:
    """Repeated strings of 100 bytes, removed from all of `documents`."""
    return remove_repeats(table(spark, sf_dir, "documents"), with_bytes=False)
