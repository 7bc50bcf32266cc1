"""SentencePiece encoding and decoding.

An Aho-Corasick automaton over all pieces reads a text once. At each position
its output links list every piece that ends there; each relaxes the best score
up to that position, and the best segmentation is read backwards (Viterbi). A
character that no piece covers alone costs the unknown penalty and is written as
byte pieces, so that decoding gives the text back exactly.

Pieces that hold a word boundary mark have it only in front, so a text is cut
before each run of marks; words repeat, and a task keeps the segmentations of
the words it has met: the last `KEPT_WORDS`, and as many before them, until it ends. A vocabulary with other pieces is
handled too, by segmenting whole texts.
"""

from __future__ import annotations

import hashlib
import re
import struct
from collections.abc import Iterator
from dataclasses import dataclass
from functools import cached_property

import ahocorasick
import numpy as np
import pyarrow as pa
import sentencepiece
from pyspark.sql import DataFrame

from storetally.llm.texts import portions, table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
MARK = "▁"
UNKNOWN_PENALTY = 10.0
# A word takes about 270 bytes with its ids, and an executor has a Python worker for each core.
KEPT_WORDS = 100_000


@dataclass(frozen=True)
class Vocabulary:
    """Pieces with their scores, the ids of the 256 byte pieces and of the unknown piece."""

    pieces: dict[str, tuple[int, float]]
    byte_ids: tuple[int, ...]
    unknown: int
    size: int

    @classmethod
    def load(cls, path: str = MODEL) -> Vocabulary:
        model = sentencepiece.SentencePieceProcessor(model_file=path)
        ids = range(model.get_piece_size())
        byte_ids = {int(model.id_to_piece(i)[3:5], 16): i for i in ids if model.is_byte(i)}
        special = [i for i in ids if model.is_byte(i) or model.is_control(i) or model.is_unknown(i) or model.is_unused(i)]
        pieces = {model.id_to_piece(i): (i, model.get_score(i)) for i in set(ids) - set(special)}
        return cls(
            dict(sorted(pieces.items(), key=lambda item: item[1][0])),
            tuple(byte_ids[b] for b in range(256)) if len(byte_ids) == 256 else (),
            model.unk_id(),
            len(ids),
        )


def _packed(ids: list[int]) -> bytes:
    """Ids as little-endian 32-bit integers."""
    return struct.pack(f"<{len(ids)}i", *ids)


class Codec:
    """Encoder and decoder of one vocabulary; holds the automaton and the segmentations met so far."""

    def __init__(self, vocabulary: Vocabulary):
        self.vocabulary = vocabulary
        self.automaton = ahocorasick.Automaton()
        for piece, (number, score) in vocabulary.pieces.items():
            self.automaton.add_word(piece, (number, score, len(piece)))
        self.automaton.make_automaton()
        self.single = {piece for piece in vocabulary.pieces if len(piece) == 1}
        self.penalty = min((score for _, score in vocabulary.pieces.values()), default=0.0) - UNKNOWN_PENALTY
        known = set().union(*map(set, vocabulary.pieces)) if vocabulary.pieces else set()
        # Cutting is exact if no piece holds a mark behind another character.
        apart = all(MARK not in piece.lstrip(MARK) for piece in vocabulary.pieces)
        rest = f"[^{MARK}]+" if "\n" in known else f"[^{MARK}\n]+"
        self.words = re.compile(f"{MARK}*{rest}|{MARK}+|\n+" if apart else "(?s).+")
        self.kept: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}

    def forget(self) -> None:
        """Drops the segmentations; the automaton stays."""
        self.kept, self.older = {}, {}

    @cached_property
    def spellings(self) -> list[bytes]:
        """The bytes of each id; a mark is a space."""
        found = [b""] * self.vocabulary.size
        for piece, (number, _) in self.vocabulary.pieces.items():
            found[number] = piece.replace(MARK, " ").encode()
        for byte, number in enumerate(self.vocabulary.byte_ids):
            found[number] = bytes([byte])
        return found

    def segment(self, word: str) -> list[int]:
        """Ids of the best segmentation of a word; of equal ones, that with the longest last piece."""
        size = len(word)
        best = [float("-inf")] * (size + 1)
        best[0] = 0.0
        # The piece that ends at each position in the best way; None is an unknown character.
        ends: list[tuple[int, float, int] | None] = [None] * (size + 1)
        if self.single.issuperset(word):
            for last, hit in self.automaton.iter(word):
                stop = last + 1
                total = best[stop - hit[2]] + hit[1]
                if total > best[stop]:
                    best[stop], ends[stop] = total, hit
        else:
            self._relax_unknown(word, best, ends)
        found: list[int] = []
        while size:
            hit = ends[size]
            if hit:
                found.append(hit[0])
                size -= hit[2]
            else:
                found += self._spelt(word[size - 1])[::-1]
                size -= 1
        return found[::-1]

    def _relax_unknown(self, word: str, best: list[float], ends: list[tuple[int, float, int] | None]) -> None:
        """The same pass over a word with characters that no piece covers alone."""
        single, penalty = self.single, self.penalty
        relaxed = 0

        def unknown(until: int) -> None:
            nonlocal relaxed
            # Positions up to `until` have met all pieces that end there.
            while relaxed < until:
                relaxed += 1
                total = best[relaxed - 1] + penalty
                if word[relaxed - 1] not in single and total > best[relaxed]:
                    best[relaxed], ends[relaxed] = total, None

        for last, hit in self.automaton.iter(word):
            unknown(last)
            total = best[last + 1 - hit[2]] + hit[1]
            if total > best[last + 1]:
                best[last + 1], ends[last + 1] = total, hit
        unknown(len(word))

    def _spelt(self, character: str) -> list[int]:
        byte_ids = self.vocabulary.byte_ids
        return [byte_ids[b] for b in character.encode()] if byte_ids else [self.vocabulary.unknown]

    def _word(self, word: str) -> bytes:
        ids = self.older.get(word) or _packed(self.segment(word))
        if len(self.kept) >= KEPT_WORDS:
            self.older, self.kept = self.kept, {}
        self.kept[word] = ids
        return ids

    def encode(self, text: str) -> bytes:
        """Ids as little-endian 32-bit integers; a space is put in front, an empty text has none."""
        if not text:
            return b""
        if MARK in text:
            # A mark of the text itself is spelt by bytes, or it would come back as a space.
            spelt = _packed(self._spelt(MARK))
            parts = (" " + text).split(MARK)
            return spelt.join(self._marked(part.replace(" ", MARK)) for part in parts)
        return self._marked(MARK + text.replace(" ", MARK))

    def _marked(self, text: str) -> bytes:
        return b"".join([self.kept.get(word) or self._word(word) for word in self.words.findall(text)])

    def decode(self, ids: bytes) -> str:
        spellings = self.spellings
        found = b"".join([spellings[i] for i in np.frombuffer(ids, dtype="<i4").tolist()])
        return found.decode("utf-8", errors="replace")[1:]


_CODECS: dict[int, Codec] = {}


def _codec(vocabulary: Vocabulary) -> Codec:
    """One codec per Python worker, so that the automaton outlasts a task; its words would stay through later stages."""
    key = hash((vocabulary.size, vocabulary.unknown, tuple(vocabulary.pieces.items())))
    if key not in _CODECS:
        _CODECS.clear()
        _CODECS[key] = Codec(vocabulary)
    return _CODECS[key]


def _encoded(vocabulary: Vocabulary, place: int, ids: str, round_trip: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        try:
            for rows in portions(batches):
                texts = [one or "" for one in rows.column(place).to_pylist()]
                found = [codec.encode(one) for one in texts]
                same = [codec.decode(one) == whole for one, whole in zip(found, texts)]
                offsets = np.concatenate([[0], np.cumsum([len(one) // 4 for one in found])]).astype(np.int32)
                values = pa.array(np.frombuffer(b"".join(found), dtype="<i4"))
                yield pa.RecordBatch.from_arrays(
                    [*rows.columns, pa.ListArray.from_arrays(pa.array(offsets), values), pa.array(same)],
                    [*rows.schema.names, ids, round_trip],
                )
        finally:
            codec.forget()

    return run


def encode(docs: DataFrame, vocabulary: Vocabulary, text: str = "text", ids: str = "ids", round_trip: str = "round_trip") -> DataFrame:
    """`docs` with the ids of each whole text (array of int) and whether decoding them gives the text back.

    A NULL or empty text has no ids and comes back as empty. All rows stay, repeated
    ones too, with their other columns; an empty table stays empty. `ids` and
    `round_trip` must be names that `docs` does not have.
    """
    place = docs.columns.index(text)
    schema = docs.selectExpr("*", f"CAST(array() AS array<int>) AS `{ids}`", f"true AS `{round_trip}`").schema

    return docs.mapInArrow(_encoded(vocabulary, place, ids, round_trip), schema)


def decode(docs: DataFrame, vocabulary: Vocabulary, ids: str = "ids", text: str = "decoded") -> DataFrame:
    """`docs` with the text of each row's ids; NULL ids give an empty text."""
    place = docs.columns.index(ids)
    schema = docs.selectExpr("*", f"'' AS `{text}`").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = _codec(vocabulary)
        for batch in batches:
            found = [codec.decode(np.array(one or [], dtype="<i4").tobytes()) for one in batch.column(place).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(found, pa.string())], [*batch.schema.names, text])

    return docs.mapInArrow(run, schema)


def digest(ids: bytes) -> str:
    return hashlib.sha256(ids).hexdigest()


def op8_sentencepiece(spark, sf_dir: str) -> DataFrame:
    """Ids of all of `documents`: doc_id, n_pieces, round_trip, ids."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode(docs, Vocabulary.load()).selectExpr(
        "doc_id", "CAST(size(ids) AS bigint) AS n_pieces", "round_trip", "ids"
    )
