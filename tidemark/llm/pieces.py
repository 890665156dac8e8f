"""SentencePiece encoding and decoding by a Viterbi search that an Aho-Corasick automaton drives.

The automaton holds all pieces. In one pass over a text it reports, at each position, the pieces that end there, the
longest first; each relaxes the best score of the position from the one where it begins. Back pointers give
the segmentation with the highest sum of piece scores. Of equal sums the longer last piece wins. This is the search of
a unigram model; the pieces and scores of any model file can be used, also of one that was trained for merging.

Pieces hold the space mark only at their beginning, and some characters are in no piece at all; no segmentation
reaches across such places, so a text is searched unit by unit (usually a word) and frequent units are remembered. The
result is the same as that of one search over the whole text. Where a model breaks the rule, whole texts are searched.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import types as T

from tidemark.llm.common import Memo, map_rows, per_process

SPACE = "▁"
NORMAL, UNKNOWN, CONTROL, USER_DEFINED, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
UNKNOWN_PENALTY = 10.0
LONGEST_UNIT = 64
SLICE = 1 << 20


def _fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """Field numbers and values of a protocol buffer message."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            value |= (data[at] & 127) << shift
            shift += 7
            at += 1
            if data[at - 1] < 128:
                return value

    while at < len(data):
        tag = varint()
        if tag & 7 == 0:
            yield tag >> 3, varint()
        else:
            size = {1: 8, 5: 4}.get(tag & 7) or varint()
            yield tag >> 3, data[at : at + size]
            at += size


@dataclass
class Pieces:
    """What a model file says: pieces with scores and types, and how texts are normalised."""

    texts: list[str]
    scores: list[float]
    types: list[int]
    byte_fallback: bool
    dummy_prefix: bool

    @classmethod
    def read(cls, path: str) -> Pieces:
        texts, scores, types = [], [], []
        byte_fallback, normalizer = False, {}
        with open(path, "rb") as file:
            model = file.read()
        for number, value in _fields(model):
            if number == 1:
                piece = dict(_fields(value))
                texts.append(piece[1].decode())
                scores.append(float(np.frombuffer(piece.get(2, b"\0" * 4), "<f4")[0]))
                types.append(piece.get(3, NORMAL))
            elif number == 2:
                byte_fallback = bool(dict(_fields(value)).get(35, 0))
            elif number == 3:
                normalizer = dict(_fields(value))
        # fields of the normalizer: 2 character map, 3 dummy prefix, 4 removal of extra blanks, 5 blanks as marks
        if normalizer.get(2) or normalizer.get(4, 1) or not normalizer.get(5, 1) or USER_DEFINED in types:
            raise ValueError("only models without character map, blank removal and user-defined pieces are supported")
        return cls(texts, scores, types, byte_fallback, bool(normalizer.get(3, 1)))


class Encoder:
    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        self.automaton = ahocorasick.Automaton()
        normal = [i for i, t in enumerate(pieces.types) if t == NORMAL]
        for i in normal:
            self.automaton.add_word(pieces.texts[i], (len(pieces.texts[i]), pieces.scores[i], i))
        self.automaton.make_automaton()
        self.unknown_score = min((pieces.scores[i] for i in normal), default=0.0) - UNKNOWN_PENALTY
        self.unknown = pieces.types.index(UNKNOWN)
        self.bytes = {int(pieces.texts[i][1:-1], 16): i for i, t in enumerate(pieces.types) if t == BYTE}
        inner = any(SPACE in pieces.texts[i].lstrip(SPACE) for i in normal)
        line = any("\n" in pieces.texts[i] for i in normal)
        mark = f"{SPACE}*[^{SPACE}]+|{SPACE}+" if line else f"\n|{SPACE}*[^{SPACE}\n]+|{SPACE}+"
        self.units = re.compile(r"(?s).+" if inner else mark)
        self.inner = inner
        self.memo = Memo(lambda unit: self.search(unit).tobytes())

    def search(self, text: str) -> np.ndarray:
        """The ids of the best segmentation of one unit."""
        n = len(text)
        best, back = [0.0] + [-math.inf] * n, [None] * (n + 1)
        known = bytearray(n + 1)  # 1: the character before the position is a piece itself
        done = 0  # positions up to here have their best score

        def settle(upto: int) -> None:
            nonlocal done
            while done < upto:
                done += 1
                if not known[done] and best[done - 1] + self.unknown_score > best[done]:
                    best[done], back[done] = best[done - 1] + self.unknown_score, (1, 0.0, -1)

        for last, piece in self.automaton.iter(text):
            if done < last:
                settle(last)
            length, score, _ = piece
            total = best[last + 1 - length] + score
            if total > best[last + 1]:
                best[last + 1], back[last + 1] = total, piece
            if length == 1:
                known[last + 1] = 1
        settle(n)
        ids, at = [], n
        while at:
            length, _, piece = back[at]
            at -= length
            if piece >= 0:
                ids.append(piece)
            elif self.pieces.byte_fallback:
                ids.extend(self.bytes[b] for b in reversed(text[at].encode()))
            elif not ids or ids[-1] != self.unknown:  # a run of unknown characters is one unknown piece
                ids.append(self.unknown)
        return np.array(ids[::-1], "<i4")

    def encode(self, text: str | None) -> np.ndarray:
        if not text:
            return np.zeros(0, "<i4")
        memo, search = self.memo, self.search
        out = []
        for part in self.slices(text):
            units = self.units.findall(part)
            out.append(b"".join([memo[u] if len(u) <= LONGEST_UNIT else search(u).tobytes() for u in units]))
        ids = np.frombuffer(b"".join(out), "<i4")
        if self.pieces.byte_fallback:
            return ids
        return ids[np.append(True, (ids[1:] != self.unknown) | (ids[:-1] != self.unknown))]

    def slices(self, text: str) -> Iterator[str]:
        """Normalised parts that begin with a space mark behind another character (or at the beginning)."""
        start = 0
        prefix = SPACE if self.pieces.dummy_prefix else ""
        cut = re.compile("(?<=[^ ▁]) ")
        while start < len(text):
            found = None if self.inner else cut.search(text, start + SLICE)
            end = found.start() if found else len(text)
            yield prefix + text[start:end].replace(" ", SPACE)
            start, prefix = end, ""


class Decoder:
    def __init__(self, pieces: Pieces):
        self.dummy_prefix = pieces.dummy_prefix
        silent = {CONTROL: b"", UNKNOWN: " ⁇ ".encode()}
        self.bytes = [
            bytes([int(t[1:-1], 16)]) if k == BYTE else silent.get(k, t.replace(SPACE, " ").encode())
            for t, k in zip(pieces.texts, pieces.types, strict=True)
        ]

    def decode(self, ids) -> str:
        """The text of the ids; bytes that are no UTF-8 become replacement characters."""
        numbers = ids.tolist() if isinstance(ids, np.ndarray) else ids
        text = b"".join(map(self.bytes.__getitem__, numbers)).decode(errors="replace")
        return text[1:] if self.dummy_prefix and text.startswith(" ") else text


def encoder(path: str) -> Encoder:
    return per_process(("encoder", path), lambda: Encoder(Pieces.read(path)))


def decoder(path: str) -> Decoder:
    return per_process(("decoder", path), lambda: Decoder(Pieces.read(path)))


def encode(df: DataFrame, model: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id and ``ids`` (array of int) of every row; ``model`` is the path of the model file on all machines.

    Null and empty texts have no ids. Texts are encoded one by one: repeated and null ids of rows stay; other
    columns are ignored. A space mark in the text itself is taken for a blank, as SentencePiece does.
    """
    schema = T.StructType(
        [T.StructField(id_column, df.schema[id_column].dataType), T.StructField("ids", T.ArrayType(T.IntegerType()))]
    )

    def start():
        encode = encoder(model).encode
        return lambda key, text: [(key, encode(text))]

    return map_rows(df.select(id_column, text_column), schema, start)


def decode(df: DataFrame, model: str, *, ids_column: str = "ids", text_column: str = "text") -> DataFrame:
    """``df`` with the text of its ids as column ``text_column``; null ids give a null text."""
    names = [c for c in df.columns if c != text_column]
    place = names.index(ids_column)
    schema = T.StructType([*(df.schema[c] for c in names), T.StructField(text_column, T.StringType())])

    def start():
        text_of = decoder(model).decode
        return lambda *row: [(*row, None if row[place] is None else text_of(row[place]))]

    return map_rows(df.select(*names), schema, start)


def encode_and_decode(df: DataFrame, model: str, *, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The id, ``ids`` and ``decoded`` (their text) of every row, in one pass; nulls as in ``encode``, whose ids give an empty text."""
    schema = T.StructType(
        [
            T.StructField(id_column, df.schema[id_column].dataType),
            T.StructField("ids", T.ArrayType(T.IntegerType())),
            T.StructField("decoded", T.StringType()),
        ]
    )

    def start():
        encode, text_of = encoder(model).encode, decoder(model).decode

        def call(key, text):
            ids = encode(text)
            yield key, ids, text_of(ids)

        return call

    return map_rows(df.select(id_column, text_column), schema, start)
