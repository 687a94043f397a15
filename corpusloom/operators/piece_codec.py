"""Texts to piece ids and back, with the normalization of the model.

A text is normalized (symbols of the user stay as they are), spaces become marks, and the symbols
of a word are joined as long as two neighbours make a piece, the best-scored piece first. A character without
a piece is spelled as its bytes, or is unknown. No piece goes over the start of a word, so each distinct
word of a batch is encoded once.
"""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterator
from itertools import groupby

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType

from corpusloom.functions.batches import in_parts
from corpusloom.operators.merging import merge_linked
from corpusloom.operators.pieces import BYTE, CONTROL, MARK, UNKNOWN, USER, PieceModel

# Words kept by a task, and the longest of them.
_KNOWN_WORDS = 100_000
_KNOWN_LENGTH = 64
# Fixed value: what an unknown piece reads as.
UNKNOWN_TEXT = " " + chr(0x2047) + " "


class Normalizer:
    """Replaces the longest key at each place, as a trie of the rules does."""

    def __init__(self, rules: dict[str, str]):
        self.rules = rules
        self.longest = max(map(len, rules), default=1)
        single = [k for k in rules if len(k) == 1]
        going_on = {c for k in rules for c in k[1:]}
        self.single = re.compile("[" + _class_of(single) + "]") if single else None
        self.going_on = re.compile("[" + _class_of(going_on) + "]") if going_on else None

    def __call__(self, text: str) -> str:
        if self.going_on is not None and not text.isascii() and self.going_on.search(text):
            return "".join(self._greedy(text))
        return self.single.sub(lambda m: self.rules[m[0]], text) if self.single is not None else text

    def _greedy(self, text: str) -> Iterator[str]:
        i = 0
        while i < len(text):
            for size in range(min(self.longest, len(text) - i), 0, -1):
                made = self.rules.get(text[i : i + size])
                if made is not None:
                    yield made
                    i += size
                    break
            else:
                yield text[i]
                i += 1


def _class_of(chars) -> str:
    """The inside of a character class, as ranges."""
    codes, out = sorted(map(ord, chars)), []
    for _, run in groupby(enumerate(codes), lambda x: x[1] - x[0]):
        run = [c for _, c in run]
        out.append(f"\\U{run[0]:08x}-\\U{run[-1]:08x}")
    return "".join(out)


class PieceEncoder:
    """The ids of texts; one for each task."""

    def __init__(self, model: PieceModel):
        kinds = model.piece_kinds()
        self.model = model
        self.ids = {p: i for i, (p, k) in enumerate(zip(model.pieces, kinds)) if k not in (CONTROL, UNKNOWN, BYTE)}
        scores = model.piece_scores()
        order = sorted((i for i, p in enumerate(model.pieces) if p in self.ids and kinds[i] != USER), key=lambda i: -scores[i])
        # Pieces of equal score are equal in rank.
        self.rank, last = {}, None
        for n, i in enumerate(order):
            last = n if last is None or scores[i] != scores[order[n - 1]] else last
            self.rank[model.pieces[i]] = last
        self.bytes = [model.pieces.index(f"<0x{b:02X}>") for b in range(256)] if model.byte_fallback else None
        self.unknown = kinds.index(UNKNOWN) if UNKNOWN in kinds else 0
        symbols = sorted((p for p, k in zip(model.pieces, kinds) if k == USER), key=len, reverse=True)
        self.symbols = re.compile("(" + "|".join(map(re.escape, symbols)) + ")") if symbols else None
        self.normalize = Normalizer(model.normalization())
        # A mark after another character inside a piece would tie words together.
        tied = any(MARK in p.lstrip(MARK) for p in self.rank)
        self.words = re.compile("(?s).+" if tied else f"{MARK}*[^{MARK}]+|{MARK}+")
        self.known: dict[str, tuple] = {}

    def _spaced(self, text: str) -> list[tuple[bool, str]]:
        """The normalized text with marks, cut at the user's symbols."""
        if self.symbols is None or not self.symbols.search(text):
            parts = [(False, self.normalize(text))]
        else:
            parts = [(i % 2 == 1, p if i % 2 else self.normalize(p)) for i, p in enumerate(self.symbols.split(text))]
        if self.model.remove_extra_whitespaces:
            after_space, kept = True, []
            for user, part in parts:
                if not user:
                    part = re.sub("  +", " ", part)
                    if after_space:
                        part = part.removeprefix(" ")
                if part:
                    after_space = part.endswith(" ")
                    kept.append((user, part))
            while kept and not kept[-1][0]:
                kept[-1] = (False, kept[-1][1].rstrip(" "))
                if kept[-1][1]:
                    break
                kept.pop()
            parts = kept
        if not any(p for _, p in parts):
            return []
        if self.model.add_dummy_prefix:
            if parts[0][0]:
                parts = [(False, " "), *parts]
            else:
                parts[0] = (False, " " + parts[0][1])
        return [(user, part if user else part.replace(" ", MARK)) for user, part in parts]

    def _joined(self, left: str, right: str):
        rank = self.rank.get(left + right)
        return None if rank is None else (rank, left + right)

    def _word(self, word: str) -> tuple:
        found = self.known.get(word)
        if found is None:
            out = []
            for s in merge_linked(list(word), self._joined):
                i = self.ids.get(s)
                if i is not None:
                    out.append(i)
                elif self.bytes is not None:
                    out += [self.bytes[b] for b in s.encode()]
                else:
                    out.append(self.unknown)
            found = tuple(out)
            if len(word) <= _KNOWN_LENGTH:
                if len(self.known) >= _KNOWN_WORDS:
                    self.known.clear()
                self.known[word] = found
        return found

    def __call__(self, text: str) -> list[int]:
        out: list[int] = []
        for user, part in self._spaced(text):
            if user:
                out.append(self.ids[part])
            else:
                for word in self.words.findall(part):
                    out += self._word(word)
        if self.bytes is None:
            # Unknown characters that follow each other are one.
            out = [i for n, i in enumerate(out) if i != self.unknown or not n or out[n - 1] != i]
        return out


def _one_by_one(error: UnicodeDecodeError) -> tuple[str, int]:
    return chr(0xFFFD), error.start + 1


class PieceDecoder:
    """Texts of id lists: bytes are read as UTF-8, marks as spaces, control symbols as nothing."""

    def __init__(self, model: PieceModel):
        codecs.register_error("piece-byte", _one_by_one)
        self.parts = []
        for piece, kind in zip(model.pieces, model.piece_kinds()):
            if kind == BYTE:
                self.parts.append(bytes([int(piece[3:5], 16)]))
            elif kind == CONTROL:
                self.parts.append(b"")
            else:
                text = UNKNOWN_TEXT if kind == UNKNOWN else piece if kind == USER else piece.replace(MARK, " ")
                self.parts.append(text.encode())
        self.strip = model.add_dummy_prefix

    def __call__(self, ids: list[int]) -> str:
        text = b"".join(self.parts[i] for i in ids).decode("utf-8", "piece-byte")
        return text.removeprefix(" ") if self.strip else text


def encode_pieces(df: DataFrame, col: str, model: PieceModel, out: str = "input_ids") -> DataFrame:
    """Add the piece ids of a text column; a null text has null ids. A narrow job without a shuffle."""
    return df.withColumn(out, piece_ids(df.sparkSession, F.col(col), model))


def piece_ids(spark: SparkSession, text: Column, model: PieceModel) -> Column:
    shipped = spark.sparkContext.broadcast(model)

    @F.arrow_udf(ArrayType(IntegerType()))
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = PieceEncoder(shipped.value)
        for texts in in_parts(batches):
            yield pa.array([None if t is None else encoder(t) for t in texts.to_pylist()], pa.list_(pa.int32()))

    # Marked so that later filters stay above it and no row is encoded twice.
    return ids_of.asNondeterministic()(text)


def decode_pieces(df: DataFrame, ids_col: str, model: PieceModel, out: str = "content") -> DataFrame:
    """Add the text of a column of id lists; null ids have no text."""
    shipped = df.sparkSession.sparkContext.broadcast(model)

    @F.arrow_udf(StringType())
    def text_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        decoder = PieceDecoder(shipped.value)
        for lists in in_parts(batches):
            yield pa.array([None if ids is None else decoder(ids) for ids in lists.to_pylist()], pa.string())

    return df.withColumn(out, text_of.asNondeterministic()(F.col(ids_col)))
