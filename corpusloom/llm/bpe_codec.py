"""Byte-level BPE encoding and decoding with a public rank file.

A piece's bytes are read as Latin-1, so that one Aho-Corasick pass finds the longest token at every
offset. Tokens are then taken from the longest down; a token may follow another only if the two,
merged by rank, would not have become something else at their border. An offset from which nothing
fits is remembered and never entered again, so a piece takes linear time and the result is the one
that merging by rank gives.

Ids travel as little-endian unsigned 32-bit integers in one binary value per text. A null text
encodes as an empty one, null ids decode as empty bytes. Texts are taken whole at any length.
"""

from __future__ import annotations

import base64
import re
from array import array
from collections.abc import Iterator
from functools import lru_cache

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.batches import giving_back, in_parts

# Pieces are cut where white space follows other text; these are the white space of the pattern.
_WHITE = "\t\n\x0b\x0c\r \x85\xa0  -     　"
# Distinct words kept with their ids, in each of two generations, and the longest ones kept.
CACHED_WORDS = 150_000
CACHED_LENGTH = 48
# Border checks kept.
CACHED_PAIRS = 1 << 18


def _ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, f)}


class Decoder:
    """The bytes of all tokens in one array."""

    def __init__(self, path: str):
        ranks = _ranks(path)
        tokens = [b""] * (max(ranks.values()) + 1)
        for t, i in ranks.items():
            tokens[i] = t
        self.sizes = np.array([len(t) for t in tokens], dtype=np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.sizes)])
        self.bytes = np.frombuffer(b"".join(tokens), dtype=np.uint8)

    def decode(self, ids: bytes) -> bytes:
        i = np.frombuffer(ids, dtype="<u4")
        if not len(i):
            return b""
        sizes = self.sizes[i]
        ends = np.cumsum(sizes)
        at = np.repeat(self.starts[i] - (ends - sizes), sizes) + np.arange(ends[-1])
        return self.bytes[at].tobytes()


class Encoder:
    """The tables of one rank file; token ids are ranks."""

    def __init__(self, path: str, pattern: str):
        ranks = _ranks(path)
        self.pattern, self.words = regex.compile(pattern), re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")
        self.rank = {t.decode("latin-1"): i for t, i in ranks.items()}
        self.token = [""] * (max(ranks.values()) + 1)
        for t, i in self.rank.items():
            self.token[i] = t
        self.length = [len(t) for t in self.token]
        self.found = ahocorasick.Automaton()
        for t, i in self.rank.items():
            self.found.add_word(t, i)
        self.found.make_automaton()
        self.shorter = [self._prefix(t) for t in self.token]
        self.halves: list[tuple[int, int]] = [(i, i) for i in range(len(self.token))]
        self.merged: dict[tuple[int, int], int] = {}
        self.fits: dict[int, bool] = {}
        # A token's halves are what its bytes become just before the last merge, all of lower rank.
        for i, t in enumerate(self.token):
            if len(t) > 1:
                parts = self._halves(t)
                if len(parts) == 2:
                    self.halves[i] = (parts[0], parts[1])
                    self.merged[(parts[0], parts[1])] = i
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        # Letters of every Unicode version; such a word is one match of a pattern with " ?\\p{L}+".
        self.plain = re.compile(" ?[A-Za-zÀ-ÖØ-öø-ÿ]+").fullmatch if r"| ?\p{L}+|" in pattern else lambda word: None

    def _prefix(self, t: str) -> int:
        """The longest token that is a proper prefix, -1 for none."""
        for n in range(len(t) - 1, 0, -1):
            i = self.rank.get(t[:n])
            if i is not None:
                return i
        return -1

    def _halves(self, t: str) -> list[int]:
        """What is left of a token's bytes after all merges by rank but its own."""
        parts, own = list(t), self.rank[t]
        while len(parts) > 2:
            ranks = [self.rank.get(x + y, own) for x, y in zip(parts, parts[1:])]
            least = min(ranks)
            if least >= own:
                break
            at = ranks.index(least)
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return [self.rank[p] for p in parts]

    def _fit(self, a: int, b: int) -> bool:
        """Whether merging by rank leaves a border between tokens ``a`` and ``b``."""
        # Undo merges from the latest: a merge across the border that comes before the younger of the two
        # sides was made would have taken place.
        limit, fit = 1 << 62, True
        x, y = a, b
        while True:
            if self.merged.get((x, y), 1 << 62) < limit:
                fit = False
                break
            # A single byte is its own half. Of two equal ranks the left one was merged first.
            inner_x, inner_y = self.halves[x][1], self.halves[y][0]
            if inner_x != x and (x > y or inner_y == y):
                limit, x = x, inner_x
            elif inner_y != y:
                limit, y = y + 1, inner_y
            else:
                break
        if len(self.fits) >= CACHED_PAIRS:
            self.fits.clear()
        self.fits[a << 32 | b] = fit
        return fit

    def _search(self, t: str) -> list[int]:
        n, length, shorter, fits, fit = len(t), self.length, self.shorter, self.fits.get, self._fit
        longest = [-1] * n
        for end, i in self.found.iter(t):
            # Ends grow, so the last one seen for a start is the longest.
            longest[end - length[i] + 1] = i
        dead = bytearray(n + 1)
        out: list[int] = []
        at, before, token = 0, -1, longest[0]
        while True:
            end = at + length[token]
            if not dead[end] and (before < 0 or fits(before << 32 | token) or fit(before, token)):
                out.append(token)
                if end == n:
                    return out
                at, before, token = end, token, longest[end]
                continue
            token = shorter[token]
            while token < 0:
                dead[at] = 1
                token = out.pop()
                at -= length[token]
                token = shorter[token]
                before = out[-1] if out else -1

    def piece(self, t: bytes) -> list[int]:
        """Ids of the bytes of one match of the pattern."""
        t = t.decode("latin-1")
        whole = self.rank.get(t)
        return [whole] if whole is not None else self._search(t)

    def _word(self, word: str) -> bytes:
        packed = self.older.get(word)
        if packed is None:
            if self.plain(word):
                packed = array("I", self.piece(word.encode())).tobytes()
            else:
                packed = b"".join([array("I", self.piece(m.encode())).tobytes() for m in self.pattern.findall(word)])
            if len(word) > CACHED_LENGTH:
                return packed
        if len(self.known) >= CACHED_WORDS:
            self.known, self.older = {}, self.known
        self.known[word] = packed
        return packed

    def forget(self) -> None:
        """Frees what is kept of the texts so far; a worker that goes on to other work would hold it."""
        self.known, self.older, self.fits = {}, {}, {}

    def encode(self, text: str) -> bytes:
        known, other = self.known.get, self._word
        return b"".join([known(w) or other(w) for w in self.words.findall(text)])


@lru_cache(maxsize=2)
def _encoder(path: str, pattern: str) -> Encoder:
    """Built once per Python worker, like the decoder."""
    return Encoder(path, pattern)


@lru_cache(maxsize=2)
def _decoder(path: str) -> Decoder:
    return Decoder(path)


def encoded(text: Column, path: str, pattern: str) -> Column:
    """Ids of a text as little-endian unsigned 32-bit integers."""

    @F.arrow_udf("binary")
    @giving_back
    def encode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _encoder(path, pattern)
        for texts in in_parts(batches):
            yield pa.array([own.encode(t.as_py() or "") for t in texts], pa.binary())
        own.forget()

    # Its result is used more than once; it must not be worked out again for each use.
    return encode.asNondeterministic()(text)


def decoded(ids: Column, path: str) -> Column:
    """The bytes that ids stand for."""

    @F.arrow_udf("binary")
    def decode(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        own = _decoder(path)
        for values in in_parts(batches):
            yield pa.array([own.decode(v.as_py() or b"") for v in values], pa.binary())

    return decode(ids)


def n_tokens(ids: Column) -> Column:
    return (F.octet_length(ids) / 4).cast("long")


def round_trip(docs: DataFrame, path: str, pattern: str, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``keep`` columns, ``ids``, ``n_tokens`` and ``decoded`` bytes of every row.

    Both directions run in one worker, which then holds the tables once.
    """

    @F.arrow_udf("struct<ids:binary,decoded:binary>")
    def both(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder, decoder = _encoder(path, pattern), _decoder(path)
        for texts in in_parts(batches):
            ids = [encoder.encode(t.as_py() or "") for t in texts]
            yield pa.StructArray.from_arrays([pa.array(ids, pa.binary()), pa.array(map(decoder.decode, ids), pa.binary())], ["ids", "decoded"])

    coded = docs.select(*[F.col(f"`{c}`") for c in keep], both.asNondeterministic()(F.col(f"`{text}`")).alias("coded"))
    return coded.select(*keep, F.col("coded.ids").alias("ids"), n_tokens(F.col("coded.ids")).alias("n_tokens"), F.col("coded.decoded").alias("decoded"))
