"""Language of code-switched text: a linear-chain conditional random field over words.

A word's features are its beginnings and endings, its letter n-grams, and the word itself where it is in
the lexicon of the training sample; each feature has a weight per language. Transitions between the
languages of neighbouring words are learned with them. Forward-backward gives every word a
distribution over languages; a document's language is the one with the largest mean over its words
that hold a letter, and the score is that mean.

Training maximises the likelihood of word sequences from a bounded sample of labelled documents. A
document's language stands for all its words; some sequences are put together from two documents,
so that switches are seen. Language, source and id are never inputs of a prediction.

A text that is null or has no letter is ``und`` with score 0. Texts are read whole at any length;
repeated rows are predicted alike; a null ``doc_id`` counts as held out; other columns are ignored.
Without any labelled text every row is ``und``.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.folds import bounded, held_out

UNKNOWN = "und"
# Labelled documents that training sees, at most, and sequences taken from them.
SAMPLE_ROWS = 3_000
SEQUENCES = 12_000
SEQUENCE_WORDS = 24
# Languages learned, at most, by their documents in the sample.
MOST_LANGUAGES = 64
BUCKETS = 1 << 16
EPOCHS = 3
BATCH = 64
STEP = 0.15
# Distinct words and parts of words remembered by a task, and words labelled at a time.
_KNOWN_WORDS = 100_000
_KNOWN_GRAMS = 1 << 18
_WORDS_SCORED = 1 << 14
# Longer sequences are taken in blocks of so many words.
_BLOCK_WORDS = 64
_WORDS_AT_ONCE = 2_000_000

_LETTER = re.compile(r"[^\W\d_]")
_EDGES = "".join(c for c in map(chr, range(33, 127)) if not c.isalnum()) + "“”„«»…–—¿¡"


class _Cells(dict):
    """The cells of affixes and n-grams, which many words share."""

    def __missing__(self, name: str) -> int:
        if len(self) >= _KNOWN_GRAMS:
            self.clear()
        cell = self[name] = zlib.crc32(name.encode()) % BUCKETS
        return cell


_cells = _Cells()


def _features(word: str) -> list[int]:
    """Hashed affixes, n-grams and the word itself; none for a word without letters."""
    w = word.strip(_EDGES).lower()
    if not _LETTER.search(w):
        return []
    names = [f"p{w[:n]}" for n in (1, 2, 3) if len(w) >= n] + [f"s{w[-n:]}" for n in (1, 2, 3, 4) if len(w) >= n]
    edged = f"^{w}$"
    names += [f"g{edged[i : i + n]}" for n in (2, 3) for i in range(len(edged) - n + 1)]
    return [zlib.crc32(f"w{w}".encode()) % BUCKETS, *map(_cells.__getitem__, dict.fromkeys(names))]


def _crc_steps() -> np.ndarray:
    steps = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        steps = (steps >> 1) ^ np.where(steps & 1, np.uint32(0xEDB88320), np.uint32(0))
    return steps


_CRC = _crc_steps()


def _cells_of(words: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """``_features`` of trimmed words with a letter, one after another, and how many each word has.

    All checksums grow by one character at a time, those of all words together.
    """
    edged = "".join([f"^{w}$" for w in words])
    code, raw = np.frombuffer(edged.encode("utf-32-le"), "<u4"), np.frombuffer(edged.encode(), np.uint8)
    width = 1 + (code >= 0x80).astype(np.int64) + (code >= 0x800) + (code >= 0x10000)
    byte = np.cumsum(width) - width
    size = np.fromiter(map(len, words), np.int64, len(words))
    first = np.cumsum(size + 2) - size - 1

    def after(state: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Checksums that have also read the characters at some places."""
        b, w = byte[at], width[at]
        state = _CRC[(state ^ raw[b]) & 255] ^ (state >> 8)
        for k in range(1, 4):
            wide = np.flatnonzero(w > k)
            if not len(wide):
                break
            s = state[wide]
            state[wide] = _CRC[(s ^ raw[b[wide] + k]) & 255] ^ (s >> 8)
        return state

    def opened(kind: bytes, n: int) -> np.ndarray:
        return np.full(n, zlib.crc32(kind) ^ 0xFFFFFFFF, np.uint32)

    heads, tails = np.minimum(size, 3), np.minimum(size, 4)
    n = 2 + heads + tails + 2 * size
    base = np.cumsum(n) - n
    state = np.empty(int(n.sum()), np.uint32)
    state[base] = np.fromiter((zlib.crc32(f"w{w}".encode()) for w in words), np.uint32, len(words)) ^ np.uint32(0xFFFFFFFF)
    found, some = opened(b"p", len(words)), np.arange(len(words))
    for k in range(3):
        some = np.flatnonzero(size > k)
        found[some] = after(found[some], first[some] + k)
        state[base[some] + 1 + k] = found[some]
    for k in range(1, 5):
        some = np.flatnonzero(size >= k)
        found = opened(b"s", len(some))
        for back in range(k, 0, -1):
            found = after(found, first[some] + size[some] - back)
        state[base[some] + heads[some] + k] = found
    # Two characters begin at every place but a word's last, three at every place but its last two.
    owner = np.repeat(np.arange(len(words)), size + 1)
    place = np.arange(len(owner)) - np.repeat(np.cumsum(size + 1) - size - 1, size + 1)
    at, to = first[owner] - 1 + place, (base + 1 + heads + tails)[owner] + place
    two = after(after(opened(b"g", len(at)), at), at + 1)
    state[to] = two
    inner = np.flatnonzero(place < size[owner])
    state[to[inner] + size[owner[inner]] + 1] = after(two[inner], at[inner] + 2)
    cells = ((state ^ np.uint32(0xFFFFFFFF)) % BUCKETS).astype(np.int64)
    # A word that repeats two of its letters may repeat a feature, which counts once.
    pairs = owner << 42 | code[at].astype(np.int64) << 21 | code[at + 1]
    pairs.sort()
    again = np.unique(pairs[1:][pairs[1:] == pairs[:-1]] >> 42)
    if len(again):
        keep = np.ones(len(cells), dtype=bool)
        for i in again:
            own = _features(words[i])
            cells[base[i] : base[i] + len(own)] = own
            keep[base[i] + len(own) : base[i] + n[i]] = False
            n[i] = len(own)
        cells = cells[keep]
    return cells, n


class Field:
    """Weights of a trained chain: ``emit`` by feature and language, ``move`` from language to language."""

    def __init__(self, languages: list[str], emit: np.ndarray, move: np.ndarray, start: np.ndarray):
        self.languages, self.emit, self.move, self.start = languages, emit, move, start

    def scores(self, words: list[str]) -> np.ndarray:
        """The scores of some trimmed words with a letter by their features."""
        cells, sizes = _cells_of(words)
        return np.add.reduceat(self.emit.take(cells, axis=0), np.cumsum(sizes) - sizes, axis=0) / np.sqrt(sizes)[:, None]


def _chain(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray, start: np.ndarray, pairs: bool = False):
    """Word marginals of many sequences at once; ``scores`` holds them one after another, longest first.

    Step t handles the t-th word of every sequence that has one.
    """
    offsets = np.concatenate([[0], np.cumsum(lengths)])[:-1]
    k, m = scores.shape[1], np.exp(move)
    e = np.exp(scores - scores.max(axis=1, keepdims=True))
    forward = np.empty_like(e)
    longest = int(lengths[0]) if len(lengths) else 0
    active = [int(np.searchsorted(-lengths, -t, "left")) for t in range(longest)]
    a = np.exp(start)[None, :]
    for t in range(longest):
        at = offsets[: active[t]] + t
        now = e[at] * (a if t == 0 else a[: active[t]] @ m)
        a = now / now.sum(axis=1, keepdims=True)
        forward[at] = a
    backward = np.empty_like(e)
    moves = np.zeros((k, k))
    b = np.ones((0, k))
    for t in range(longest - 1, -1, -1):
        at = offsets[: active[t]] + t
        full = np.ones((active[t], k))
        if len(b):
            after = e[at[: len(b)] + 1] * b
            full[: len(b)] = after @ m.T
            full[: len(b)] /= full[: len(b)].sum(axis=1, keepdims=True)
            if pairs:
                joint = forward[at[: len(b)]][:, :, None] * m[None] * after[:, None, :]
                moves += (joint / joint.sum(axis=(1, 2), keepdims=True)).sum(axis=0)
        b = full
        backward[at] = b
    marginal = forward * backward
    return marginal / marginal.sum(axis=1, keepdims=True), moves


def _marginals(scores: np.ndarray, lengths: np.ndarray, move: np.ndarray, start: np.ndarray) -> np.ndarray:
    """As ``_chain`` without pairs, with the words of long sequences taken in blocks.

    The step of a word is a matrix, and products of matrices may be grouped at will: the product of each block is
    made for all blocks at once, block ends follow from one another, and inside the blocks all places go in step.
    """
    long = int(np.searchsorted(-lengths, -_BLOCK_WORDS, "left"))
    cut = int(lengths[:long].sum())
    short, _ = _chain(scores[cut:], lengths[long:], move, start)
    if not long:
        return short
    lengths, scores = lengths[:long], scores[:cut]
    k, m = scores.shape[1], np.exp(move)
    blocks = -(-lengths // _BLOCK_WORDS)
    base = np.cumsum(blocks) - blocks
    place = np.arange(cut) - np.repeat(np.cumsum(lengths) - lengths, lengths)
    row, column = np.repeat(base, lengths) + place // _BLOCK_WORDS, place % _BLOCK_WORDS
    e = np.ones((int(blocks.sum()), _BLOCK_WORDS, k))
    e[row, column] = np.exp(scores - scores.max(axis=1, keepdims=True))
    there = np.zeros(e.shape[:2], dtype=bool)
    there[row, column] = True
    first = np.zeros(len(e), dtype=bool)
    first[base] = True

    def stepped(a: np.ndarray, t: int) -> np.ndarray:
        """``a`` (rows of states for each block) after the word at ``t``; the first word has no move before it."""
        moved = (a.reshape(-1, k) @ m).reshape(a.shape)
        if t == 0:
            moved[first] = a[first]
        wide = (slice(None), *[None] * (a.ndim - 2))
        new = moved * e[:, t][wide]
        new /= new.sum(axis=tuple(range(1, new.ndim)), keepdims=True)
        return np.where(there[:, t][wide + (None,)], new, a)

    whole = np.broadcast_to(np.eye(k), (len(e), k, k)).copy()
    for t in range(_BLOCK_WORDS):
        whole = stepped(whole, t)
    ahead, behind = np.empty((len(e), k)), np.ones((len(e), k))
    active = [int(np.searchsorted(-blocks, -n, "left")) for n in range(int(blocks[0]))]
    a = np.broadcast_to(np.exp(start), (long, k))
    for n, size in enumerate(active):
        at = base[:size] + n
        ahead[at] = a[:size]
        a = np.einsum("ni,nij->nj", a[:size], whole[at])
        a /= a.sum(axis=1, keepdims=True)
    for n in range(len(active) - 1, 0, -1):
        at = base[: active[n]] + n
        b = np.einsum("nij,nj->ni", whole[at], behind[at])
        behind[at - 1] = b / b.sum(axis=1, keepdims=True)
    forward, backward = np.empty_like(e), np.empty_like(e)
    a, b = ahead, behind
    for t in range(_BLOCK_WORDS):
        a = forward[:, t] = stepped(a, t)
    for t in range(_BLOCK_WORDS - 1, -1, -1):
        backward[:, t] = b
        new = (e[:, t] * b) @ m.T
        new /= new.sum(axis=1, keepdims=True)
        b = np.where(there[:, t, None], new, b)
    marginal = forward[row, column] * backward[row, column]
    return np.concatenate([marginal / marginal.sum(axis=1, keepdims=True), short])


def train(sample: pd.DataFrame) -> Field | None:
    """Fits the chain to a bounded sample ``text, lang`` by stochastic gradient steps on its likelihood."""
    languages = sorted(sample["lang"].value_counts().index[:MOST_LANGUAGES])
    if not languages:
        return None
    k, rng = len(languages), np.random.default_rng(7)
    cached = lru_cache(maxsize=_KNOWN_WORDS)(_features)
    texts = [[w.split() for w in sample.loc[sample["lang"] == lang, "text"] if w.split()] for lang in languages]
    if not any(texts):
        return None

    def piece(y: int, n: int) -> list[str]:
        words = texts[y][rng.integers(len(texts[y]))]
        at = rng.integers(max(1, len(words) - n + 1))
        return words[at : at + n]

    usable = [y for y in range(k) if texts[y]]
    emit, move, start = np.zeros((BUCKETS, k)), np.zeros((k, k)), np.zeros(k)
    grow_e, grow_m, grow_s = np.full((BUCKETS, k), 1e-6), np.full((k, k), 1e-6), np.full(k, 1e-6)
    for _ in range(SEQUENCES // BATCH):
        words, gold, lengths = [], [], []
        for _ in range(BATCH):
            y = usable[rng.integers(len(usable))]
            sequence = piece(y, SEQUENCE_WORDS)
            labels = [y] * len(sequence)
            if rng.random() < 0.2:
                z = usable[rng.integers(len(usable))]
                cut = int(rng.integers(1, len(sequence) + 1))
                more = piece(z, SEQUENCE_WORDS - cut) if SEQUENCE_WORDS > cut else []
                sequence, labels = sequence[:cut] + more, labels[:cut] + [z] * len(more)
            words.append(sequence)
            gold.append(labels)
        order = sorted(range(BATCH), key=lambda i: -len(words[i]))
        lengths = np.array([len(words[i]) for i in order])
        flat = [cached(w) for i in order for w in words[i]]
        y = np.array([x for i in order for x in gold[i]])
        sizes = np.array([len(f) for f in flat])
        index = np.array([x for f in flat for x in f], dtype=np.int64)
        owner = np.repeat(np.arange(len(flat)), sizes)
        scale = 1 / np.sqrt(np.maximum(sizes, 1))
        scores = np.zeros((len(flat), k))
        np.add.at(scores, owner, emit[index])
        scores *= scale[:, None]
        marginal, moves = _chain(scores, lengths, move, start, pairs=True)
        error = -marginal
        error[np.arange(len(y)), y] += 1
        firsts = np.concatenate([[0], np.cumsum(lengths)])[:-1]
        change_e = (error * scale[:, None])[owner]
        touched, at = np.unique(index, return_inverse=True)
        summed = np.zeros((len(touched), k))
        np.add.at(summed, at, change_e)
        summed = summed / BATCH - 1e-4 * emit[touched]
        grow_e[touched] += summed**2
        emit[touched] += STEP * summed / np.sqrt(grow_e[touched])
        seen = np.zeros((k, k))
        inside = np.ones(len(y), dtype=bool)
        inside[firsts] = False
        later = np.flatnonzero(inside)
        np.add.at(seen, (y[later - 1], y[later]), 1)
        change_m, change_s = (seen - moves) / BATCH - 1e-3 * move, error[firsts].sum(axis=0) / BATCH
        grow_m += change_m**2
        grow_s += change_s**2
        move += STEP * change_m / np.sqrt(grow_m)
        start += STEP * change_s / np.sqrt(grow_s)
    return Field(languages, emit.astype(np.float32), move, start)


class Labeller:
    """Document predictions of a trained chain; each distinct word is scored once."""

    def __init__(self, field: Field):
        self.field, self.known = field, {}
        self.table = np.zeros((1024, len(field.languages)), dtype=np.float32)
        self.used = 0

    def _learn(self, words: list[str]) -> None:
        """Scores of words that are not known yet; -1 for one without letters."""
        for at in range(0, len(words), _WORDS_SCORED):
            part = words[at : at + _WORDS_SCORED]
            trimmed = [w.strip(_EDGES).lower() for w in part]
            places = {w: -1 for w in trimmed}
            new = [w for w in places if _LETTER.search(w)]
            if new:
                while self.used + len(new) > len(self.table):
                    self.table = np.concatenate([self.table, np.zeros_like(self.table)])
                self.table[self.used : self.used + len(new)] = self.field.scores(new)
                places.update(zip(new, range(self.used, self.used + len(new))))
                self.used += len(new)
            self.known.update(zip(part, map(places.__getitem__, trimmed)))

    def documents(self, texts: list[str | None]) -> list[tuple[str, float]]:
        if len(self.known) > _KNOWN_WORDS:
            self.known, self.used = {}, 0
        split = [(t or "").split() for t in texts]
        self._learn(list(set().union(*split) - self.known.keys()))
        rows = []
        for i, words in enumerate(split):
            ids = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
            rows.append((i, ids[ids >= 0]))
        out: list[tuple[str, float]] = [(UNKNOWN, 0.0)] * len(texts)
        rows = sorted((r for r in rows if len(r[1])), key=lambda r: -len(r[1]))
        if not rows:
            return out
        lengths = np.array([len(ids) for _, ids in rows])
        marginal = _marginals(self.table[np.concatenate([ids for _, ids in rows])], lengths, self.field.move, self.field.start)
        ends = np.cumsum(lengths)
        sums = np.add.reduceat(marginal, ends - lengths, axis=0) / lengths[:, None]
        for (i, _), mean in zip(rows, sums):
            best = int(mean.argmax())
            out[i] = (self.field.languages[best], float(min(max(mean[best], 0.0), 1.0)))
        return out


def learn(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> Field | None:
    """The chain fitted to a bounded sample outside the held-out rows."""
    usable = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text"), F.col(f"`{lang}`").alias("lang")).where(
        ~held_out(F.col("id")) & F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}")
    )
    ids = bounded(usable.select("id", "lang"), SAMPLE_ROWS, "id")
    few = usable.join(F.broadcast(ids.select("id").distinct()), "id").select("text", "lang")
    return train(few.toPandas())


def languages(docs: DataFrame, text: str = "text", lang: str = "lang", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` with ``lang_pred`` and ``lang_score``."""
    field = learn(docs, text, lang, doc_id)
    if field is None:
        return docs.withColumns({"lang_pred": F.lit(UNKNOWN), "lang_score": F.lit(0.0)})
    shared = docs.sparkSession.sparkContext.broadcast(field)

    @F.arrow_udf("struct<lang:string,score:double>")
    def predict(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        labeller = Labeller(shared.value)
        for texts in batches:
            found: list[tuple[str, float]] = []
            part: list[str | None] = []
            size = 0
            for t in texts.to_pylist():
                part.append(t)
                size += len(t or "")
                if size > _WORDS_AT_ONCE:
                    found += labeller.documents(part)
                    part, size = [], 0
            found += labeller.documents(part)
            yield pa.StructArray.from_arrays(
                [pa.array([x for x, _ in found], pa.string()), pa.array([s for _, s in found], pa.float64())], ["lang", "score"]
            )

    predicted = docs.withColumn("lang_pred", predict.asNondeterministic()(F.col(f"`{text}`")))
    return predicted.withColumn("lang_score", F.col("lang_pred.score")).withColumn("lang_pred", F.col("lang_pred.lang"))
