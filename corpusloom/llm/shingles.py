"""Sets of word shingles as sorted 64-bit hashes, computed by array operations over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are hashed in pieces of about this many bytes, so that memory does not follow their length.
PIECE_BYTES = 1 << 18

# Odd constants: the base of the rolling hash and one multiplier per place in a shingle.
_BASE = 0x9E3779B97F4A7C15
_MIX = (0xBF58476D1CE4E5B9, 0x94D049BB133111EB)
_WHOLE = 0xD6E8FEB86659FD93

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint64)
_LOWER[65:91] += np.uint64(32)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * np.uint64(_MIX[0])
    h = (h ^ (h >> np.uint64(27))) * np.uint64(_MIX[1])
    return h ^ (h >> np.uint64(31))


class Shingler:
    """Turns texts into sets: lower-cased A-Z, words between ASCII white space, ``width`` words a shingle."""

    def __init__(self, width: int):
        self.width = width
        self.up, self.down = _powers(_BASE, PIECE_BYTES), _powers(pow(_BASE, -1, 1 << 64), PIECE_BYTES)
        self.places = [np.uint64(pow(_BASE, 2 * i + 3, 1 << 64)) for i in range(width)]

    def _words(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of the words of some adjoining texts, and the number of the text each is in."""
        space = _SPACE[data]
        cut = np.ones(len(data) + 1, dtype=bool)
        cut[1:-1] = space[:-1]
        cut[starts] = True
        first = np.flatnonzero(~space & cut[:-1])
        after = np.ones(len(data) + 1, dtype=bool)
        after[:-1] = space
        after[starts] = True
        last = np.flatnonzero(~space & after[1:]) + 1
        up, down = self.up, self.down
        if len(data) > len(up):  # one word longer than a piece
            up, down = _powers(_BASE, len(data)), _powers(pow(_BASE, -1, 1 << 64), len(data))
        sums = np.zeros(len(data) + 1, dtype=np.uint64)
        np.cumsum((_LOWER[data] + np.uint64(1)) * up[: len(data)], out=sums[1:])
        return _mixed((sums[last] - sums[first]) * down[first]), np.searchsorted(starts, first, "right") - 1

    def _set(self, words: np.ndarray) -> np.ndarray:
        if not len(words):
            return np.zeros(0, dtype=np.int64)
        if len(words) < self.width:
            h = np.zeros(1, dtype=np.uint64)
            for w in words:
                h = _mixed(h * np.uint64(_WHOLE) + w)
            return h.view(np.int64)
        n = len(words) - self.width + 1
        total = np.zeros(n, dtype=np.uint64)
        for i, place in enumerate(self.places):
            total += words[i : i + n] * place
        return np.unique(_mixed(total).view(np.int64))

    def _long(self, data: np.ndarray) -> np.ndarray:
        """The words of a text longer than a piece, piece by piece."""
        parts = []
        while len(data):
            end = len(data)
            if end > PIECE_BYTES:
                gaps = np.flatnonzero(_SPACE[data[:PIECE_BYTES]])
                if not len(gaps):  # a word longer than a piece goes to its end
                    gaps = np.flatnonzero(_SPACE[data])[:1]
                end = int(gaps[-1]) + 1 if len(gaps) else end
            parts.append(self._words(data[:end], np.zeros(1, dtype=np.int64))[0])
            data = data[end:]
        return np.concatenate(parts) if parts else np.zeros(0, dtype=np.uint64)

    def sets(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The sorted set of each text; a null text has none."""
        return map(self._set, self.words(texts))

    def words(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The hashes of the words of each text, in order."""
        if not len(texts):
            return
        texts = texts.fill_null("").cast(pa.large_binary())
        offsets = np.frombuffer(texts.buffers()[1], dtype=np.int64)[texts.offset : texts.offset + len(texts) + 1]
        whole = texts.buffers()[2]
        data = np.frombuffer(whole, dtype=np.uint8) if whole is not None and whole.size else np.zeros(0, np.uint8)
        i = 0
        while i < len(texts):
            j = int(np.searchsorted(offsets, offsets[i] + PIECE_BYTES, "right")) - 1
            if j <= i:
                yield self._long(data[offsets[i] : offsets[i + 1]])
                i += 1
                continue
            j = min(j, len(texts))
            words, of = self._words(data[offsets[i] : offsets[j]], offsets[i:j] - offsets[i])
            ends = np.searchsorted(of, np.arange(j - i), "right")
            # Empty texts share their start with the next one; their words are none.
            begins = np.searchsorted(of, np.arange(j - i), "left")
            for b, e in zip(begins, ends):
                yield words[b:e]
            i = j
