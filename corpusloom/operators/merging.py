"""Applying merges to many words at once, as array operations on one task's batch.

Words lie one after the other in a flat array of symbol codes. In each pass every word applies its
lowest-ranked merge at all its places, left to right; a word leaves the passes when nothing is left
to merge. The number of passes is that of the word with the most merges, whatever their number. Long
words would need as many passes as they have symbols; they are merged one by one, over linked symbols with
a queue of their pairs.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Sequence

import numpy as np

_NONE = np.iinfo(np.int64).max
# Words with more symbols are merged by the queue.
LONG_WORD = 256


def merge_linked(symbols: list, joined: Callable) -> list:
    """Join neighbours, lowest rank first and then from the left, until none joins.

    ``joined(left, right)`` returns the rank and the merged symbol, or None. Each join costs the logarithm
    of the length.
    """
    last = len(symbols) - 1
    before, after = list(range(-1, last)), [*range(1, last + 1), -1]
    queue = []
    for i in range(last):
        made = joined(symbols[i], symbols[i + 1])
        if made is not None:
            queue.append((made[0], i, symbols[i], symbols[i + 1], made[1]))
    heapq.heapify(queue)
    while queue:
        _, i, left, right, made = heapq.heappop(queue)
        j = after[i]
        # A neighbour may have been joined to something else since; None marks what is gone.
        if j < 0 or symbols[i] is None or symbols[i] != left or symbols[j] != right:
            continue
        symbols[i], symbols[j] = made, None
        after[i] = after[j]
        if after[i] >= 0:
            before[after[i]] = i
        for k in (before[i], i):
            if k >= 0 and after[k] >= 0:
                found = joined(symbols[k], symbols[after[k]])
                if found is not None:
                    heapq.heappush(queue, (found[0], k, symbols[k], symbols[after[k]], found[1]))
    return [s for s in symbols if s is not None]


class MergeTable:
    """Merges of non-negative codes ``(left, right, merged)``, in rank order, for looking up many pairs."""

    def __init__(self, merges: Sequence[tuple[int, int, int]]):
        left, right, merged = (np.array(c, dtype=np.int64) for c in zip(*merges)) if merges else [np.zeros(0, np.int64)] * 3
        keys = (left << 32) | right
        order = np.argsort(keys, kind="stable")
        self.keys, self.ranks, self.merged = keys[order], order, merged[order]
        self._by_pair: dict[tuple[int, int], tuple[int, int]] | None = None

    def joined(self, left: int, right: int) -> tuple[int, int] | None:
        """Rank and merged code of one pair."""
        if self._by_pair is None:
            pairs = zip((self.keys >> 32).tolist(), (self.keys & 0xFFFFFFFF).tolist())
            made = zip(self.ranks.tolist(), self.merged.tolist())
            # Of a pair that is named twice the first merge counts.
            self._by_pair = dict(reversed(list(zip(pairs, made))))
        return self._by_pair.get((left, right))

    def ranks_of(self, left: np.ndarray, right: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rank and merged code of each pair; the rank is ``_NONE`` for a pair without a merge."""
        if not len(self.keys):
            return np.full(len(left), _NONE), np.zeros(len(left), dtype=np.int64)
        pairs = (left << 32) | right
        at = np.minimum(np.searchsorted(self.keys, pairs), len(self.keys) - 1)
        return np.where(self.keys[at] == pairs, self.ranks[at], _NONE), self.merged[at]


def alternating(chosen: np.ndarray) -> np.ndarray:
    """In each run of neighbouring chosen places keep the first, third, and so on."""
    place = np.arange(len(chosen))
    start = np.maximum.accumulate(np.where(chosen, 0, place + 1))
    return chosen & ((place - start) % 2 == 0)


def merge_words(flat: np.ndarray, lengths: np.ndarray, table: MergeTable) -> tuple[np.ndarray, np.ndarray]:
    """The merged words as flat codes and lengths, in the order given."""
    n_words = len(lengths)
    flat = flat.astype(np.int64)
    owner = np.repeat(np.arange(n_words), lengths)
    finished: list[tuple[np.ndarray, np.ndarray]] = []
    long = np.flatnonzero(lengths > LONG_WORD)
    if len(long):
        ends = np.cumsum(lengths)
        for w in long:
            merged = merge_linked(flat[ends[w] - lengths[w] : ends[w]].tolist(), table.joined)
            finished.append((np.array(merged, dtype=np.int64), np.full(len(merged), w)))
        short = ~np.isin(owner, long)
        flat, owner = flat[short], owner[short]
    while len(flat) > 1:
        rank, merged = table.ranks_of(flat[:-1], flat[1:])
        rank[owner[:-1] != owner[1:]] = _NONE
        best = np.full(n_words, _NONE)
        np.minimum.at(best, owner[:-1], rank)
        chosen = alternating((rank == best[owner[:-1]]) & (rank != _NONE))
        active = best[owner] != _NONE
        if not active.any():
            break
        places = np.flatnonzero(chosen)
        flat[places] = merged[places]
        kept = np.ones(len(flat), dtype=bool)
        kept[places + 1] = False
        inert = kept & ~active
        finished.append((flat[inert], owner[inert]))
        going = kept & active
        flat, owner = flat[going], owner[going]
    finished.append((flat, owner))
    flat = np.concatenate([f for f, _ in finished])
    owner = np.concatenate([o for _, o in finished])
    return flat[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=n_words)
