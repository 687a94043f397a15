import random
import time

import numpy as np

from corpusloom.operators import merging
from corpusloom.operators.merging import MergeTable, merge_linked, merge_words


def one_by_one(word, merges):
    """The textbook loop: the lowest-ranked pair present, all places from the left, again."""
    ranks = {(a, b): r for r, (a, b, _) in enumerate(merges)}
    while True:
        present = [ranks[p] for p in zip(word, word[1:]) if p in ranks]
        if not present:
            return word
        a, b, c = merges[min(present)]
        out, i = [], 0
        while i < len(word):
            if word[i : i + 2] == [a, b]:
                out.append(c)
                i += 2
            else:
                out.append(word[i])
                i += 1
        word = out


def test_matches_the_word_by_word_loop():
    rng = random.Random(5)
    for _ in range(200):
        merges, seen = [], set()
        for new in range(3, 3 + rng.randint(0, 12)):
            pair = (rng.randrange(new), rng.randrange(new))
            if pair not in seen:
                seen.add(pair)
                # Now and then a merge yields a code that exists already.
                merges.append((*pair, rng.randrange(3, new + 1) if rng.random() < 0.2 else new))
        words = [[rng.randrange(3) for _ in range(rng.randint(0, 14))] for _ in range(rng.randint(0, 20))]
        flat = np.array([s for w in words for s in w], dtype=np.int32)
        got, lengths = merge_words(flat, np.array([len(w) for w in words], dtype=np.int64), MergeTable(merges))
        ends = np.concatenate(([0], np.cumsum(lengths)))
        assert [got[a:b].tolist() for a, b in zip(ends, ends[1:])] == [one_by_one(w, merges) for w in words]


def leftmost(word, merges):
    """The lowest-ranked pair, its first place only, again."""
    ranks = {(a, b): (r, c) for r, (a, b, c) in reversed(list(enumerate(merges)))}
    while True:
        places = [(ranks[p][0], i) for i, p in enumerate(zip(word, word[1:])) if p in ranks]
        if not places:
            return word
        i = min(places)[1]
        word = [*word[:i], ranks[word[i], word[i + 1]][1], *word[i + 2 :]]


def test_linked_merging_takes_the_first_of_the_lowest():
    rng = random.Random(8)
    for _ in range(300):
        merges = [(rng.randrange(6), rng.randrange(6), rng.randrange(9)) for _ in range(rng.randint(0, 9))]
        word = [rng.randrange(4) for _ in range(rng.randint(0, 25))]
        assert merge_linked(list(word), MergeTable(merges).joined) == leftmost(word, merges)


def test_long_words_take_the_queue(monkeypatch):
    rng = random.Random(9)
    merges = [(0, 1, 3), (3, 2, 4), (4, 3, 5), (1, 1, 6), (5, 6, 7)]
    words = [[rng.randrange(3) for _ in range(size)] for size in (3, 40, 0, 300, 7, 41, 1)]
    flat, sizes = np.array([s for w in words for s in w]), np.array([len(w) for w in words])
    want = merge_words(flat, sizes, MergeTable(merges))
    monkeypatch.setattr(merging, "LONG_WORD", 10)
    got = merge_words(flat, sizes, MergeTable(merges))
    assert got[0].tolist() == want[0].tolist() and got[1].tolist() == want[1].tolist()


def test_a_very_long_word_is_quick():
    rng = random.Random(10)
    merges, known = [], list(range(30))
    for new in range(30, 3000):
        merges.append((rng.choice(known), rng.choice(known), new))
        known.append(new)
    word = np.array([rng.randrange(30) for _ in range(80_000)])
    start = time.process_time()
    flat, sizes = merge_words(word, np.array([len(word)]), MergeTable(merges))
    assert time.process_time() - start < 3 and sizes[0] == len(flat) < len(word)
