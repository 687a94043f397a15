import random

import numpy as np
import pytest

import corpusloom.llm.minhash as module
from corpusloom.llm.minhash import half_keys, minhash_classes
from test_copies import near_copies, shingles

SCHEMA = "doc_id long, text string, component_id string, `n.x` int"


def brute(rows, width, num, den):
    """Classes of ids; an id with several texts is linked by any of them."""
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t, width)) for i, t in rows if i is not None]
    for k, (a, x) in enumerate(sets):
        for b, y in sets[:k]:
            same = len(x & y)
            if x and y and den * same >= num * len(x | y):
                low, high = sorted((find(a), find(b)))
                parent[high] = low
    out = []
    for i, t in rows:
        s = shingles(t, width)
        root = find(i) if s and i is not None else i
        out.append((i, len(s), root, root == i))
    return sorted(out, key=str)


def check(spark, rows, width=3, num=85, den=100):
    docs = spark.createDataFrame([(i, t, "x", 1) for i, t in rows], SCHEMA)
    got = minhash_classes(docs, width=width, num=num, den=den)
    assert got.columns == ["doc_id", "n_shingles", "component_id", "kept"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows, width, num, den)


@pytest.mark.parametrize("width, num, den", [(3, 85, 100), (5, 9, 10)])
def test_classes_equal_brute_force(spark, width, num, den):
    rows = near_copies(random.Random(width), 25, 5)
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "One two"), (1004, "one TWO"), (1005, "one two x"), (1006, "ÄÖ one"), (1007, "äö one")]
    rows += [(1008, "long " * 30000), (1008, "long " * 30000), (None, "one two"), (None, None), (1009, "y" * 1_100_000 + " z a b c d e f")]
    check(spark, rows, width, num, den)


def test_classes_that_meet_without_linking_are_compared_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK", 5)
    monkeypatch.setattr(module, "_PAIRS", 160)
    rng = random.Random(11)
    rows = []
    for i in range(120):
        words = [f"p{k}" for k in range(90)]
        for _ in range(rng.randrange(1, 6)):
            words[rng.randrange(len(words))] = f"u{rng.randrange(4)}"
        rows.append((i, " ".join(words)))
    classes = {r[2] for r in brute(rows, 3, 85, 100)}
    assert 10 < len(classes) < 110
    check(spark, rows)


def test_an_id_with_two_texts_is_linked_by_both(spark):
    v, w = (" ".join(f"{c}{k}" for k in range(60)) for c in "vw")
    check(spark, [(0, v), (1, v), (1, w), (2, w + " end"), (3, "alone"), (3, "apart")])


def test_empty_table(spark):
    assert minhash_classes(spark.createDataFrame([], SCHEMA)).count() == 0


def test_agreement_follows_similarity():
    rng = np.random.default_rng(5)
    sets = []
    for _ in range(400):
        both, one, two = (np.unique(rng.integers(-(1 << 62), 1 << 62, n)) for n in (160, 20, 20))
        sets += [np.union1d(both, one), np.union1d(both, two)]
    keys = half_keys(sets)
    agree = (keys[::2] == keys[1::2]).mean()
    assert abs(agree - (160 / 200) ** module.DEPTH) < 0.02
