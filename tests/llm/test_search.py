import math
import random
import re
from collections import Counter, defaultdict

import numpy as np

import corpusloom.llm.search as module
from corpusloom.llm.search import _Best, _pieces, ranked_search

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return TERM.findall("".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k=10):
    counts = [(i, Counter(terms(t))) for i, t in docs]
    sizes = [sum(c.values()) for _, c in counts]
    n_docs, n_terms = sum(n > 0 for n in sizes), sum(sizes)
    df = Counter(t for _, c in counts for t in c)
    asked = defaultdict(Counter)
    for item, text in set(items):
        asked[item].update(terms(text))
    out = []
    for item, wanted in asked.items():
        found = []
        for (i, c), n in zip(counts, sizes):
            score = 0
            for t, held in wanted.items():
                if t in c:
                    m = 100 - 75 + (75 * n * n_docs) // n_terms
                    w = math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1)))
                    score += held * w * ((1000000000 * c[t]) // (1000 * c[t] + 8 * m))
            if score > 0:
                found.append((-score, i is None, i or 0, i))
        out += [(item, r, f[3], -f[0]) for r, f in enumerate(sorted(found)[:k], 1)]
    return sorted(out, key=str)


def check(spark, docs, items, k=10):
    d = spark.createDataFrame([(i, t, 1) for i, t in docs], "doc_id long, text string, score int").repartition(3)
    q = spark.createDataFrame([(i, t, "x") for i, t in items], "item_id long, text string, `rank` string")
    got = ranked_search(d, q, k)
    assert got.columns == ["item_id", "rank", "doc_id", "score"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(docs, items, k)


def corpus():
    rng = random.Random(4)
    word = lambda: f"w{int(rng.paretovariate(0.7)) % 150}"
    text = lambda most: " ".join(word() for _ in range(rng.randrange(most)))
    docs = [(i, text(80)) for i in range(300)]
    docs += [(1000, None), (1001, ""), (1002, ".,;"), (None, "w1 w2 Éa"), (None, "w1 w2 Éa"), (7, docs[3][1]), (7, docs[3][1])]
    docs += [(1003, "Éa éA W3-w3_w3"), (1004, "w1 rare " * 400000)]
    shared = text(40)
    items = [(i, f"{shared if i % 3 else ''} {text(30)}") for i in range(40)]
    items += [(100, None), (101, ""), (102, "rare Rare RARE unseen"), (103, "w1"), (103, "w1"), (103, "éa"), (None, "w2 w3"), (104, "a" * 50)]
    return docs, items


def test_search_equals_brute_force(spark):
    check(spark, *corpus())


def test_blocks_of_items_and_small_chunks(spark, monkeypatch):
    monkeypatch.setattr(module, "BLOCK_BYTES", 700)
    monkeypatch.setattr(module, "CHUNK", 64)
    monkeypatch.setattr(module, "_CELLS", 300)
    docs, items = corpus()
    check(spark, docs, items, 3)


def test_empty_tables(spark):
    check(spark, [], [(1, "a b")])
    check(spark, [(1, "a b")], [])
    check(spark, [(1, None)], [(1, None)])


def test_pieces_end_between_terms(monkeypatch):
    monkeypatch.setattr(module, "_PIECE_BYTES", 8)
    text = "Ab cdefghijklmnop, é1 x" * 3 + "tail"
    assert [t.decode() for piece in _pieces(text.encode()) for t in piece] == terms(text)
    assert [t for piece in _pieces(b"z" * 30) for t in piece] == [b"z" * 30]


def test_ties_keep_the_smaller_ids():
    best = _Best(2)
    for ids in ([9, 5], [4, 8], [7, 1]):
        best.add(np.array([3, 3]), np.array(ids), np.zeros(2, bool))
    assert best.ids.tolist() == [1, 4]
