import importlib
import random

import pytest

from corpusloom.llm.exact_dedup import exact_dedup, exact_groups
from corpusloom.llm.graph import connected_components
from corpusloom.llm.ngram_join import ngram_jaccard


def shingles(text, width):
    words = (text or "").encode().lower().split()
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i : i + width]) for i in range(len(words) - width + 1))


def brute(rows, width, num, den):
    sets = {i: shingles(t, width) for i, t in rows if i is not None}
    parent = {i: i for i in sets}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(sets)
    for n, a in enumerate(ids):
        for b in ids[:n]:
            same = len(sets[a] & sets[b])
            if sets[a] and sets[b] and den * same >= num * len(sets[a] | sets[b]):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return sorted(((i, len(shingles(t, width)), find(i) if i is not None else None) for i, t in rows), key=str)


def near_copies(rng, groups, most_edits):
    rows = []
    for _ in range(groups):
        base = [f"w{rng.randrange(400)}" for _ in range(rng.randrange(4, 90))]
        for _ in range(rng.randrange(1, 9)):
            words = list(base)
            for _ in range(rng.randrange(most_edits)):
                words[rng.randrange(len(words))] = f"x{rng.randrange(10**6)}"
            rows.append((len(rows), rng.choice([" ", "\n", "\t "]).join(words)))
    return rows


@pytest.mark.parametrize("width, num, den", [(4, 85, 100), (5, 4, 5), (1, 1, 2)])
def test_classes_equal_brute_force(spark, width, num, den):
    rows = near_copies(random.Random(width), 25, 5)
    rows += [(1000, None), (1001, ""), (1002, " \n "), (1003, "One two"), (1004, "one TWO"), (1005, "one two"), (1006, "ÄÖ one"), (1007, "äö one")]
    rows += [(1008, "long " * 30000), (1008, "long " * 30000), (None, "one two"), (1009, "y" * 1_100_000 + " z a b c d e f")]
    docs = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, component long")
    got = sorted((tuple(r) for r in ngram_jaccard(docs, width=width, num=num, den=den).collect()), key=str)
    assert got == brute(rows, width, num, den)


def test_long_posting_lists_are_compared_in_blocks(spark, monkeypatch):
    import corpusloom.llm.ngram_join as module

    monkeypatch.setattr(module, "SHORT_LIST", 4)
    monkeypatch.setattr(module, "BLOCK", 5)
    rng = random.Random(11)
    passage = " ".join(f"p{i}" for i in range(120))
    rows = []
    for i in range(60):
        words = passage.split()
        for _ in range(rng.randrange(1, 5)):
            words[rng.randrange(len(words))] = f"u{rng.randrange(5)}"
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted((tuple(r) for r in ngram_jaccard(docs, width=4, num=85, den=100).collect()), key=str)
    assert got == brute(rows, 4, 85, 100)
    assert 5 < len({r[2] for r in got}) < 55


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert ngram_jaccard(docs).count() == 0
    assert exact_groups(docs).count() == 0
    assert exact_dedup(docs).count() == 0


def test_components_of_a_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 130)]
    got = {tuple(r) for r in connected_components(spark.createDataFrame(links, "a long, b long")).collect()}
    assert got == {(i, 0) for i in range(41)} | {(i, 100) for i in range(100, 130)}


def test_exact_groups_and_dedup(spark):
    rows = [(1, None, "x", "a"), (1, None, "x", "a"), (2, "", "y", "q"), (None, "z", "y", "q"), (None, "z", "y", "r"), (5, "k ", "1", "2"), (6, "k", "1", "2")]
    rows += [(100 + i, "hot", "s", "t") for i in range(300)] + [(399, "hot", "s", "t")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, `best x` string, `text_sha256` string")
    groups = exact_groups(docs).collect()
    assert len(groups) == len(rows)
    kept = {(r.doc_id, r.keep_id, r.group_size) for r in groups if r.kept}
    assert kept == {(2, 2, 3), (None, None, 2), (5, 5, 1), (6, 6, 1), (399, 399, 301)}
    assert sum(r.kept for r in groups) == 5
    stay = exact_dedup(docs)
    assert stay.columns == docs.columns
    assert sorted((r.doc_id or 0, r.text) for r in stay.collect()) == [(0, "z"), (2, ""), (5, "k "), (6, "k"), (399, "hot")]


def test_texts_move_only_where_many_digests_repeat(spark, monkeypatch):
    module = importlib.import_module("corpusloom.llm.exact_dedup")
    setting = "spark.sql.autoBroadcastJoinThreshold"
    rows = [(i, f"text {i // 2}" if i < 40 else f"single {i}", i % 3) for i in range(60)] + [(1, "text 0", 7), (None, "single 50", 1), (70, None, 2), (71, "", 2)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, extra int")
    kept = []
    spark.conf.set(setting, "-1")
    try:
        for most in (module.BROADCAST_WINNERS, 0):
            monkeypatch.setattr(module, "BROADCAST_WINNERS", most)
            left = exact_dedup(docs)
            kept.append((sorted(map(tuple, left.collect()), key=str), left._jdf.queryExecution().executedPlan().toString()))
    finally:
        spark.conf.unset(setting)
    assert kept[0][0] == kept[1][0]
    assert {r[0] for r in kept[0][0]} == {*range(1, 40, 2), *range(40, 60), 71}
    assert "SortMergeJoin" not in kept[0][1] and "SortMergeJoin" in kept[1][1]
