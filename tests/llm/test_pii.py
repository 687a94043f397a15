import hashlib
import random
import re

from corpusloom.llm import pii
from corpusloom.llm.pii import KINDS, pii_summary

PATTERNS = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def base(text):
    out = []
    for kind, pattern in PATTERNS.items():
        for m in re.finditer(pattern, text or ""):
            digits = re.sub("[^0-9]", "", m[0])
            if kind == "ip" and not all(int(p) <= 255 for p in m[0].split(".")):
                continue
            if kind == "card" and not (13 <= len(digits) <= 19 and luhn(digits)):
                continue
            if kind == "phone" and not 9 <= len(digits) <= 15:
                continue
            out.append(f"{kind}:{m.start()}:{m.end()}")
    return out


def test_base_spans_equal_the_patterns_and_stay(spark):
    rng = random.Random(3)
    parts = ["a.b", "@", "c", ".", "4", "1", "0", "12", " ", "-", "+", "(", ")", "é", "😀", "4111 1111 1111 1111", "1.2.3.4", "+1 (366) 555-9807", "x@y.z", "\n", "_", "%", "0000", "255", "999"]
    rows = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(25)))) for i in range(800)]
    rows += [(9000, None), (9001, ""), (9001, ""), (None, "q@w.e"), (9002, "1.2.3.4 " * 2000), (9003, "4111111111111111," * 500)]
    docs = spark.createDataFrame([(i, t, "x") for i, t in rows], "doc_id long, text string, kind string").repartition(4)
    got = pii_summary(docs).collect()
    assert len(got) == len(rows)
    texts = {i: t for i, t in rows}
    for r in got:
        found = base(texts[r.doc_id])
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(s.startswith(k + ":") for s in found) for k in KINDS]
        assert r.base_sha256 == hashlib.sha256(",".join(found).encode()).hexdigest()
        assert set(found) <= set(r.spans.split(","))


def test_runs_that_match_nothing_take_linear_time(spark):
    long = ["1" * 200_000, "a" * 200_000, "1 " * 100_000, "a@b" + ".c" * 50_000, "a@" * 50_000, "+1" * 50_000, "1." * 50_000]
    docs = spark.createDataFrame(list(enumerate(long)), "doc_id long, text string").repartition(4)
    got = {r.doc_id: r for r in pii_summary(docs).collect()}
    assert got[3].n_email == 1 and got[6].n_ip == 12_500 and got[0].spans == ""


def test_empty_table(spark):
    assert pii_summary(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def with_luhn(start):
    return next(start + str(d) for d in range(10) if luhn(start + str(d)))


def planted_rows(n):
    """Base spans, numbers and phrases that are none, and personal data in other notations."""
    rng = random.Random(5)
    number = lambda k: "".join(rng.choice("0123456789") for _ in range(k))
    rows, hidden, ordinary = [], {}, {}
    for i in range(n):
        card = with_luhn("4" + number(14))
        wrong = card[:-1] + str((int(card[-1]) + 1) % 10)
        area, line = number(3), number(4)
        rows += [
            (f"mail jo.{number(2)}@mail{i % 9}.example.com soon", None), (f"card {card} paid", None), (f"call +1 ({area}) 555-{line} now", None),
            (f"look at {'abcdefgh'[i % 8] * 4} (at) noon", None), (f"part {wrong} shipped", None), (f'token = "ab{number(10)}cd" end', None),
        ]
        if i % 10 == 0:
            rows += [("mail jane (at) site (dot) com soon", "hidden"), (f"call {area} 555 {line} now", "hidden"), (f"card {card[:4]}.{card[4:8]}.{card[8:12]}.{card[12:]} paid", "hidden")]
            rows += [(f"part {wrong[:4]}.{wrong[4:8]}.{wrong[8:12]}.{wrong[12:]} shipped", "ordinary"), ("we met (at) noon there", "ordinary"), (f'token = "{"ef"}{number(10)}ab" end', "ordinary")]
    for i, (_, what) in enumerate(rows):
        if what:
            (hidden if what == "hidden" else ordinary)[i] = rows[i][0]
    return [(i, t) for i, (t, _) in enumerate(rows)], hidden, ordinary


def test_obfuscated_spans_are_found_and_ordinary_numbers_left(spark):
    rows, hidden, ordinary = planted_rows(200)
    got = {r.doc_id: r.spans for r in pii_summary(spark.createDataFrame(rows, "doc_id long, text string").repartition(4)).collect()}
    assert sum(not got[i] for i in hidden) == 0, [hidden[i] for i in hidden if not got[i]][:5]
    # A number that passes for a base span by chance stays one.
    assert [(ordinary[i], got[i]) for i in ordinary if got[i] and not base(ordinary[i])] == []


def test_thresholds_cover_rare_kinds_and_copies(spark):
    # A huge group of copies and a common kind leave the rare kinds their own examples and thresholds.
    rows, hidden, ordinary = planted_rows(200)
    rng = random.Random(6)
    more = [f"part 55{rng.randrange(10**12):012d}99 shipped" for _ in range(4_000)] + ["part 4111111111111112 shipped"] * 40_000
    docs = spark.createDataFrame(rows + [(10_000 + i, t) for i, t in enumerate(more)], "doc_id long, text string").repartition(4)
    got = {r.doc_id: r.spans for r in pii_summary(docs).where("doc_id < 10000").collect()}
    assert [hidden[i] for i in hidden if not got[i]] == []
    assert [(ordinary[i], got[i]) for i in ordinary if got[i] and not base(ordinary[i])] == []


def test_small_tables_add_what_a_word_names(spark):
    rows = [(1, "mail jane (at) site (dot) com soon"), (2, "we saw jane (at) site (dot) com there"), (3, "phone 640 555 0953 now"), (4, "code 640 555 0953 now")]
    got = {r.doc_id: r.spans for r in pii_summary(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "email:5:29", 2: "", 3: "phone:6:18", 4: ""}


def test_spans_that_no_better_one_overlaps_all_stay(spark):
    spans = [(1, "phone", 0, 10, "a", 0.9), (1, "card", 8, 24, "b", 0.8), (1, "phone", 20, 30, "c", 0.7), (1, "ip", 29, 35, "d", 0.6), (1, "ip", 35, 40, "e", 0.1), (2, "ip", 0, 4, "f", 0.5)]
    got = pii._apart(spark.createDataFrame(spans, "row long, kind string, start int, end int, match string, score double")).collect()
    assert sorted(r.match for r in got) == ["a", "c", "e", "f"]


def test_every_form_is_proposed(spark):
    rows = [(1, "mail jane at site.com soon"), (2, "phone 0044 20 7946 0958 now"), (3, "phone 640 555 0953 or 12"), (4, "call 2024-05-12 10"), (5, "phone 20 79 46 09 58 now")]
    got = {r.doc_id: r.spans for r in pii_summary(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == {1: "email:5:21", 2: "phone:6:23", 3: "phone:6:18", 4: "", 5: "phone:6:20"}
