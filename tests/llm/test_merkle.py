import hashlib
import zlib
from collections import defaultdict

from corpusloom.llm.merkle import merkle_manifest, tamper_report

COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, `path` int, `own.group` string"


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, lower=False):
    out = ""
    for name, v in zip(COLUMNS, row):
        if lower and name == "text" and v is not None:
            v = "".join(c.lower() if "A" <= c <= "Z" else c for c in v)
        out += "-" if v is None else f"{len(str(v).encode())}:{v}"
    return H(out)


def climb(nodes):
    """The root, and for each node the pairs of siblings on its way up."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, a in enumerate(at):
            run, j = nodes[a // 16 * 16 : a // 16 * 16 + 16], a % 16
            paths[i].append(("".join(run[:j]), "".join(run[j + 1 :])))
        at = [a // 16 for a in at]
        nodes = [H(*nodes[i : i + 16]) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def brute(rows):
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append(row)
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    subroots, below = [], []
    for s in order:
        members = sorted(groups[s], key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        root, paths = climb([leaf(r) for r in members])
        subroots.append(root)
        below.append((members, paths))
    root, above = climb(subroots)
    out = []
    for (members, paths), subroot, up in zip(below, subroots, above):
        for row, path in zip(members, paths):
            own = leaf(row)
            chosen = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 5 == 0
            h = leaf(row, True) if chosen else own
            for left, right in path + up:
                h = H(left, h, right)
            out.append((row[0], own, subroot, root, H(*[x for run in path + up for x in run]), h, h == root))
    return sorted(out, key=str)


def check(spark, rows):
    docs = spark.createDataFrame([(*r, 1, "x") for r in rows], SCHEMA)
    got = tamper_report(docs)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=str) == brute(rows)


def test_report_equals_brute_force(spark):
    rows = [(i, "hot", "en", i, f"Text {i}") for i in range(300)]
    rows += [(i, f"s{i % 18}", None, None, "Äpfel UND Birnen") for i in range(1000, 1040)]
    rows += [(7, None, "de", 3, None), (None, None, None, None, None), (None, "é", "x", 1, ""), (-12, "z", "en", 0, "Ab" * 40000)]
    rows += [(5, "twice", "en", 1, "SAME"), (5, "twice", "en", 1, "SAME"), (5, "twice", "en", 2, "other"), (9, "", "", 0, "")]
    assert any(r[-1] for r in brute(rows)) and not all(r[-1] for r in brute(rows))
    check(spark, rows)


def test_one_row_and_no_row(spark):
    check(spark, [(3, "only", "en", 4, "Text")])
    empty = spark.createDataFrame([], SCHEMA)
    assert tamper_report(empty).count() == 0


def test_runs_of_sixteen_and_one(spark):
    check(spark, [(i, "a" if i < 17 else "b", "en", 1, f"T{i}") for i in range(33)])


def test_other_fields_and_groups(spark):
    rows = spark.createDataFrame([(i, i % 2, f"v{i}") for i in range(5)], "`k.k` int, g int, v string")
    found = merkle_manifest(rows, fields=("v",), group="g", order="k.k").collect()
    assert {r["leaf"] for r in found} == {H(f"2:v{i}") for i in range(5)}
    assert len({r["root"] for r in found}) == 1 and {len(r["path"]) for r in found} == {2}
