import json

from pyspark.sql import functions as F

from corpusloom.functions.jsontext import object_keys, string_field, to_json_line, update_json, with_parsed
from corpusloom.operators import profile, records
from corpusloom.plans.flows import repair_records
from corpusloom.sources import files, sinks

NBSP, EM, FS, LS = chr(0xA0), chr(0x2003), chr(0x1C), chr(0x2028)
LINES = [
    '{"content":"plain"}',
    '{"content":5}',
    '{"content":null}',
    json.dumps({"content": f" \t{NBSP}{EM}{FS}"}),
    '{"question":"q","response":"r","lang":"en"}',
    '{"question":"q","response":"r","content":"old"}',
    '{"question":"q","response":null}',
    '{"question":"only"}',
    '{"response":"only","content":"kept"}',
    "{}",
    "[1]",
    '["content"]',
    "5",
    '"content"',
    "null",
    "",
    "   ",
    "{bad",
    '{"a":NaN}',
    '{"a":-Infinity,"content":"x"}',
    "{'content':'single'}",
    '{"content":"first","content":"last"}',
    '{"content":"t"} trailing',
    '{"a":1}{"b":2}',
    '{"a":1},{"b":2}',
    '1] x',
    '"x",1',
    f'{NBSP}{{"content":"padded"}}{FS}',
    json.dumps({"content": f"line{LS}sep"}, ensure_ascii=False),
    '{"content":"tab\tinside"}',
    '{"content":"\\u00e7\\u011f"}',
    '{"n":[1,{"x":[]}],"content":"deep"}',
    '{"content":1e400}',
    '{"big":123456789012345678901234567890123456789012345,"content":"c"}',
]


def parsed_or_error(line, nan=True):
    def refuse(name):
        raise ValueError(name)

    try:
        return json.loads(line.strip(), parse_constant=None if nan else refuse), True
    except ValueError:
        return None, False


def lines_frame(spark, lines=LINES):
    return spark.createDataFrame(list(enumerate(lines)), "i int, raw string")


def test_validity_is_pythons(spark):
    for nan in (True, False):
        got = [r.is_valid for r in with_parsed(lines_frame(spark), "raw", nan).orderBy("i").collect()]
        want = [parsed_or_error(s, nan)[1] for s in LINES]
        assert [s for s, a, b in zip(LINES, got, want) if a != b] == []


def test_string_content(spark):
    frame = with_parsed(lines_frame(spark)).orderBy("i")
    got = [r.c for r in frame.select(string_field(F.col("parsed"), "content").alias("c")).collect()]
    want = []
    for line in LINES:
        value, ok = parsed_or_error(line)
        content = value.get("content") if ok and isinstance(value, dict) else None
        want.append(content if isinstance(content, str) else None)
    assert got == want


def test_content_of_lines(spark):
    got = sorted(r.content for r in records.content_of_lines(with_parsed(lines_frame(spark), nan=False)).collect())
    want = []
    for line in LINES:
        value, ok = parsed_or_error(line, nan=False)
        try:
            if ok and "content" in value and value["content"].strip():
                want.append(value["content"])
        except (TypeError, AttributeError):
            continue
    assert got == sorted(want)


def test_content_with_blanks(spark):
    lines = ['{"content":" "}', '{"content":"x"}', '{"content":null}', "{bad"]
    kept = records.content_of_lines(with_parsed(lines_frame(spark, lines)), keep_blank=True)
    assert sorted(r.content for r in kept.collect()) == [" ", "x"]


def test_counts_and_keys(spark):
    scan = with_parsed(lines_frame(spark))
    valid = [parsed_or_error(s)[0] for s in LINES if parsed_or_error(s)[1]]
    row = profile.count_json(scan).first()
    assert (row.n_json, row.n_malformed) == (len(valid), len(LINES) - len(valid))
    objects = [v for v in valid if isinstance(v, dict)]
    keys = [sorted(set(v) - {"content"}) for v in objects]
    got = [sorted(r.extra_keys) for r in profile.extra_keys(scan).collect()]
    assert sorted(got) == sorted(k for k in keys if k)
    counted = {}
    for r in profile.key_profile(scan).collect():
        counted[r.key] = counted.get(r.key, 0) + r.n_rows
    want = {}
    for v in objects:
        for k in v:
            want[k] = want.get(k, 0) + 1
    assert counted == want


def rewritten(lines, fan_out):
    out, bad = [], []
    for line in lines:
        try:
            data = json.loads(line.strip())
            if "question" in data and "response" in data:
                joined = f"{data['question']} {data['response']}"
                rest = {k: v for k, v in data.items() if k not in ("question", "response")}
                made = [{"content": joined}, rest] if fan_out else [{**rest, "content": joined}]
            else:
                made = [data] if not fan_out or "content" in data else []
            out += [json.loads(json.dumps(m)) for m in made]
        except (ValueError, TypeError):
            bad.append(line)
    return out, bad


def as_sorted(values):
    return sorted(json.dumps(v, sort_keys=True) for v in values)


def test_qa_lines(spark):
    for fan_out, fn in ((True, records.qa_fan_out_lines), (False, records.qa_inline_lines)):
        got = [json.loads(r.raw) for r in fn(lines_frame(spark)).collect()]
        assert as_sorted(got) == as_sorted(rewritten(LINES, fan_out)[0])


def test_repair_flow(spark, tmp_path):
    source = tmp_path / "in.jsonl"
    source.write_text("\n".join(LINES) + "\n", encoding="utf-8")
    lines = source.read_text(encoding="utf-8").split("\n")[:-1]
    out, bad = str(tmp_path / "out"), str(tmp_path / "bad")
    repair_records(spark, str(source), out, bad)
    want, dead = rewritten(lines, True)
    assert as_sorted(json.loads(r.raw) for r in files.scan_lines(spark, out).collect()) == as_sorted(want)
    assert sorted(r.raw for r in files.scan_lines(spark, bad).collect()) == sorted(dead)


def test_scan_keeps_bad_lines_and_strict_aborts(spark, tmp_path):
    path = tmp_path / "x.jsonl"
    path.write_bytes('{"content":"a"}\r\n{bad\r{"content":"b","n":7}\n'.encode())
    scan = files.scan_jsonl(spark, str(path), "content string, n int")
    got = {r.raw: (r.is_valid, r.parsed) for r in scan.collect()}
    assert got["{bad"] == (False, None)
    assert tuple(got['{"content":"b","n":7}'][1]) == ("b", 7)
    good, bad = sinks.split_dead_letter(scan)
    assert (good.count(), bad.count()) == (2, 1)
    try:
        files.scan_jsonl_strict(spark, str(path)).collect()
    except Exception as failure:
        assert "malformed JSON line" in str(failure)
    else:
        raise AssertionError("a bad line must abort the strict scan")


def test_typed_records(spark):
    frame = spark.createDataFrame(
        [(1, "q", "r", None), (2, "q", None, "old"), (3, None, None, "c"), (4, None, None, None)],
        "id int, question string, response string, content string",
    )
    inline = {r.id: (r.question, r.response, r.content) for r in records.qa_inline(frame).collect()}
    assert inline == {1: (None, None, "q r"), 2: ("q", None, "old"), 3: (None, None, "c"), 4: (None, None, None)}
    both = F.col("question").isNotNull()
    assert {r.id: r.content for r in records.qa_inline(frame, both).collect()}[2] == "q None"
    fan = sorted(((r.content, r.id) for r in records.qa_fan_out(frame).collect()), key=repr)
    assert fan == sorted([("q r", None), (None, 1), ("old", 2), ("c", 3)], key=repr)


def test_harmonize_and_union(spark):
    a = spark.createDataFrame([("x",)], "promt string")
    b = spark.createDataFrame([("y", "z")], "request string, response string")
    merged = records.harmonize_fields(records.union_corpora(a, b, a), {"prompt": ["promt", "request"]})
    assert sorted((r.prompt, r.response) for r in merged.collect()) == [("x", None), ("x", None), ("y", "z")]
    assert records.drop_fields(merged, "response", "nope").columns == ["prompt"]


def test_object_keys_and_updates(spark):
    frame = with_parsed(lines_frame(spark, ['{"b":1,"a":2}', "[1]"]))
    assert [sorted(r.k) if r.k else r.k for r in frame.orderBy("i").select(object_keys(F.col("parsed")).alias("k")).collect()] == [["a", "b"], None]
    pair = spark.createDataFrame([('{"a":1,"b":2}', '{"b":null,"c":"ç"}'), ('{"a":1}', None)], "x string, y string")
    assert [r.z for r in pair.select(update_json("x", "y").alias("z")).collect()] == ['{"a": 1, "b": null, "c": "ç"}', '{"a": 1}']
    one = spark.createDataFrame([(1, None)], "a int, b string")
    assert one.select(to_json_line("a", "b").alias("j")).first().j == '{"a":1,"b":null}'


def test_filter_content_types(spark):
    frame = spark.createDataFrame([("x",), ("  ",), (None,)], "content string")
    assert [r.content for r in records.filter_content(frame).collect()] == ["x"]
    assert records.filter_content(spark.createDataFrame([(5,)], "content int")).count() == 0
