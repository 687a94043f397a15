import csv
import time

import pandas as pd
import pytest
from pyspark.sql import functions as F

from corpusloom.functions.clock import local_time
from corpusloom.operators import bpe, mapping, positions, profile
from corpusloom.plans.flows import manifest_to_corpus, repair_records
from corpusloom.sources import blobs, files

CELLS = ["line one\nline two", 'say "hi", ok', "plain", None, "a,b", '""']


@pytest.fixture
def quoted_csv(tmp_path):
    path = tmp_path / "q.csv"
    with open(path, "w", newline="") as f:
        out = csv.writer(f)
        out.writerow(["n", "s"])
        out.writerows((i, c) for i, c in enumerate(CELLS))
    return str(path)


def test_csv_reads_as_pandas_does(spark, quoted_csv):
    expected = pd.read_csv(quoted_csv)
    got = files.scan_csv(spark, quoted_csv).toPandas()
    assert got["n"].tolist() == expected["n"].tolist()
    assert got["s"].where(got["s"].notna(), None).tolist() == expected["s"].where(expected["s"].notna(), None).tolist()


def test_positional_join_with_line_breaks_in_cells(spark, tmp_path, quoted_csv):
    (tmp_path / "l.jsonl").write_text("".join(f'{{"i": {i}}}\n' for i in range(len(CELLS))))
    rows = positions.positional_join_files(spark, str(tmp_path / "l.jsonl"), quoted_csv, "n int, s string").orderBy("row_pos")
    import json

    assert [json.loads(r.raw) for r in rows.collect()] == [{"i": i, "n": i, "s": c} for i, c in enumerate(CELLS)]


def test_local_time_does_not_depend_on_the_session_zone(spark):
    times = ["2024-03-09T23:30:00Z", "2024-03-10T07:30:00Z", "2024-11-03T05:30:00Z", "2024-11-03T06:30:00Z", "2015-01-01T00:00:00Z", "2015-07-01T00:00:00Z"]
    expected = ["2024-03-10 02:30:00 +03", "2024-03-10 10:30:00 +03", "2024-11-03 08:30:00 +03", "2024-11-03 09:30:00 +03", "2015-01-01 02:00:00 EET", "2015-07-01 03:00:00 EEST"]
    old = spark.conf.get("spark.sql.session.timeZone")
    try:
        for zone in ("UTC", "America/New_York"):
            spark.conf.set("spark.sql.session.timeZone", zone)
            rows = spark.createDataFrame([(t,) for t in times], "t string").select(local_time(F.col("t")).alias("x")).collect()
            assert [r.x for r in rows] == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", old)


def test_repaired_records_keep_line_order(spark, tmp_path):
    lines = [f'{{"question": "q{i}", "response": "r"}}' for i in range(3000)]
    (tmp_path / "qa.jsonl").write_text("\n".join(lines) + "\n")
    counted = repair_records(spark, str(tmp_path / "qa.jsonl"), str(tmp_path / "out"), fan_out=False)
    assert counted == {"rows": 3000, "failed": 0}
    got = [line for p in sorted((tmp_path / "out").glob("part-*")) for line in p.read_text().splitlines()]
    assert len(got) == 3000
    assert got == sorted(got, key=lambda line: int("".join(c for c in line if c.isdigit())))


def test_passed_columns_follow_the_index(spark):
    df = spark.createDataFrame([(1, "c"), (2, "a"), (3, "b")], "id int, s string").coalesce(1)
    ordered = mapping.map_batches(df, lambda b: b[["s"]].sort_values("s"), "id int, s string")
    assert [tuple(r) for r in ordered.collect()] == [(2, "a"), (3, "b"), (1, "c")]
    some = mapping.map_batches(df, lambda b: b.loc[b["s"] != "a", ["s"]], "id int, s string")
    assert [tuple(r) for r in some.collect()] == [(1, "c"), (3, "b")]
    with pytest.raises(Exception, match="lost the index"):
        mapping.map_batches(df, lambda b: b[["s"]].sort_values("s").reset_index(drop=True), "id int, s string").collect()


def test_a_blob_stored_twice_gives_one_row(spark):
    import gzip

    store = spark.createDataFrame([("a", gzip.compress(b"x", mtime=0)), ("a", gzip.compress(b"x", mtime=0))], "blob_id string, data binary")
    rows = blobs.join_blob_store(spark.createDataFrame([("a",)], "blob_id string"), store).collect()
    assert [(r.blob_id, r.content) for r in rows] == [("a", "x")]


def test_a_slow_id_does_not_hold_up_the_others(spark):
    import gzip

    def fetch(blob_id):
        time.sleep(0.5 if int(blob_id) % 8 == 0 else 0.0)
        return gzip.compress(blob_id.encode())

    ids = spark.createDataFrame([(str(i),) for i in range(64)], "blob_id string")
    start = time.time()
    rows = blobs.hydrate_blobs(ids, fetch, inflight=9, threads=8, partitions=1).collect()
    assert sorted(int(r.content) for r in rows) == list(range(64))
    assert time.time() - start < 4.0


def test_sorted_listing_is_sorted_and_stable(spark):
    df = spark.range(1000).select((F.col("id") % 7).alias("k"), "id")
    rows = [tuple(r) for r in profile.sorted_listing(df, "k").collect()]
    assert rows == sorted(rows, key=lambda r: r[0]) and all(a < b for (k, a), (l, b) in zip(rows, rows[1:]) if k == l)


def test_training_refuses_a_vocabulary_that_cannot_be_loaded(spark):
    with pytest.raises(ValueError, match="vocabulary over"):
        bpe.bpe_train(spark.createDataFrame([("a",)], "content string"), "content", bpe.MAX_VOCAB + 1)


def test_flows_count_their_failures(spark, tmp_path):
    import gzip

    spark.createDataFrame([("a",), ("b",), ("c",)], "blob_id string").write.parquet(str(tmp_path / "m"))

    def fetch(blob_id):
        if blob_id == "b":
            raise OSError("gone")
        return gzip.compress(blob_id.encode())

    quiet = manifest_to_corpus(spark, str(tmp_path / "m"), str(tmp_path / "o1"), fetch, max_retries=1)
    loud = manifest_to_corpus(spark, str(tmp_path / "m"), str(tmp_path / "o2"), fetch, dead_letters=str(tmp_path / "d"), max_retries=1)
    assert quiet == loud == {"rows": 3, "failed": 1}
    (tmp_path / "qa.jsonl").write_text('{"question": "q", "response": "r"}\n{bad\n5\n')
    for dead in (None, str(tmp_path / "dead")):
        assert repair_records(spark, str(tmp_path / "qa.jsonl"), str(tmp_path / "out"), dead) == {"rows": 3, "failed": 2}


def test_lossy_decoding_on_both_paths(spark):
    from corpusloom.functions.blobs import decode_lossy

    values = [b"plain", "çğş😀".encode(), b"a\xffb", b"", None, b"\xe2\x82"]
    rows = spark.createDataFrame([(v,) for v in values], "d binary").select(decode_lossy(F.col("d")).alias("t")).collect()
    assert [r.t for r in rows] == [None if v is None else v.decode("utf-8", "ignore") for v in values]


def test_typed_lines_check_the_kind(spark, tmp_path):
    lines = ['{"s": "x", "n": 5, "d": 1.5, "a": ["y"]}', '{"s": 5, "n": "5", "d": 2}', '{"s": [1], "n": 1.5}', "5", "[1]", '"s"', "null", "{}"]
    (tmp_path / "t.jsonl").write_text("\n".join(lines) + "\n")
    rows = files.scan_jsonl(spark, str(tmp_path / "t.jsonl"), "s string, n bigint, d double, a array<string>").collect()
    assert all(r.is_valid for r in rows)
    got = [None if r.parsed is None else tuple(r.parsed) for r in rows]
    assert got == [("x", 5, 1.5, ["y"]), (None, None, 2.0, None), (None,) * 4, None, None, None, None, (None,) * 4]
