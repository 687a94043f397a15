import gzip
import sys
import time

import pytest
from pyspark import cloudpickle
from pyspark.sql import functions as F

from corpusloom.functions.blobs import decode_as, decode_lossy, gunzip
from corpusloom.operators.joins import left_join_unique
from corpusloom.plans.flows import manifest_to_corpus
from corpusloom.sources import blobs, catalog, files, sinks

cloudpickle.register_pickle_by_value(sys.modules[__name__])

ENDS = "a\nb\rc\r\nd\x0be\x0cf\x1cg\x1dh\x1ei\x85j" + chr(0x2028) + "k" + chr(0x2029) + "l\n"
TEXTS = {
    "good": "  merhaba\n",
    "empty": "",
    "blank": " \t" + chr(0xA0),
    "ends": ENDS,
    "third": "after two failures",
}


def packed(blob_id):
    return gzip.compress(TEXTS[blob_id].encode())


class Flaky:
    """Fails on chosen ids; keeps the waits it was asked for."""

    def __init__(self):
        self.calls = {}

    def __call__(self, blob_id):
        n = self.calls[blob_id] = self.calls.get(blob_id, 0) + 1
        if blob_id == "gone":
            raise FileNotFoundError(blob_id)
        if blob_id == "third" and n < 3:
            raise TimeoutError("busy")
        if blob_id == "plain":
            return b"not gzip"
        if blob_id == "bytes":
            return gzip.compress(b"ok \xff\xfe end")
        return packed(blob_id)


IDS = [*TEXTS, "gone", "plain", "bytes"]


def manifest(spark, ids=IDS):
    return spark.createDataFrame([(i, "utf-8") for i in ids], "blob_id string, src_encoding string")


def test_hydrate(spark):
    got = {
        r.blob_id: r
        for r in blobs.hydrate_blobs(manifest(spark), Flaky(), max_retries=4, partitions=2, sleep=lambda s: None).collect()
    }
    assert len(got) == len(IDS)
    assert got["good"].content == TEXTS["good"] and got["good"].attempts == 1
    assert (got["third"].content, got["third"].attempts) == (TEXTS["third"], 3)
    assert got["gone"].content is None and got["gone"].attempts == 4
    assert got["gone"].error == "FileNotFoundError: gone"
    assert got["plain"].content is None and "BadGzipFile" in got["plain"].error
    assert got["bytes"].content == "ok  end"
    strict = blobs.hydrate_blobs(manifest(spark, ["bytes"]), Flaky(), max_retries=1, errors="strict").first()
    assert strict.content is None and "UnicodeDecodeError" in strict.error


def test_backoff_grows():
    waits = [blobs.backoff_seconds(n) for n in range(5)]
    assert all(2**n <= w < 2**n + 1 for n, w in enumerate(waits))


def test_at_most_inflight_at_once(spark):
    running, most = [], [0]

    def fetch(blob_id):
        running.append(blob_id)
        most[0] = max(most[0], len(running))
        time.sleep(0.005)
        running.remove(blob_id)
        return gzip.compress(str(most[0]).encode())

    ids = [str(i) for i in range(50)]
    rows = blobs.hydrate_blobs(manifest(spark, ids), fetch, inflight=2, threads=8, partitions=1).collect()
    assert max(int(r.content) for r in rows) == 2


def test_a_killed_run_fetches_only_open_ids_again(spark, tmp_path):
    ids, log, alive = [str(i) for i in range(60)], tmp_path / "log", tmp_path / "alive"
    ledger = str(tmp_path / "ledger")

    def fetch(blob_id):
        class Killed(BaseException):
            pass

        if blob_id == "31" and not alive.exists():
            raise Killed
        with open(log, "a") as out:
            out.write(blob_id + "\n")
        if blob_id == "7":
            raise FileNotFoundError(blob_id)
        return gzip.compress(blob_id.encode())

    frame = manifest(spark, [*ids, *ids[:20], None])
    run = lambda: blobs.hydrate_resumable(frame, fetch, ledger, ids_per_block=10, max_retries=1, sleep=lambda s: None)
    with pytest.raises(Exception):
        run()
    kept = {r.blob_id for r in blobs.fetched(spark, ledger).where("error is null").collect()}
    assert len(kept) < 60
    log.write_text("")
    alive.touch()
    got = {r.blob_id: (r.content, r.error) for r in run().collect()}
    assert sorted(log.read_text().split()) == sorted(set(ids) - kept)
    assert got == {i: (i, None) if i != "7" else (None, "FileNotFoundError: 7") for i in ids}
    # Only what had failed is tried again, and its id still has one row.
    log.write_text("")
    assert run().count() == 60 and log.read_text().split() == ["7"]


def test_no_ids_to_fetch(spark, tmp_path):
    rows = blobs.hydrate_resumable(manifest(spark, []), Flaky(), str(tmp_path / "ledger"))
    assert rows.count() == 0 and rows.columns == ["blob_id", "content", "attempts", "error"]
    with pytest.raises(ValueError):
        blobs.hydrate_resumable(manifest(spark, []), Flaky(), str(tmp_path / "ledger"), per_second=0)


def test_pace_of_each_lane():
    waits = []
    pace = blobs.Pace(0.5, waits.append, clock=lambda: 10.0)
    for lane in "aabab":
        pace.wait(lane)
    assert waits == [0.5, 1.0, 0.5]


def store_files(tmp_path):
    folder = tmp_path / "store"
    folder.mkdir()
    for name in TEXTS:
        (folder / f"{name}.gz").write_bytes(packed(name))
    (folder / "plain.gz").write_bytes(b"not gzip")
    (folder / "bytes.gz").write_bytes(gzip.compress(b"ok \xff\xfe end"))
    (folder / "unused.gz").write_bytes(gzip.compress(b"unused"))
    return str(folder)


def test_join_store(spark, tmp_path):
    store = blobs.scan_blob_store(spark, store_files(tmp_path))
    rows = blobs.join_blob_store(manifest(spark, [*IDS, "good", "good"]), store).collect()
    assert len(rows) == len(IDS) + 2
    got = {r.blob_id: (r.content, r.error) for r in rows}
    assert got["good"] == (TEXTS["good"], None)
    assert got["gone"] == (None, "missing")
    assert got["plain"] == (None, "unreadable")
    assert got["bytes"] == ("ok  end", None)
    strict = blobs.join_blob_store(manifest(spark, ["bytes", "good"]), store, charset="src_encoding")
    assert {r.blob_id: r.error for r in strict.collect()} == {"bytes": "unreadable", "good": None}


def test_hot_key_is_split(spark):
    left = spark.range(1000).select(
        F.when(F.col("id") < 600, "hot").when(F.col("id") < 800, F.lit(None)).otherwise(F.col("id").cast("string")).alias("k"),
        "id",
    )
    right = spark.createDataFrame([("hot", 1), ("900", 2), ("none", 3)], "k string, v int")
    want = sorted((r.id, r.k, r.v) for r in left.join(right, "k", "left").select("id", "k", "v").collect())
    for limit in (50, 10_000):
        got = left_join_unique(left, right, "k", hot_rows=limit)
        assert sorted((r.id, r.k, r.v) for r in got.collect()) == want
    assert got.columns == ["k", "id", "v"]


def test_decoding(spark):
    turkish = "çğış ÖÜ"
    data = [
        (0, gzip.compress(b"x"), "utf-8"),
        (1, b"plain", "utf-8"),
        (2, turkish.encode("windows-1254"), "windows-1254"),
        (3, b"\xff", "utf-8"),
        (4, b"x", "no-such"),
        (5, None, "utf-8"),
        (6, b"x", None),
    ]
    frame = spark.createDataFrame(data, "i int, data binary, charset string").orderBy("i")
    assert [r.o for r in frame.select(decode_as(F.col("data"), F.col("charset")).alias("o")).collect()][1:] == [
        "plain", turkish, None, None, None, None,
    ]
    unpacked = [r.o for r in frame.select(gunzip(F.col("data")).alias("o")).collect()]
    assert bytes(unpacked[0]) == b"x" and unpacked[1] is None
    assert [r.o for r in frame.select(decode_lossy(F.col("data")).alias("o")).collect()][3] == ""


def test_manifest_to_corpus(spark, tmp_path):
    ids = str(tmp_path / "manifest")
    manifest(spark).repartition(2).write.parquet(ids)
    out, bad = str(tmp_path / "corpus"), str(tmp_path / "bad")
    manifest_to_corpus(spark, ids, out, fetcher=Flaky(), dead_letters=bad, max_retries=3, sleep=lambda s: None)
    got = sorted(r.content for r in spark.read.json(out).collect())
    assert got == sorted([TEXTS["good"].strip(), ENDS.strip(), TEXTS["third"], "ok  end"])
    assert {r.blob_id for r in spark.read.parquet(bad).collect()} == {"gone", "plain"}
    text = str(tmp_path / "text")
    manifest_to_corpus(spark, ids, text, store=store_files(tmp_path), as_text=True)
    lines = sorted(r.content for r in files.scan_text_corpus(spark, text).collect())
    assert lines == sorted(["merhaba", " ".join(ENDS.splitlines()).strip(), TEXTS["third"], "ok  end"])


def test_manifest_scan_reads_one_column(spark, tmp_path):
    manifest(spark).write.parquet(str(tmp_path / "m"))
    plan = files.scan_manifest(spark, str(tmp_path / "m"))._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<blob_id:string>" in plan


def test_listing(spark, tmp_path):
    for name in ("b.parquet", "a.parquet", "x.txt", "pre-c.parquet"):
        (tmp_path / name).write_bytes(b"12345")
    assert [r.name for r in files.list_inputs(spark, str(tmp_path)).collect()] == ["a.parquet", "b.parquet", "pre-c.parquet"]
    assert [r.name for r in files.list_inputs(spark, str(tmp_path), "pre-").collect()] == ["pre-c.parquet"]
    total = files.count_inputs(spark, str(tmp_path)).first()
    assert (total.n_files, total.n_bytes) == (3, 15)


def test_catalog(spark):
    rows = [
        ("1", "a", "2024-01-01T00:00:00Z", True),
        ("2", None, "broken", False),
        ("3", "c", None, None),
        ("4", "d", "2024-02-01T00:00:00Z", True),
    ]
    listing = spark.createDataFrame(rows, "id string, name string, modifiedTime string, shared boolean")
    got = [tuple(r) for r in catalog.list_catalog(listing).collect()]
    assert got == [
        ("1", "a", "E", "2024-01-01 03:00:00 +03"),
        ("2", "", "H", "broken"),
        ("3", "c", "H", ""),
        ("4", "d", "E", "2024-02-01 03:00:00 +03"),
    ]
    assert [r.id for r in catalog.list_catalog(listing, shared_only=True).collect()] == ["1", "4"]
    assert [r.id for r in catalog.list_catalog(listing, page_size=2).collect()] == ["1", "2"]


def test_sinks(spark, tmp_path):
    path = str(tmp_path / "out")
    frame = spark.createDataFrame([("ç", None), ("b", 2)], "content string, n int")
    sinks.write_jsonl(frame.coalesce(1), path, max_rows=1)
    assert len(list((tmp_path / "out").glob("part-*"))) == 2
    raw = sorted(r.raw for r in files.scan_lines(spark, path).collect())
    assert raw == ['{"content":"b","n":2}', '{"content":"ç","n":null}']
    assert sinks.output_exists(spark, path) and not sinks.output_exists(spark, path + "-no")
    sinks.write_jsonl(frame.limit(1), path, mode="ignore")
    assert files.scan_lines(spark, path).count() == 2
    sinks.write_jsonl(frame.where("n = 2"), path, mode="overwrite", nulls=False)
    assert [r.raw for r in files.scan_lines(spark, path).collect()] == ['{"content":"b","n":2}']


def test_csv_and_tokens(spark, tmp_path):
    (tmp_path / "t.csv").write_text("n,x,s\n1,1.5,a\n2,,NA\n")
    got = [tuple(r) for r in files.scan_csv(spark, str(tmp_path / "t.csv")).collect()]
    assert got == [(1, 1.5, "a"), (2, None, "NA")]
    (tmp_path / "t.jsonl").write_text('{"input_ids": [1, 2]}\n{"input_ids": []}\n')
    assert [r.input_ids for r in files.scan_tokens(spark, str(tmp_path / "t.jsonl")).collect()] == [[1, 2], []]


def test_blobs_are_chosen_before_they_are_grouped(spark, tmp_path):
    store = blobs.scan_blob_store(spark, store_files(tmp_path))
    plan = blobs.join_blob_store(manifest(spark, ["good"]), store)._jdf.queryExecution().optimizedPlan().toString()
    # Read from the top: the grouping of blobs, and the choice below it.
    assert "LeftSemi" in plan[plan.index("min(data"):]


def test_stats_of_input_files(spark, tmp_path):
    (tmp_path / "in" / "k=1").mkdir(parents=True)
    (tmp_path / "in" / "a b.txt").write_bytes("one\ntwo\r\nthr\u00e9e".encode())
    (tmp_path / "in" / "k=1" / "c.txt").write_bytes(b"x\n")
    (tmp_path / "in" / "empty.txt").write_bytes(b"")
    got = {r.path.rsplit("/", 1)[1].replace("%20", " "): (r.n_bytes, r.n_lines) for r in files.input_stats(spark, str(tmp_path / "in")).collect()}
    assert got == {"a b.txt": (15, 3), "c.txt": (2, 1)}


def test_decode_on_the_jvm_is_what_python_decodes(spark):
    values = [b"plain", "\u00e4\u6f22".encode(), b"\xff\xfe", b"\x80", b"", None]
    charsets = ["utf-8", "UTF8", "ascii", "US-ASCII", "latin-1", "ISO-8859-1", " utf-8", "cp1254", "nope", None]
    rows = [(v, c) for v in values for c in charsets]

    def wanted(v, c):
        try:
            return None if v is None or c is None else v.decode(c.strip())
        except (UnicodeError, LookupError):
            return None

    frame = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "i int, data binary, charset string")
    got = frame.select("i", decode_as(F.col("data"), F.col("charset")).alias("o")).orderBy("i").collect()
    assert [r.o for r in got] == [wanted(*r) for r in rows]
