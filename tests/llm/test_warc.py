import hashlib

import pytest

from corpusloom.llm.warc import END, MAGIC, read_warc, write_warc
from corpusloom.session import scratch_path

RECORD = MAGIC + "WARC-Type: response\r\nWARC-Record-ID: <urn:page:77>\r\nContent-Length: 3\r\n\r\nabc" + END
PAGES = [
    (1, "x" * 200, "u"), (2, "x" * 200, "u"), (2, "x" * 200, "u"), (1, "x" * 200, "u"), (3, None, "u"), (4, "small", "u"), (5, "small", "u"),
    (6, "a" + RECORD + "b" * 50 + RECORD, "u"), (7, RECORD * 40, "q"), (12, RECORD * 40, "v"), (8, MAGIC * 300, "u"), (13, "a" + MAGIC, "u"),
    (14, MAGIC + "WARC", ""), (None, "z" * 300, "n"), (None, "z" * 300, "n"), (9, "z" * 300, "u\r\nX: y"), (10, END * 100, None), (11, "é" * 5000, "k"),
]


def expected(rows):
    first = {}
    for i, html, _ in rows:
        if i is not None and len((html or "").encode()) >= 100:
            first[html] = min(first.get(html, i), i)
    out = []
    for i, html, _ in rows:
        payload = (html or "").encode()
        again = i is not None and html in first and i > first[html]
        out.append((i, len(payload), hashlib.sha256(payload).hexdigest(), "revisit" if again else "response", first[html] if again else None))
    return sorted(out, key=str)


@pytest.mark.parametrize("files, piece", [(1, 1500), (3, 400), (1, 1 << 20)])
def test_round_trip_over_any_byte_ranges(spark, files, piece):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        pages = spark.createDataFrame([(*r, 1) for r in PAGES], "page_id long, html string, url string, digest int").coalesce(files)
        path = scratch_path(spark, "warc-test")
        write_warc(pages, path)
        assert sorted((tuple(r) for r in read_warc(spark, path).collect()), key=str) == expected(PAGES)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)


def test_cut_and_foreign_files(spark):
    path = scratch_path(spark, "warc-test")
    whole = RECORD.replace("77", "1") + RECORD.replace("77", "2")
    spark.createDataFrame([(whole[:-6],)], "record string").write.option("lineSep", "\n").text(f"{path}/a")
    spark.createDataFrame([("junk " + whole,)], "record string").write.option("lineSep", "\n").text(f"{path}/b")
    assert [r.page_id for r in read_warc(spark, f"{path}/a").collect()] == [1]
    assert read_warc(spark, f"{path}/b").count() == 0


def test_no_pages(spark):
    path = scratch_path(spark, "warc-test")
    write_warc(spark.createDataFrame([], "page_id long, html string"), path)
    assert read_warc(spark, path).count() == 0


@pytest.mark.parametrize("piece", [50_000, 1 << 24])
def test_long_urls_keep_their_page_and_the_rest_of_the_file(spark, piece):
    old = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", piece)
    spark.conf.set("spark.sql.files.openCostInBytes", 0)
    try:
        rows = [(1, "first", "u"), (2, "a" * 150, "http://h/" + "q" * 400_000), (3, "b" * 300_000, "k" * 70_000), (4, "a" * 150, "é \t" * 100_000), (5, None, "u")]
        path = scratch_path(spark, "warc-test")
        write_warc(spark.createDataFrame(rows, "page_id long, html string, url string").coalesce(1), path)
        assert sorted((tuple(r) for r in read_warc(spark, path).select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str) == expected(rows)
    finally:
        for k, v in old.items():
            spark.conf.set(k, v)
