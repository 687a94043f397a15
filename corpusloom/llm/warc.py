"""Writing WARC archives from pages and reading them back from any byte range.

Reading takes three steps. Tasks cut their byte ranges at every ``WARC/1.1`` line and emit each cut
as a candidate, with the offset at which the record after it would start. Inside one range the chain
of successors is followed at once, so a candidate also knows where it leaves its range. Pointer
jumping over those exits, doubling each round, finds from offset 0 of every file where its true chain
enters each range; only candidates on that chain are records. A magic line inside a payload is never on it, and the
bytes behind it are given back to the record that they belong to.

Archives are read with Spark's text source alone, cut at the magic, so files of any size are split
and any store works.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import written

MAGIC = "WARC/1.1\r\n"
END = "\r\n\r\n"
# Payloads under so many bytes are never replaced by a reference.
LEAST_REVISIT = 100
# Records of a file at most; archives stay of a size that one task can write again.
FILE_RECORDS = 50_000

# Repeated payloads that are broadcast at most; beyond, pages are joined with them by a shuffle.
BROADCAST_DIGESTS = 100_000

_SEGMENT = (
    "file string, range_start long, start long, size long, next long, exit long, page_id long, type string, "
    "header long, length long, refers_to long, stated_length long, stated_digest string, whole boolean, digest string, body binary"
)

_PIECE = "file string, range_start long, start long, size long, body binary"


def _header(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit("\r\n"))


def _page(page_id: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), page_id.cast("string"), F.lit(">"))


def as_records(pages: DataFrame, page_id: str = "page_id", html: str = "html", url: str | None = "url") -> DataFrame:
    """The ``record`` of every row, without its end mark.

    Of rows with equal payloads of ``LEAST_REVISIT`` bytes or more, those with the smallest
    ``page_id`` are responses and the others revisit it. A null payload is empty. A null ``page_id`` is
    left out of its record, which is a response and is never referred to. Other columns are ignored.
    """
    address = F.lit("")
    if url in pages.columns:
        address = F.coalesce(F.regexp_replace(F.col(f"`{url}`").cast("string"), r"[\r\n]", ""), F.lit(""))
    rows = pages.select(
        F.col(f"`{page_id}`").cast("long").alias("page_id"), address.alias("url"),
        F.coalesce(F.col(f"`{html}`").cast("string"), F.lit("")).alias("payload"),
    ).withColumn("bytes", F.octet_length("payload"))
    digest = F.sha2(F.col("payload").cast("binary"), 256)
    light = rows.where((F.col("bytes") >= LEAST_REVISIT) & F.col("page_id").isNotNull()).select("page_id", digest.alias("digest"))
    several = light.groupBy("digest").agg(F.min("page_id").alias("first"), F.count("*").alias("n")).where("n > 1")
    several = written(several.select("digest", "first"), "repeated-payloads")
    if several.limit(BROADCAST_DIGESTS + 1).count() <= BROADCAST_DIGESTS:
        several = F.broadcast(several)
    revisit = (F.col("bytes") >= LEAST_REVISIT) & (F.col("page_id") > F.col("first"))
    some = lambda condition, text: F.when(condition, text).otherwise(F.lit(""))
    return rows.withColumn("digest", digest).join(several, "digest", "left").select(F.concat(
        F.lit(MAGIC),
        F.when(revisit, _header("WARC-Type", F.lit("revisit"))).otherwise(_header("WARC-Type", F.lit("response"))),
        some(F.col("page_id").isNotNull(), _header("WARC-Record-ID", _page(F.col("page_id")))),
        _header("WARC-Target-URI", F.col("url")),
        _header("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.col("digest"))),
        _header("WARC-Payload-Length", F.col("bytes").cast("string")),
        some(revisit, _header("WARC-Refers-To", _page(F.col("first")))),
        _header("Content-Length", F.when(revisit, "0").otherwise(F.col("bytes").cast("string"))),
        F.lit("\r\n"),
        F.when(revisit, "").otherwise(F.col("payload")),
    ).alias("record"))


def write_warc(pages: DataFrame, path: str, **columns: str) -> None:
    """Archives of the pages under ``path``, at most ``FILE_RECORDS`` records a file."""
    as_records(pages, **columns).write.option("lineSep", END).option("maxRecordsPerFile", FILE_RECORDS).text(path)


_FIELD = re.compile(rb"(?im)^(WARC-Type|WARC-Record-ID|WARC-Refers-To|WARC-Payload-Digest|WARC-Payload-Length|Content-Length):([^\n]*)\r$")
_PAGE = re.compile(rb"<urn:page:(-?[0-9]+)>")


def _parsed(segment: bytes) -> dict | None:
    """The fields of what follows a magic line; None if it is no record header."""
    end = segment.find(b"\r\n\r\n")
    if end < 0:
        return None
    fields = {k.lower(): v.strip(b" \t") for k, v in _FIELD.findall(segment[: end + 2])}
    length, kind = fields.get(b"content-length", b""), fields.get(b"warc-type")
    if kind is None or not length.isdigit() or len(length) > 18:
        return None
    page = lambda name: int(m[1]) if (m := _PAGE.fullmatch(fields.get(name, b""))) else None
    stated = fields.get(b"warc-payload-length", b"")
    return {
        "type": kind.decode("latin-1").lower(), "header": end + 4, "length": int(length), "page_id": page(b"warc-record-id"),
        "refers_to": page(b"warc-refers-to"), "stated_length": int(stated) if stated.isdigit() and len(stated) <= 18 else None,
        "stated_digest": fields.get(b"warc-payload-digest", b"").decode("latin-1").rpartition(":")[2] or None,
    }


def _cutter(bodies: bool):
    """Reads this task's byte ranges cut by cut: the successor of those that look like records, or all their bytes.

    Of a cut that is not a whole record the bytes are kept either way. Offsets count from the first byte of the range's first cut.
    """
    fields = [f.split(" ") for f in (_PIECE if bodies else _SEGMENT).split(", ")]
    kinds = {"string": pa.string(), "long": pa.int64(), "boolean": pa.bool_(), "binary": pa.binary()}

    def packed(rows: list[dict]) -> Iterator[pa.RecordBatch]:
        step = 256 if bodies else 4096
        for i in range(0, len(rows), step):
            part = rows[i : i + step]
            yield pa.RecordBatch.from_arrays([pa.array([r.get(n) for r in part], kinds[t]) for n, t in fields], [n for n, _ in fields])

    def left(rows: list[dict], end: int) -> Iterator[pa.RecordBatch]:
        # From the last cut back: where the chain from each one leaves the range. The next range begins
        # with the magic of its first cut.
        leaves: dict[int, int | None] = {}
        for r in reversed(rows):
            after = r.get("next")
            if after is not None:
                r["exit"] = leaves.get(after, after if after >= end - len(MAGIC) else None)
                leaves[r["start"]] = r["exit"]
        yield from packed(rows)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[dict] = []
        place, end = None, 0
        for batch in batches:
            for value, file, begin in zip(*(c.to_pylist() for c in batch.columns)):
                if (file, begin) != place:
                    yield from left(rows, end)
                    rows, place, end = [], (file, begin), 0
                    # What precedes the first magic of a file is no record.
                    headless = begin == 0
                start = end if headless else end - len(MAGIC)
                row = {"file": file, "range_start": begin, "start": start, "size": len(value), "whole": False}
                found = None if headless or bodies else _parsed(value)
                if found:
                    row |= found
                    ends = found["header"] + found["length"]
                    row["next"] = start + len(MAGIC) + ends + len(END)
                    if value[ends:] == END.encode():
                        row["whole"], row["digest"] = True, hashlib.sha256(value[found["header"] : ends]).hexdigest()
                if not row["whole"] and not headless:
                    row["body"] = value
                rows.append(row)
                headless = False
                end += len(value) + len(MAGIC)
            if bodies:  # nothing looks back at these
                yield from packed(rows)
                rows = []
        yield from left(rows, end)

    return cut


def _walked(group: pd.DataFrame) -> pd.DataFrame:
    """The records on the chain from where it enters a range."""
    after = dict(zip(group["start"], group["next"]))
    at, found = group["entry"].min(), []
    while at in after:
        found.append(at)
        at = after[at]
    return pd.DataFrame({"file": group["file"].iloc[0], "start": pd.Series(found, dtype="int64")})


def _true_starts(segments: DataFrame) -> DataFrame:
    """``file, start`` of the records that the chain from a file's first byte reaches."""
    nodes = segments.where("next is not null").select("file", "range_start", "start", "next", "exit")
    exits = nodes.where("exit is not null").select("file", F.col("exit").alias("start")).distinct()
    first = nodes.where("start = 0").select("file", "start")
    jump = written(nodes.where("exit is not null").join(exits.union(first).distinct(), ["file", "start"]).select("file", "start", "exit"), "jumps")
    reached = written(first, "reached")
    while True:
        step = reached.join(jump, ["file", "start"]).select("file", F.col("exit").alias("start"))
        added = written(step.join(reached, ["file", "start"], "left_anti").distinct(), "reached")
        if added.isEmpty():
            break
        reached = reached.union(added)
        onward = jump.select("file", F.col("start").alias("exit"), F.col("exit").alias("further"))
        # A jump past the last record stays where it is and reaches nothing more.
        jump = written(jump.join(onward, ["file", "exit"]).select("file", "start", F.col("further").alias("exit")), "jumps")
    entries = nodes.join(reached, ["file", "start"]).select("file", "range_start", F.col("start").alias("entry")).distinct()
    return nodes.join(entries, ["file", "range_start"]).groupBy("file", "range_start").applyInPandas(_walked, "file string, start long")


def _scanned(spark: SparkSession, path: str, bodies: bool) -> DataFrame:
    """The cuts of all files with offsets from the start of their file."""
    cuts = spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("value").cast("binary").alias("value"), F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("range_start")
    )
    local = written(cuts.mapInArrow(_cutter(bodies), _PIECE if bodies else _SEGMENT), "warc-cuts")
    extents = local.groupBy("file", "range_start").agg(F.sum(F.col("size") + len(MAGIC)).alias("extent"))
    before = Window.partitionBy("file").orderBy("range_start").rowsBetween(Window.unboundedPreceding, -1)
    bases = extents.select("file", "range_start", F.coalesce(F.sum("extent").over(before), F.lit(0)).alias("base"))
    placed = local.join(bases, ["file", "range_start"])
    for name in ("start",) if bodies else ("start", "next", "exit"):
        placed = placed.withColumn(name, F.col(name) + F.col("base"))
    return placed.drop("base")


@F.pandas_udf(T.StringType())
def _payload_digest(pieces: pd.Series, header: pd.Series, length: pd.Series) -> pd.Series:
    """The digest of a payload put together from its cuts; null if it is not all there."""
    out = []
    for parts, h, n in zip(pieces, header, length):
        text = MAGIC.encode().join(bytes(p["body"]) for p in parts)
        out.append(hashlib.sha256(text[h : h + n]).hexdigest() if text[h + n : h + n + len(END)] == END.encode() else None)
    return pd.Series(out, dtype=object)


def read_warc(spark: SparkSession, path: str) -> DataFrame:
    """``page_id, record_type, payload_bytes, payload_digest, refers_to`` of every record under ``path``.

    Bytes and digest of a response are those of the payload as read; a revisit has no payload, and they
    are those that it states. A file that does not begin with a record has none, and a record that
    the end of its file cuts off is not returned.
    """
    segments = written(_scanned(spark, path, False), "warc-segments")
    records = written(segments.where("next is not null").drop("body").join(_true_starts(segments), ["file", "start"]).drop("range_start", "exit"), "warc-records")
    whole = records.where("whole")
    broken = records.where("not whole")
    if not broken.isEmpty():
        # A payload that holds the magic was cut there: its pieces lie between its record and the next.
        own = broken.select("file", F.col("start").alias("own"), F.col("next"), "header", "length")
        inside = own.join(segments.where("whole").select("file", "start"), "file").where("start > own and start < next")
        # Only a payload that holds a whole record needs bytes that the first scan has not kept.
        pieces = segments if inside.isEmpty() else _scanned(spark, path, True)
        pieces = pieces.where("body is not null").select("file", "start", "body")
        parts = (
            own.join(pieces, "file").where("start >= own and start < next").groupBy("file", "own", "header", "length")
            .agg(F.sort_array(F.collect_list(F.struct("start", "body"))).alias("pieces"))
            .select("file", F.col("own").alias("start"), _payload_digest("pieces", "header", "length").alias("digest"))
        )
        whole = whole.unionByName(broken.drop("digest").join(parts.where("digest is not null"), ["file", "start"]).select(whole.columns))
    revisit = F.col("type") == "revisit"
    return whole.select(
        "page_id",
        F.when(revisit, F.col("stated_length")).otherwise(F.col("length")).alias("payload_bytes"),
        F.when(revisit, F.col("stated_digest")).otherwise(F.col("digest")).alias("payload_digest"),
        F.col("type").alias("record_type"), F.when(revisit, F.col("refers_to")).alias("refers_to"),
    )
