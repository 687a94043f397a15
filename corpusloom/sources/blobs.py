"""From blob ids to contents: remote fetch per id, or a join with a blob store."""

from __future__ import annotations

import gzip
import random
import threading
import time
import urllib.request
from collections.abc import Callable, Iterator
from concurrent.futures import FIRST_COMPLETED, ThreadPoolExecutor, wait

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.blobs import unpack_text
from corpusloom.operators.joins import left_join_unique
from corpusloom.session import estimated_bytes, scratch_path, written

# A megabyte of blob ids is some twenty thousand fetches.
_MANIFEST_BYTES_PER_TASK = 1024 * 1024
_IDS_PER_TASK = 20_000
HYDRATED_SCHEMA = "blob_id string, content string, attempts int, error string"


def url_fetcher(template: str, timeout: float = 10.0) -> Callable[[str], bytes]:
    """A fetcher that reads ``template.format(blob_id)`` over HTTP."""

    def fetch(blob_id: str) -> bytes:
        with urllib.request.urlopen(template.format(blob_id), timeout=timeout) as response:
            return response.read()

    return fetch


def backoff_seconds(attempt: int) -> float:
    return 2**attempt + random.random()


def _fetch_one(blob_id, fetcher, max_retries, errors, sleep):
    error = None
    for attempt in range(max_retries):
        try:
            return blob_id, gzip.decompress(fetcher(blob_id)).decode("utf-8", errors), attempt + 1, None
        except Exception as failure:  # any failure of one id is retried, then reported in its row
            error = f"{type(failure).__name__}: {failure}"
            if attempt + 1 < max_retries:
                sleep(backoff_seconds(attempt))
    return blob_id, None, max_retries, error


class Pace:
    """Starts of fetches, at least ``seconds`` apart for every lane."""

    def __init__(self, seconds: float, sleep: Callable[[float], None], clock: Callable[[], float] = time.monotonic):
        self.seconds, self.sleep, self.clock = seconds, sleep, clock
        self.free: dict[str, float] = {}
        self.lock = threading.Lock()

    def wait(self, lane: str) -> None:
        with self.lock:
            now = self.clock()
            start = max(now, self.free.get(lane, now))
            self.free[lane] = start + self.seconds
        if start > now:
            self.sleep(start - now)


def _fetch_all(fetcher, max_retries, inflight, threads, errors, sleep, seconds_apart=0.0):
    """A function from batches of ``blob_id, lane`` to batches of fetched rows."""

    def fetch_batches(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        pace = Pace(seconds_apart, sleep)

        def one(blob_id, lane):
            def paced(name):
                pace.wait(lane)
                return fetcher(name)

            return _fetch_one(blob_id, paced if seconds_apart else fetcher, max_retries, errors, sleep)

        columns = ["blob_id", "content", "attempts", "error"]
        with ThreadPoolExecutor(max_workers=threads) as pool:
            waiting: set = set()
            for blob_id, lane in (pair for batch in batches for pair in zip(batch["blob_id"].tolist(), batch["lane"].tolist())):
                # A finished id makes room for the next one; a slow id holds up nothing else.
                if len(waiting) >= inflight:
                    done, waiting = wait(waiting, return_when=FIRST_COMPLETED)
                    yield pd.DataFrame([f.result() for f in done], columns=columns)
                waiting.add(pool.submit(one, blob_id, lane))
            while waiting:
                done, waiting = wait(waiting, return_when=FIRST_COMPLETED)
                yield pd.DataFrame([f.result() for f in done], columns=columns)

    return fetch_batches


def hydrate_blobs(
    manifest: DataFrame,
    fetcher: Callable[[str], bytes],
    max_retries: int = 5,
    inflight: int = 256,
    threads: int = 32,
    errors: str = "ignore",
    partitions: int | None = None,
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """Fetch, gunzip and decode every id; a failed id keeps its row with null content and an error.

    Threads overlap the waits inside a task, at most ``inflight`` ids at a time. Ids are spread
    round-robin over ``partitions`` tasks, by default about one per megabyte of manifest, so no id
    or source can crowd one task and a lost task repeats little. A retried task fetches again; the
    fetcher must be safe to repeat.
    """
    ids = manifest.select("blob_id", F.lit("").alias("lane"))
    if partitions is None:
        cores = manifest.sparkSession.sparkContext.defaultParallelism
        partitions = max(cores, (estimated_bytes(ids) or 0) // _MANIFEST_BYTES_PER_TASK)
    work = _fetch_all(fetcher, max_retries, inflight, threads, errors, sleep)
    return ids.repartition(partitions).mapInPandas(work, HYDRATED_SCHEMA)


def _finished(spark, ledger: str) -> DataFrame:
    """The rows a ledger holds; none before the first block is written."""
    path = spark._jvm.org.apache.hadoop.fs.Path(ledger)
    if path.getFileSystem(spark._jsc.hadoopConfiguration()).exists(path):
        return spark.read.schema(HYDRATED_SCHEMA).parquet(ledger)
    return spark.createDataFrame([], HYDRATED_SCHEMA)


def fetched(spark, ledger: str) -> DataFrame:
    """One row for each id of a ledger: its content, or the error of the try that took most attempts.

    A content is written once and never moved here; only the ids are compared.
    """
    rows = _finished(spark, ledger)
    got = rows.where(F.col("error").isNull())
    failed = rows.where(F.col("error").isNotNull()).groupBy("blob_id").agg(
        F.max("attempts").alias("attempts"), F.max_by("error", "attempts").alias("error")
    )
    failed = failed.join(got.select("blob_id"), "blob_id", "left_anti")
    return got.unionByName(failed.select("blob_id", F.lit(None).cast("string").alias("content"), "attempts", "error"))


def hydrate_resumable(
    manifest: DataFrame,
    fetcher: Callable[[str], bytes],
    ledger: str,
    ids_per_block: int = 1_000_000,
    host: str | None = None,
    per_second: float | None = None,
    lanes: int = 8,
    max_retries: int = 5,
    inflight: int = 256,
    threads: int = 32,
    errors: str = "ignore",
    sleep: Callable[[float], None] = time.sleep,
) -> DataFrame:
    """``hydrate_blobs`` whose work survives the end of the session: what ``ledger`` holds is not fetched again.

    The distinct ids that the ledger has no content for are cut by hash into blocks of about ``ids_per_block``;
    each block is fetched by one Spark job and appended to the ledger. A run that is killed loses its open block
    at most, and the next run over the same ledger takes the ids still open, those that had failed among them.
    A null id is left out. One run at a time may write to a ledger.

    ``per_second`` bounds the fetches of each host, retries counted; ``host`` names its manifest column (without it
    all ids share one host; a null host is one of its own). The ids of a host go over ``lanes`` lanes, each kept by
    one task and paced at its part of the rate, so a host with most of the ids still has several tasks.

    Returns ``fetched``: one row for each id in the ledger.
    """
    spark = manifest.sparkSession
    if ids_per_block < 1 or lanes < 1 or (per_second is not None and per_second <= 0):
        raise ValueError("ids_per_block, lanes and per_second must be positive")
    of_host = F.coalesce(F.col(f"`{host}`").cast("string"), F.lit("")) if host else F.lit("")
    ids = manifest.where(F.col("blob_id").isNotNull()).select("blob_id", of_host.alias("host"))
    # An id named with several hosts goes by the smallest.
    ids = ids.groupBy("blob_id").agg(F.min("host").alias("host"))
    done = _finished(spark, ledger).where(F.col("error").isNull()).select("blob_id")
    left = written(ids.join(done, "blob_id", "left_anti"), "open-ids")
    blocks = -(-left.count() // ids_per_block)
    if blocks:
        number = F.xxhash64("blob_id")
        lane = F.concat_ws("|", F.pmod(F.shiftright(number, 32), F.lit(lanes)), "host")
        path = scratch_path(spark, "open-blocks")
        placed = left.select("blob_id", lane.alias("lane"), F.pmod(number, F.lit(blocks)).alias("block"))
        placed.repartition("block").write.partitionBy("block").parquet(path)
        work = _fetch_all(fetcher, max_retries, inflight, threads, errors, sleep, lanes / per_second if per_second else 0.0)
        tasks = max(spark.sparkContext.defaultParallelism, ids_per_block // _IDS_PER_TASK)
        for block in range(blocks):
            rows = spark.read.schema("blob_id string, lane string, block int").parquet(path).where(F.col("block") == block)
            rows = rows.repartition(tasks, "lane") if per_second else rows.repartition(tasks)
            rows.select("blob_id", "lane").mapInPandas(work, HYDRATED_SCHEMA).write.mode("append").parquet(ledger)
    return fetched(spark, ledger)


def scan_blob_store(spark, path) -> DataFrame:
    """Stored blobs as ``blob_id, data``.

    The id is the ``blob_id=`` folder when the store is laid out that way, else the file name up to
    its first dot.
    """
    files = spark.read.format("binaryFile").load(path)
    if "blob_id" in files.columns:
        blob_id = F.col("blob_id").cast("string")
    else:
        blob_id = F.substring_index(F.element_at(F.split("path", "/"), -1), ".", 1)
    return files.select(blob_id.alias("blob_id"), F.col("content").alias("data"))


def join_blob_store(manifest: DataFrame, store: DataFrame, charset: str | None = None) -> DataFrame:
    """Each manifest row with its content; null content and an error when missing or unreadable.

    ``store`` holds ``blob_id, data`` (gzip); of an id stored twice the smaller blob counts. The distinct
    ids of the manifest come first: only blobs that it names are grouped, and where the ids are few enough to be
    sent to the scan, only those are moved at all. Blobs travel compressed. ``charset`` is the manifest column
    with a per-row encoding.
    """
    named = manifest.select("blob_id").where(F.col("blob_id").isNotNull()).distinct()
    packed = store.join(named, "blob_id", "left_semi").groupBy("blob_id").agg(F.min("data").alias("_data"), F.lit(True).alias("_found"))
    joined = left_join_unique(manifest, packed, "blob_id")
    text = unpack_text(F.col("_data"), F.col(charset) if charset else None)
    rows = joined.withColumn("content", text)
    error = F.when(F.col("_found").isNull(), "missing").when(F.col("content").isNull(), "unreadable")
    return rows.withColumn("error", error).select(*manifest.columns, "content", "error")
