"""Session-level helpers: the shared scratch folder, written intermediates, input spreading."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession

# An input whose bytes per core fall under this is worth one shuffle to even out its tasks.
_BYTES_PER_CORE = 2 * 128 * 1024 * 1024
# A range of sorted rows; the shuffle setting alone would leave huge ones on a large table. The
# estimate of a plan with joins can be far too high, hence the limit.
_BYTES_PER_RANGE = 256 * 1024 * 1024
_MOST_RANGES = 400_000
# Spark's estimate for rows it knows nothing about is the largest long.
_UNKNOWN_BYTES = 1 << 60

# Bytes of an Arrow batch on its way to Python, and the setting for it.
_BATCH_BYTES = 1 << 20
_BATCH_SETTING = "spark.sql.execution.arrow.maxBytesPerBatch"

_local_dirs: dict[str, str] = {}
_scopes: list[str] = []


def build_session(master: str, name: str = "corpusloom", **conf: str) -> SparkSession:
    """A session with the settings the library expects; every value can be overridden."""
    settings = {
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
        "spark.sql.execution.arrow.pyspark.enabled": "true",
        "spark.ui.enabled": "false",
        **conf,
    }
    builder = SparkSession.builder.master(master).appName(name)
    for key, value in settings.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors share: ``spark.checkpoint.dir``.

    Only a local session without that setting gets a folder of its own; on a cluster a missing
    setting is an error, because a machine-local folder would lose data with its executor.
    """
    named = spark.conf.get("spark.checkpoint.dir", None)
    if named:
        return named.rstrip("/")
    context = spark.sparkContext
    if not context.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that every executor can reach")
    app = context.applicationId
    if app not in _local_dirs:
        _local_dirs[app] = tempfile.mkdtemp(prefix="corpusloom-")
    return _local_dirs[app]


def scratch_path(spark: SparkSession, label: str) -> str:
    """A fresh path under the shared folder, in the innermost open scope."""
    return "/".join([shared_dir(spark), "corpusloom", *_scopes[-1:], f"{label}-{uuid.uuid4().hex}"])


@contextmanager
def scratch_scope(spark: SparkSession) -> Iterator[None]:
    """Removes the intermediates written inside it when it closes.

    A frame made inside reads those files lazily: write or collect it before the scope ends.
    """
    scope = "/".join([*_scopes[-1:], f"scope-{uuid.uuid4().hex}"])
    _scopes.append(scope)
    try:
        yield
    finally:
        _scopes.remove(scope)
        path = spark._jvm.org.apache.hadoop.fs.Path(f"{shared_dir(spark)}/corpusloom/{scope}")
        path.getFileSystem(spark._jsc.hadoopConfiguration()).delete(path, True)


def written(df: DataFrame, label: str) -> DataFrame:
    """Write once to the shared folder and read back, so that later passes see identical rows."""
    spark = df.sparkSession
    path = scratch_path(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small_batches(spark: SparkSession) -> None:
    """Bounds the Arrow batches of the session by about 1 MB; a single row may be larger.

    Spark fills a batch up to 10,000 rows or 64 MB, which both the JVM and Python hold, growing copies besides; rows of
    whole texts or sets reach that. Frames are lazy, so the setting stays. A smaller one of the caller is kept.
    """
    now = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(_BATCH_SETTING))
    if now > _BATCH_BYTES:
        spark.conf.set(_BATCH_SETTING, str(_BATCH_BYTES))


def in_stable_order(df: DataFrame) -> DataFrame:
    """The rows in an order that repeats when a task is run again.

    Running numbers decide where a row goes; after a shuffle the row order may change when a lost
    task is repeated, and a row could then be lost or doubled. A frame that shuffles is therefore
    written first. One that only scans and maps is returned as it is.
    """
    plan = df._jdf.queryExecution().executedPlan().toString()
    return written(df, "stable-order") if "Exchange" in plan else df


def estimated_bytes(df: DataFrame) -> int | None:
    """The optimizer's size estimate of a plan (file sizes for a plain scan), None when unknown."""
    size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    return None if size >= _UNKNOWN_BYTES else size


def ranged(df: DataFrame, *keys) -> DataFrame:
    """Range-partition the rows, with more tasks than the session's setting when they need them.

    Without a number Spark may still join small neighbouring ranges.
    """
    setting = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    needed = min((estimated_bytes(df) or 0) // _BYTES_PER_RANGE, _MOST_RANGES)
    return df.repartitionByRange(needed, *keys) if needed > setting else df.repartitionByRange(*keys)


def spread(scan: DataFrame) -> DataFrame:
    """Even out a scan that is too small to fill the cores.

    Text splitting costs far more per byte than reading, and a small file often arrives as one
    task. A large scan already has more tasks than cores and is returned untouched, with no
    shuffle.
    """
    cores = scan.sparkSession.sparkContext.defaultParallelism
    size = estimated_bytes(scan)
    if size is None or size >= cores * _BYTES_PER_CORE:
        return scan
    return scan.repartition(cores)
