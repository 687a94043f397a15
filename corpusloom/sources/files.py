"""Scans: JSON lines, manifests, CSV, plain text, token rows, file listings."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from corpusloom.functions.jsontext import typed_record, with_parsed
from corpusloom.functions.text import match_path

TOKEN_SCHEMA = "input_ids array<int>"
RUN_STATE_SCHEMA = (
    "run_id string, step bigint, epoch double, loss double, ts timestamp, model_path string"
)


def scan_lines(spark: SparkSession, path) -> DataFrame:
    """Text lines as ``raw``. The reader splits on LF, CRLF and CR, as Python text mode does."""
    return spark.read.text(path).withColumnRenamed("value", "raw")


def scan_lines_in_order(spark: SparkSession, path) -> DataFrame:
    """Lines with the three columns that define file order: file, block in file, line in block."""
    return spark.read.text(path).select(F.col("value").alias("raw"), *file_order_columns())


def file_order_columns() -> list[Column]:
    return [
        F.col("_metadata.file_path").alias("src_file"),
        F.col("_metadata.file_block_start").alias("src_block"),
        F.monotonically_increasing_id().alias("src_line"),
    ]


FILE_ORDER = ["src_file", "src_block", "src_line"]


def scan_jsonl(spark: SparkSession, path, schema: str | None = None, nan: bool = True) -> DataFrame:
    """JSON lines as ``raw, parsed, is_valid``; bad lines are kept and flagged.

    ``parsed`` is a variant, or a struct when ``schema`` is given: null unless the line is an
    object, and a field is null unless its value is of the column's kind.
    """
    rows = with_parsed(scan_lines(spark, path), "raw", nan)
    if schema is None:
        return rows
    return rows.withColumn("parsed", typed_record(F.col("parsed"), StructType.fromDDL(schema)))


def scan_jsonl_strict(spark: SparkSession, path, schema: str | None = None) -> DataFrame:
    """The same scan, but the first malformed line aborts the job."""
    rows = scan_jsonl(spark, path, schema)
    failure = F.raise_error(F.concat(F.lit("malformed JSON line: "), F.col("raw")))
    return rows.select(
        F.when(F.col("is_valid"), F.col("raw")).otherwise(failure.cast("string")).alias("raw"), "parsed"
    )


def scan_manifest(spark: SparkSession, path, columns=("blob_id",)) -> DataFrame:
    """Only the id column of the parquet manifests reaches the scan."""
    return spark.read.parquet(path).select(*columns)


def list_inputs(spark: SparkSession, root: str, prefix: str = "", suffix: str = ".parquet") -> DataFrame:
    """Files directly under ``root`` whose name has the prefix and suffix, sorted by path.

    Only metadata columns are read, never file contents.
    """
    files = spark.read.format("binaryFile").load(root).select("path", "length", "modificationTime")
    name = F.element_at(F.split("path", "/"), -1)
    return (
        files.withColumn("name", name)
        .where(match_path(F.col("name"), prefix, suffix))
        .orderBy("path")
    )


def count_inputs(spark: SparkSession, root: str, prefix: str = "", suffix: str = ".parquet") -> DataFrame:
    files = list_inputs(spark, root, prefix, suffix)
    return files.agg(F.count("*").alias("n_files"), F.sum("length").alias("n_bytes"))


def input_stats(spark: SparkSession, root: str) -> DataFrame:
    """``path, n_bytes, n_lines`` of every text file under ``root`` in one scan; an empty file has no row."""
    text = spark.read.option("recursiveFileLookup", "true").text(root)
    file = F.col("_metadata")
    return text.groupBy(file["file_path"].alias("path")).agg(F.max(file["file_size"]).alias("n_bytes"), F.count("*").alias("n_lines"))


def scan_csv(spark: SparkSession, path, schema: str | None = None, line_breaks: bool = True) -> DataFrame:
    """CSV with a header, a quote in a cell written twice, and line breaks inside quoted cells.

    Without a schema the types are inferred, which costs one extra pass. A file whose cells may hold
    line breaks is read by one task; ``line_breaks=False`` splits files that are known to have none.
    """
    reader = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("multiLine", line_breaks)
    return reader.schema(schema).csv(path) if schema else reader.option("inferSchema", True).csv(path)


def scan_tokens(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(TOKEN_SCHEMA).json(path)


def scan_text_corpus(spark: SparkSession, path) -> DataFrame:
    """Plain text with one document per line, as ``content``."""
    return spark.read.text(path).withColumnRenamed("value", "content")


def scan_run_states(spark: SparkSession, path) -> DataFrame:
    return spark.read.schema(RUN_STATE_SCHEMA).parquet(path)
