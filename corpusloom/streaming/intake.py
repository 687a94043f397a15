"""Incremental corpus building: only files that arrived since the last run are read."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from corpusloom.functions.jsontext import with_parsed
from corpusloom.operators.bpe import BpeModel
from corpusloom.operators.records import content_of_lines
from corpusloom.operators.tokens import MAX_LENGTH, encode


def stream_lines(
    spark: SparkSession,
    in_dir: str,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
) -> DataFrame:
    """JSON lines of a growing folder as ``raw``; the two limits bound one micro-batch."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if max_bytes_per_trigger is not None:
        reader = reader.option("maxBytesPerTrigger", max_bytes_per_trigger)
    return reader.load(in_dir).withColumnRenamed("value", "raw")


def incremental_corpus(
    spark: SparkSession,
    in_dir: str,
    out_dir: str,
    checkpoint: str,
    model: BpeModel | None = None,
    max_files_per_trigger: int | None = None,
    max_bytes_per_trigger: int | None = None,
    max_length: int | None = MAX_LENGTH,
) -> StreamingQuery:
    """Clean, and with a model encode, the new files of ``in_dir`` into JSON lines in ``out_dir``.

    The query stops once everything present has been taken in. The file sink's log and the
    checkpoint make each input line appear once, also after a restart.
    """
    lines = stream_lines(spark, in_dir, max_files_per_trigger, max_bytes_per_trigger)
    rows = content_of_lines(with_parsed(lines, "raw", nan=False))
    if model is not None:
        rows = encode(rows, "content", model, max_length).select("input_ids")
    return (
        rows.writeStream.format("json")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


def incremental_dead_letters(
    spark: SparkSession, in_dir: str, out_dir: str, checkpoint: str, max_files_per_trigger: int | None = None
) -> StreamingQuery:
    """The malformed lines of the same folder, each with its file."""
    reader = spark.readStream.format("text")
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    lines = reader.load(in_dir).select(
        F.col("value").alias("raw"), F.col("_metadata.file_path").alias("file")
    )
    bad = with_parsed(lines, "raw").where(~F.col("is_valid")).select("file", "raw")
    return (
        bad.writeStream.format("json")
        .option("path", out_dir)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
