"""Row positions, fixed-size batches and the positional join.

A position needs a defined order. Rows are range-partitioned and sorted on that order, written once
to the shared folder together with their partition number and place in it, and then shifted by the
number of rows in the partitions before. The only single-task step runs over one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.jsontext import update_json
from corpusloom.session import in_stable_order, ranged, written
from corpusloom.sources.files import FILE_ORDER, file_order_columns, scan_csv

_IN_PARTITION = (1 << 33) - 1
# Up to this many (file, block) pairs the offset table is broadcast; beyond it Spark picks the join.
_BROADCAST_BLOCKS = 200_000


def _columns(order: str | Column | Sequence[str | Column]) -> list[Column]:
    items = [order] if isinstance(order, (str, Column)) else list(order)
    return [F.col(o) if isinstance(o, str) else o for o in items]


def _offsets(counts: DataFrame, order: list[str]) -> DataFrame:
    before = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return counts.withColumn("_before", F.coalesce(F.sum("_rows").over(before), F.lit(0))).drop("_rows")


def row_position(df: DataFrame, order, name: str = "row_pos") -> DataFrame:
    """Add the 0-based position of each row in the given order; ties keep their input order.

    The running input number is part of the range key, so that one value of the order column may
    hold any share of the rows and still spread over many tasks.
    """
    keys = [*_columns(order), F.col("_input")]
    numbered = in_stable_order(df).withColumn("_input", F.monotonically_increasing_id())
    placed = written(
        ranged(numbered, *keys)
        .sortWithinPartitions(*keys)
        .drop("_input")
        .withColumn("_part", F.spark_partition_id())
        .withColumn("_seq", F.monotonically_increasing_id().bitwiseAND(F.lit(_IN_PARTITION))),
        "row-position",
    )
    counts = placed.groupBy("_part").agg(F.count("*").alias("_rows"))
    # One row per partition, so the offsets may be broadcast.
    offsets = F.broadcast(_offsets(counts, ["_part"]))
    return (
        placed.join(offsets, "_part")
        .withColumn(name, F.col("_seq") + F.col("_before"))
        .select(*df.columns, name)
    )


def file_position(ordered: DataFrame, name: str = "row_pos") -> DataFrame:
    """Position in file order for a scan that carries the file-order columns; no shuffle, no sort.

    Lines of one block are read in order by one task, so a line's place in its block is its running
    number minus the block's smallest.
    """
    placed = written(ordered, "file-position")
    blocks = placed.groupBy("src_file", "src_block").agg(
        F.count("*").alias("_rows"), F.min("src_line").alias("_first")
    )
    offsets = _offsets(blocks, ["src_file", "src_block"])
    if blocks.limit(_BROADCAST_BLOCKS + 1).count() <= _BROADCAST_BLOCKS:
        offsets = F.broadcast(offsets)
    kept = [c for c in ordered.columns if c not in FILE_ORDER]
    return (
        placed.join(offsets, ["src_file", "src_block"])
        .withColumn(name, F.col("src_line") - F.col("_first") + F.col("_before"))
        .select(*kept, name)
    )


def batch_of_n(df: DataFrame, order, n: int, name: str = "batch") -> DataFrame:
    """Number consecutive rows in batches of ``n``; only for logic that needs the batch itself."""
    placed = row_position(df, order, "_pos")
    return placed.withColumn(name, F.floor(F.col("_pos") / n).cast("bigint")).drop("_pos")


def _overlay(left: DataFrame, right: DataFrame) -> DataFrame:
    """Left outer join on ``row_pos``; a matched right row overwrites same-named left columns."""
    shared = [c for c in right.columns if c in left.columns and c != "row_pos"]
    added = [c for c in right.columns if c not in left.columns]
    r = right.select(
        "row_pos",
        F.lit(True).alias("_matched"),
        *[F.col(c).alias(f"_r_{c}") for c in right.columns if c != "row_pos"],
    )
    joined = left.join(r, "row_pos", "left")
    values = [
        F.when(F.col("_matched"), F.col(f"_r_{c}")).otherwise(F.col(c)).alias(c) if c in shared else F.col(c)
        for c in left.columns
        if c != "row_pos"
    ]
    return joined.select("row_pos", *values, *[F.col(f"_r_{c}").alias(c) for c in added])


def positional_join(left: DataFrame, right: DataFrame, left_order, right_order) -> DataFrame:
    """Row *i* with row *i*: surplus left rows stay, surplus right rows are dropped."""
    return _overlay(row_position(left, left_order), row_position(right, right_order))


def positional_join_files(
    spark: SparkSession, jsonl, csv, csv_schema: str | None = None, line_breaks: bool = True
) -> DataFrame:
    """JSON lines updated by the CSV row of the same position, as ``row_pos, raw``.

    Both sides keep file order. A blank CSV cell becomes null. ``line_breaks`` is that of ``scan_csv``.
    """
    lines = spark.read.text(jsonl).select(F.col("value").alias("raw"), *file_order_columns())
    table = scan_csv(spark, csv, csv_schema, line_breaks)
    patch = F.to_json(F.struct(*table.columns), {"ignoreNullFields": "false"})
    rows = table.select(patch.alias("patch"), *file_order_columns())
    joined = file_position(lines).join(file_position(rows), "row_pos", "left")
    return joined.select("row_pos", update_json("raw", "patch").alias("raw"))
