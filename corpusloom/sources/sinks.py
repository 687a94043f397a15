"""Writers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_jsonl(
    df: DataFrame,
    path: str,
    max_rows: int | None = None,
    mode: str = "errorifexists",
    nulls: bool = True,
) -> None:
    """One JSON object per line. ``mode='overwrite'`` replaces, ``mode='ignore'`` skips an existing
    output; ``nulls=False`` leaves null fields out."""
    writer = df.write.mode(mode).option("ignoreNullFields", str(not nulls).lower())
    if max_rows is not None:
        writer = writer.option("maxRecordsPerFile", max_rows)
    writer.json(path)


def write_text(df: DataFrame, col: str, path: str, mode: str = "errorifexists") -> None:
    """One document per line; the column must already be a single line."""
    df.select(F.col(col).cast("string").alias("value")).write.mode(mode).text(path)


def write_lines(df: DataFrame, path: str, col: str = "raw", mode: str = "errorifexists") -> None:
    """Ready-made JSON lines."""
    write_text(df, col, path, mode)


def output_exists(spark, path: str) -> bool:
    """Whether a finished output is already there, on any file system Spark can reach."""
    hadoop = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = hadoop.getFileSystem(spark._jsc.hadoopConfiguration())
    return files.exists(spark._jvm.org.apache.hadoop.fs.Path(hadoop, "_SUCCESS"))


def append_run_state(df: DataFrame, path: str) -> None:
    """Append state rows. The latest state is a query over the table, not a second copy."""
    df.select(
        F.col("run_id").cast("string"),
        F.col("step").cast("bigint"),
        F.col("epoch").cast("double"),
        F.col("loss").cast("double"),
        F.col("ts").cast("timestamp"),
        F.col("model_path").cast("string"),
    ).write.mode("append").parquet(path)


def split_dead_letter(df: DataFrame, flag: str = "is_valid") -> tuple[DataFrame, DataFrame]:
    """Rows to keep and rows to report. ``flag`` is a boolean column, or an error text column."""
    column = F.col(flag)
    if dict(df.dtypes)[flag] == "boolean":
        good = F.coalesce(column, F.lit(False))
    else:
        good = column.isNull()
    return df.where(good), df.where(~good)
