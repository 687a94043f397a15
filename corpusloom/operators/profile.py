"""Counts and profiles of a corpus."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from corpusloom.functions.jsontext import object_keys
from corpusloom.functions.text import is_blank
from corpusloom.functions.words import pretokenize_ws
from corpusloom.session import in_stable_order, ranged


def count_json(scan: DataFrame) -> DataFrame:
    """Valid and malformed lines of a JSON-line scan."""
    return scan.agg(
        F.count_if("is_valid").alias("n_json"), F.count_if(~F.col("is_valid")).alias("n_malformed")
    )


def extra_keys(scan: DataFrame, expected: Sequence[str] = ("content",)) -> DataFrame:
    """Rows with top-level keys outside the expected ones, and those keys."""
    known = F.array(*[F.lit(e) for e in expected])
    keys = F.array_except(object_keys(F.col("parsed")), known)
    return scan.withColumn("extra_keys", keys).where(F.size("extra_keys") > 0)


def key_profile(scan: DataFrame) -> DataFrame:
    """How often each top-level key occurs with which JSON type."""
    spark = scan.sparkSession
    objects = scan.where("is_valid").select("parsed")
    fields = objects.lateralJoin(spark.tvf.variant_explode(F.col("parsed").outer()))
    return (
        fields.where(F.col("key").isNotNull())
        .groupBy("key", F.schema_of_variant("value").alias("json_type"))
        .agg(F.count("*").alias("n_rows"))
    )


def corpus_stats(df: DataFrame, by: Sequence[str] = (), col: str = "content") -> DataFrame:
    """Rows, non-blank texts, bytes and characters."""
    text = F.col(col)
    return df.groupBy(*by).agg(
        F.count("*").alias("n_rows"),
        F.count_if(text.isNotNull() & ~is_blank(text)).alias("n_texts"),
        F.sum(F.octet_length(text).cast("bigint")).alias("n_bytes"),
        F.sum(F.length(text).cast("bigint")).alias("n_chars"),
    )


def observed(df: DataFrame, name: str, *metrics: Column) -> tuple[DataFrame, Observation]:
    """Count rows while they pass; the numbers are ready once an action has run."""
    watch = Observation(name)
    return df.observe(watch, *(metrics or (F.count(F.lit(1)).alias("n_rows"),))), watch


def word_counts(
    df: DataFrame,
    col: str = "content",
    min_frequency: int = 1,
    vocab_size: int | None = None,
    pretokenize=pretokenize_ws,
) -> DataFrame:
    """Word frequencies, combined on the map side; optionally the ``vocab_size`` most frequent."""
    words = df.select(F.explode(pretokenize(F.col(col))).alias("word"))
    counts = words.groupBy("word").agg(F.count("*").alias("n"))
    if min_frequency > 1:
        counts = counts.where(F.col("n") >= min_frequency)
    return counts if vocab_size is None else top_k(counts, [F.desc("n"), F.asc("word")], vocab_size)


def term_postings(df: DataFrame, col: str, id_col: str) -> DataFrame:
    """Word, row id, occurrences: one output row per pair, so a frequent word never piles up.

    The occurrences of a pair come from one input row and collapse before the shuffle.
    """
    words = df.select(F.col(id_col), F.explode(pretokenize_ws(F.col(col))).alias("word"))
    return words.groupBy("word", id_col).agg(F.count("*").alias("n_in_row"))


def term_rows(df: DataFrame, col: str, min_frequency: int = 1) -> DataFrame:
    """For each word the number of rows it occurs in and its total count.

    Each row contributes its words and, marked, its distinct words, so that one map-side combined
    aggregation gives both numbers without a shuffle on (word, row).
    """
    words = df.select(pretokenize_ws(F.col(col)).alias("words"))
    marked = F.concat(
        F.transform("words", lambda w: F.struct(w.alias("word"), F.lit(0).alias("row"))),
        F.transform(F.array_distinct("words"), lambda w: F.struct(w.alias("word"), F.lit(1).alias("row"))),
    )
    return (
        words.select(F.inline(marked))
        .groupBy("word")
        .agg(F.sum("row").alias("n_rows"), F.sum(F.lit(1) - F.col("row")).alias("n"))
        .where(F.col("n") >= min_frequency)
    )


def sorted_listing(df: DataFrame, *cols: str | Column) -> DataFrame:
    """A stable sort. The running number also spreads a value that most rows share."""
    numbered = in_stable_order(df).withColumn("_input", F.monotonically_increasing_id())
    return ranged(numbered, *cols, "_input").sortWithinPartitions(*cols, "_input").drop("_input")


def page(df: DataFrame, size: int = 100, order: Sequence[str | Column] = ()) -> DataFrame:
    """The first ``size`` rows; later pages are never read."""
    return (df.orderBy(*order) if order else df).limit(size)


def peek(df: DataFrame, col: str = "content", rows: int = 1, chars: int = 500) -> DataFrame:
    """The beginning of the first rows of a lazy stream of records."""
    return df.limit(rows).withColumn(col, F.substring(col, 1, chars))


def top_k(df: DataFrame, order: Sequence[Column], k: int) -> DataFrame:
    """Planned as a per-task top-k followed by a merge, never a full sort."""
    return df.orderBy(*order).limit(k)
