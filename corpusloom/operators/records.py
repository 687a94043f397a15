"""Filters and reshaping of corpus records."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.jsontext import fan_out_lines, inline_lines, string_field, with_parsed
from corpusloom.functions.text import py_strip, qa_concat

QA_FIELDS = ("question", "response")


def filter_valid_json(df: DataFrame, col: str = "raw", nan: bool = True) -> DataFrame:
    """Rows whose text is one JSON value."""
    return with_parsed(df, col, nan).where("is_valid").select(*df.columns)


def filter_content(df: DataFrame, col: str = "content") -> DataFrame:
    """Rows with a non-blank text. A column that is not a string never qualifies."""
    if dict(df.dtypes)[col] != "string":
        return df.where(F.lit(False))
    return df.where(F.coalesce(py_strip(F.col(col)), F.lit("")) != "")


def content_of_lines(scan: DataFrame, key: str = "content", keep_blank: bool = False) -> DataFrame:
    """The string contents of a JSON-line scan, without blank ones unless ``keep_blank``."""
    texts = scan.select(string_field(F.col("parsed"), key).alias("content"))
    return texts.where(F.col("content").isNotNull()) if keep_blank else filter_content(texts)


def drop_empty_blob(df: DataFrame, col: str = "content") -> DataFrame:
    """Strip, then drop null and empty contents."""
    return df.withColumn(col, py_strip(F.col(col))).where(F.col(col) != "")


def wrap_content(df: DataFrame, col: str) -> DataFrame:
    return df.select(F.col(col).alias("content"))


def drop_fields(df: DataFrame, *names: str) -> DataFrame:
    return df.drop(*names)


def harmonize_fields(df: DataFrame, mapping: Mapping[str, Sequence[str]]) -> DataFrame:
    """Give synonymous columns one name; the first non-null alias wins."""
    out = df
    for target, aliases in mapping.items():
        present = [a for a in (target, *aliases) if a in out.columns]
        if not present:
            continue
        value = F.coalesce(*[F.col(a) for a in present])
        out = out.withColumn("_harmonized", value).drop(*present).withColumnRenamed("_harmonized", target)
    return out


def union_corpora(*frames: DataFrame) -> DataFrame:
    """Bag union by column name; a missing column is null, duplicates stay."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _is_pair(df: DataFrame, present: Column | None) -> Column:
    if not set(QA_FIELDS) <= set(df.columns):
        return F.lit(False)
    if present is not None:
        return present
    return F.col("question").isNotNull() & F.col("response").isNotNull()


def qa_inline(df: DataFrame, is_pair: Column | None = None) -> DataFrame:
    """Typed records: a pair's text goes to ``content``; other rows pass unchanged.

    In a typed table a missing key and a null are the same, so a pair needs both values unless
    ``is_pair`` says which rows have both keys (then a null is written as ``None``).
    """
    pair = _is_pair(df, is_pair)
    text = qa_concat(F.col("question"), F.col("response"))
    old = F.col("content") if "content" in df.columns else F.lit(None).cast("string")
    rest = [c for c in df.columns if c not in (*QA_FIELDS, "content")]
    single = [F.when(pair, F.lit(None)).otherwise(F.col(c)).alias(c) for c in QA_FIELDS]
    return df.select(*rest, *single, F.when(pair, text).otherwise(old).alias("content"))


def qa_fan_out(df: DataFrame, is_pair: Column | None = None) -> DataFrame:
    """Typed records: a pair gives a ``content`` row and a row with the remaining fields, in one pass.

    Rows with only ``content`` pass, all others are dropped.
    """
    pair = _is_pair(df, is_pair)
    rest = [c for c in df.columns if c not in (*QA_FIELDS, "content")]
    old = F.col("content") if "content" in df.columns else F.lit(None).cast("string")
    keep = F.struct(old.alias("content"), *[F.col(c) for c in rest])
    types = {f.name: f.dataType for f in df.schema.fields}
    blank = [F.lit(None).cast(types[c]).alias(c) for c in rest]
    text = F.struct(qa_concat(F.col("question"), F.col("response")).alias("content"), *blank)
    rows = (
        F.when(pair, F.array(text, keep))
        .when(old.isNotNull(), F.array(keep))
        .otherwise(F.array().cast(f"array<{keep_type(df, rest)}>"))
    )
    return df.select(F.inline(rows))


def keep_type(df: DataFrame, rest: Sequence[str]) -> str:
    types = dict(df.dtypes)
    fields = ", ".join(["content: string", *[f"`{c}`: {types[c]}" for c in rest]])
    return f"struct<{fields}>"


def rewrite_lines(df: DataFrame, col: str = "raw", fan_out: bool = False) -> DataFrame:
    """Open-schema JSON lines with their rewritten lines in ``lines``, null for an unusable line.

    A line is unusable when it is malformed, or when its value does not allow the key test (a bare
    number).
    """
    # Marked so that later filters stay above it and the rewriting runs once per line.
    rule = (fan_out_lines if fan_out else inline_lines).asNondeterministic()
    return df.withColumn("lines", rule(F.col(col)))


def qa_inline_lines(df: DataFrame, col: str = "raw") -> DataFrame:
    """Every usable line, pairs rewritten."""
    return rewrite_lines(df.select(col), col).select(F.explode("lines").alias(col))


def qa_fan_out_lines(df: DataFrame, col: str = "raw") -> DataFrame:
    """Pairs become two lines, lines without ``content`` drop out."""
    return rewrite_lines(df.select(col), col, fan_out=True).select(F.explode("lines").alias(col))
