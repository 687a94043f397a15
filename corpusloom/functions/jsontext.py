"""JSON lines: exact validity, typed content, key access, record rewriting.

Good lines are parsed on the JVM into a variant. The line is wrapped in a two-element array whose
second element is a marker: trailing text, a second object or an empty line then shows up as a
missing marker, which a bare variant parse would let pass. Only the lines that fail this test go to
Python's ``json`` for the last word, so repeated keys (last one wins), ``NaN`` and Unicode
whitespace around the object are read the way ``json.loads(line.strip())`` reads them.
"""

from __future__ import annotations

import json
import math

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType, StructType

_MARK = "corpusloom.end.of.line"


def _finite(value):
    if isinstance(value, float) and not math.isfinite(value):
        return None
    if isinstance(value, dict):
        return {k: _finite(v) for k, v in value.items()}
    if isinstance(value, list):
        return [_finite(v) for v in value]
    return value


def loads(line, nan: bool = True):
    """``json.loads`` on the stripped line; with ``nan=False`` the non-JSON constants are refused."""

    def refuse(name):
        raise ValueError(name)

    return json.loads(line.strip(), parse_constant=None if nan else refuse)


def _second_opinion(line, nan):
    if line is None:
        return None
    try:
        return json.dumps(_finite(loads(line, nan)))
    except (ValueError, RecursionError):
        return None


@F.pandas_udf(StringType())
def _repaired(lines: pd.Series) -> pd.Series:
    return lines.map(lambda s: _second_opinion(s, True))


@F.pandas_udf(StringType())
def _repaired_no_nan(lines: pd.Series) -> pd.Series:
    return lines.map(lambda s: _second_opinion(s, False))


def with_parsed(df: DataFrame, col: str = "raw", nan: bool = True) -> DataFrame:
    """Add ``parsed`` (variant) and ``is_valid``. ``nan=False`` also refuses ``NaN``/``Infinity``."""
    line = F.col(col)
    # Not marked for its results but for the plan: a filter on the parsed value would otherwise be
    # pushed below the parse, and every line would be parsed several times.
    second_opinion = (_repaired if nan else _repaired_no_nan).asNondeterministic()
    wrapped = F.try_parse_json(F.concat(F.lit("["), line, F.lit(f',"{_MARK}"]')))
    repaired = second_opinion(F.when(~F.col("_whole"), line))
    return (
        df.withColumn("_wrapped", wrapped)
        .withColumn(
            "_whole",
            F.coalesce(F.try_variant_get("_wrapped", "$[1]", "string") == _MARK, F.lit(False)),
        )
        .withColumn("_repaired", repaired)
        .withColumn(
            "parsed",
            F.when(F.col("_whole"), F.try_variant_get("_wrapped", "$[0]", "variant")).otherwise(
                F.try_parse_json("_repaired")
            ),
        )
        # A line over the size limit of a variant has no parsed value and counts as a failure.
        .withColumn("is_valid", F.col("_whole") | (F.col("_repaired").isNotNull() & F.col("parsed").isNotNull()))
        .drop("_wrapped", "_whole", "_repaired")
    )


def string_field(parsed: Column, key: str) -> Column:
    """The value of a top-level key when it is a JSON string, else null."""
    path = f"$['{key}']"
    kind = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
    return F.when(kind == "STRING", F.try_variant_get(parsed, path, "string"))


# Kinds of JSON values that a column type takes; a value of another kind is null, never cast.
_KINDS = {
    "string": "STRING", "boolean": "BOOLEAN", "tinyint": "BIGINT", "smallint": "BIGINT", "int": "BIGINT", "bigint": "BIGINT",
    "float": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)", "double": "(BIGINT|DOUBLE|FLOAT|DECIMAL.*)", "decimal": "(BIGINT|DECIMAL.*)",
}


def typed_record(parsed: Column, schema: StructType) -> Column:
    """The fields of a JSON object as a struct; null for any other value."""
    fields = []
    for f in schema.fields:
        path, name = f"$['{f.name}']", f.dataType.simpleString()
        value = F.try_variant_get(parsed, path, name)
        kind = _KINDS.get(name.split("(")[0])
        if kind is not None:
            kinds = F.schema_of_variant(F.try_variant_get(parsed, path, "variant"))
            value = F.when(kinds.rlike(f"^{kind}$"), value)
        fields.append(value.alias(f.name))
    return F.when(F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), F.struct(*fields))


def object_keys(parsed: Column) -> Column:
    """Top-level keys of a JSON object, null for any other value."""
    return F.json_object_keys(F.to_json(parsed))


def to_json_line(*cols: str | Column) -> Column:
    """One JSON object with every column, nulls written out."""
    return F.to_json(F.struct(*cols), {"ignoreNullFields": "false"})


def _dump(value) -> str:
    return json.dumps(value, ensure_ascii=False)


def _joined(record) -> str:
    return f"{record['question']} {record['response']}"


def _without_qa(record):
    return {k: v for k, v in record.items() if k not in ("question", "response")}


def inline_record(record):
    """One output record: a question/response pair becomes ``content``, anything else is kept."""
    if "question" in record and "response" in record:
        record = {**record, "content": _joined(record)}
        return [_without_qa(record)]
    return [record]


def fan_out_record(record):
    """A pair gives two records, the joined text and the rest; otherwise only ``content`` is kept."""
    if "question" in record and "response" in record:
        return [{"content": _joined(record)}, _without_qa(record)]
    return [record] if "content" in record else []


def _rewritten(line, rule):
    if line is None:
        return None
    try:
        record = loads(line)
        return [_dump(r) for r in rule(record)]
    except (ValueError, TypeError, RecursionError):
        return None


@F.pandas_udf(ArrayType(StringType()))
def inline_lines(lines: pd.Series) -> pd.Series:
    return lines.map(lambda s: _rewritten(s, inline_record))


@F.pandas_udf(ArrayType(StringType()))
def fan_out_lines(lines: pd.Series) -> pd.Series:
    return lines.map(lambda s: _rewritten(s, fan_out_record))


@F.pandas_udf(StringType())
def update_json(lines: pd.Series, patches: pd.Series) -> pd.Series:
    """``dict.update`` on two JSON objects; a null patch leaves the record as it is."""
    return pd.Series(
        [
            None if a is None else _dump({**loads(a), **(json.loads(b) if b is not None else {})})
            for a, b in zip(lines, patches)
        ],
        dtype="object",
    )
