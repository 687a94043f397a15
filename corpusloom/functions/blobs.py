"""Compressed and encoded bytes. Spark has no built-in for these, so they are Arrow UDFs."""

from __future__ import annotations

import gzip
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StringType

from corpusloom.functions.batches import in_parts


def _unpacked(data):
    try:
        return None if data is None else gzip.decompress(data)
    except (OSError, EOFError, zlib.error):
        return None


def _decoded(data, charset, errors):
    if data is None or charset is None:
        return None
    try:
        return bytes(data).decode(charset, errors=errors)
    except (UnicodeError, LookupError):
        return None


def _rows(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[list[tuple]]:
    """Bytes and charsets of some rows at a time."""
    for batch in in_parts(pa.RecordBatch.from_arrays(list(c), ["data", "charset"]) for c in columns):
        yield list(zip(*(c.to_pylist() for c in batch.columns)))


@F.arrow_udf(BinaryType())
def _gunzip(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for data in in_parts(batches):
        yield pa.array([_unpacked(d) for d in data.to_pylist()], pa.binary())


@F.arrow_udf(StringType())
def _decode_lossy(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for data in in_parts(batches):
        yield pa.array([_decoded(d, "utf-8", "ignore") for d in data.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def _decode_as(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for rows in _rows(columns):
        yield pa.array([_decoded(d, c, "strict") for d, c in rows], pa.string())


@F.arrow_udf(StringType())
def _unpacked_text(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
    for data in in_parts(batches):
        yield pa.array([_decoded(_unpacked(d), "utf-8", "ignore") for d in data.to_pylist()], pa.string())


@F.arrow_udf(StringType())
def _unpacked_text_as(columns: Iterator[tuple[pa.Array, pa.Array]]) -> Iterator[pa.Array]:
    for rows in _rows(columns):
        yield pa.array([_decoded(_unpacked(d), c, "strict") for d, c in rows], pa.string())


def unpack_text(col: Column, charset: Column | None = None) -> Column:
    """Decompress and decode in one step: lossy UTF-8, or strictly in a per-row encoding.

    Marked so that filters on the text stay above it and each blob is unpacked once.
    """
    if charset is None:
        return _unpacked_text.asNondeterministic()(col)
    return _unpacked_text_as.asNondeterministic()(col, charset)


def gunzip(col: Column) -> Column:
    """Decompress gzip bytes; null when they are not gzip."""
    return _gunzip(col)


def decode_lossy(col: Column) -> Column:
    """UTF-8 text with undecodable bytes dropped; only values that hold some go through Python."""
    text = col.cast("string")
    valid = F.coalesce(F.is_valid_utf8(text), F.lit(True))
    return F.when(valid, text).otherwise(_decode_lossy(F.when(~valid, col)))


# Spellings of charsets whose texts need no decoder.
_UTF8 = ("utf-8", "utf8", "utf_8", "u8")
_ASCII = ("ascii", "us-ascii")
_LATIN1 = ("latin-1", "latin1", "latin_1", "iso-8859-1", "iso8859-1", "iso_8859_1", "l1")


def decode_as(col: Column, charset: Column) -> Column:
    """Text in a per-row encoding; null when the bytes do not fit it or it is unknown.

    UTF-8, ASCII and Latin-1 are read on the JVM; other rows go through Python.
    """
    name, text = F.lower(F.trim(charset)), col.cast("string")
    # Bytes over 127 never stand alone in UTF-8, so a text as long as its bytes is ASCII.
    plain = F.is_valid_utf8(text) & (F.length(text) == F.octet_length(text))
    unicode, ascii_only, latin = name.isin(*_UTF8), name.isin(*_ASCII), name.isin(*_LATIN1)
    known = unicode | ascii_only | latin
    other = _decode_as(F.when(~known, col), charset)
    return (
        F.when(unicode, F.when(F.is_valid_utf8(text), text))
        .when(ascii_only, F.when(plain, text))
        .when(latin, F.decode(col, "ISO-8859-1"))
        .otherwise(other)
    )
