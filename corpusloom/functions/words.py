"""Splitting text into words ahead of byte-pair encoding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The word patterns of the two pre-tokenizers.
WS_PATTERN = r"(?U)\w+|[^\w\s]+"
BYTES_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
)


def byte_alphabet() -> list[str]:
    """The printable character for each byte value, built by rule.

    A byte that is a visible Latin-1 character stands for itself; the others take the code points
    from 256 on, in byte order.
    """
    visible = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    hidden = [b for b in range(256) if b not in visible]
    return [chr(b) if b in visible else chr(256 + hidden.index(b)) for b in range(256)]


_MOVED = [(chr(b), c) for b, c in enumerate(byte_alphabet()) if chr(b) != c]
_HIDDEN = "".join(a for a, _ in _MOVED)
_SHOWN = "".join(b for _, b in _MOVED)


def pretokenize_ws(col: Column) -> Column:
    """Runs of word characters, or runs of other visible characters."""
    return F.regexp_extract_all(col, F.lit(WS_PATTERN), F.lit(0))


def to_byte_text(col: Column) -> Column:
    """Text as one printable character per UTF-8 byte."""
    latin = F.decode(F.encode(col, "UTF-8"), "ISO-8859-1")
    return F.translate(latin, _HIDDEN, _SHOWN)


def from_byte_text(col: Column) -> Column:
    """The UTF-8 bytes behind byte-level text, as binary.

    ``translate`` deletes what maps to a zero character, so that one is replaced first.
    """
    zeroed = F.replace(col, F.lit(_SHOWN[0]), F.lit(_HIDDEN[0]))
    return F.encode(F.translate(zeroed, _SHOWN[1:], _HIDDEN[1:]), "ISO-8859-1")


def split_bytes(col: Column, add_prefix_space: bool = True) -> Column:
    """The words of the byte-level split as plain text; a leading space counts as part of a word."""
    text = col
    if add_prefix_space:
        text = F.when((col == "") | col.startswith(" "), col).otherwise(F.concat(F.lit(" "), col))
    return F.regexp_extract_all(text, F.lit(BYTES_PATTERN), F.lit(0))


def pretokenize_bytes(col: Column, add_prefix_space: bool = True) -> Column:
    """Byte-level words, one printable character per byte."""
    return F.transform(split_bytes(col, add_prefix_space), to_byte_text)
