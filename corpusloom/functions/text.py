"""String functions with Python's notion of whitespace and of line ends."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# The 29 code points Python's str.strip() removes.
WHITESPACE = "".join(
    chr(c)
    for c in [
        *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680,
        *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000,
    ]
)
# One line end as str.splitlines() sees it.
LINE_END = r"(?:\r\n|[\n\r\x0b\x0c\x1c\x1d\x1e\x85\x{2028}\x{2029}])"
# Byte-level text back to the letters it stands for.
BYTELEVEL_REPAIRS = [
    ("Ġ", " "),
    ("Ä±", "ı"),
    ("ÅŁ", "ş"),
    ("Ã§", "ç"),
    ("Ã¼", "ü"),
    ("Ã¶", "ö"),
    ("ÄŁ", "ğ"),
]
_WS_CLASS = "[" + "".join(rf"\x{{{ord(c):x}}}" for c in WHITESPACE) + "]"


def py_strip(col: Column) -> Column:
    """Strip Unicode whitespace on both ends (linear, no regex)."""
    return F.btrim(col, F.lit(WHITESPACE))


def is_blank(col: Column) -> Column:
    return py_strip(col) == ""


def single_line(col: Column) -> Column:
    """Join the lines of a text with single spaces; a final line end adds nothing."""
    body = F.regexp_replace(col, LINE_END + r"\z", "")
    return F.regexp_replace(body, LINE_END, " ")


def collapse_ws(col: Column) -> Column:
    """Every whitespace run becomes one space, then strip."""
    return F.trim(F.regexp_replace(col, _WS_CLASS + "+", " "))


def repair_bytelevel(col: Column) -> Column:
    """Undo byte-level artefacts: the space marker and six Turkish letters."""
    return reduce(lambda c, pair: F.replace(c, F.lit(pair[0]), F.lit(pair[1])), BYTELEVEL_REPAIRS, col)


def drop_prefix_len(col: Column, prefix: Column) -> Column:
    """The prefix followed by the stripped text after its first ``length(prefix)`` characters."""
    rest = F.substr(col, F.length(prefix) + 1)
    return F.concat(prefix, py_strip(rest))


def clean_generated(col: Column, prompt: Column) -> Column:
    """Clean-up of decoded model output: repair, collapse, then split off the prompt."""
    return drop_prefix_len(collapse_ws(repair_bytelevel(col)), prompt)


def qa_concat(question: Column, response: Column) -> Column:
    """``question + ' ' + response``; a null is written as the text ``None``."""
    none = F.lit("None")
    return F.concat(F.coalesce(question, none), F.lit(" "), F.coalesce(response, none))


def match_path(col: Column, prefix: str, suffix: str) -> Column:
    return col.startswith(prefix) & col.endswith(suffix)


def shared_flag(col: Column) -> Column:
    """``E`` for shared, ``H`` otherwise (a missing flag counts as not shared)."""
    return F.when(F.coalesce(col, F.lit(False)), "E").otherwise("H")


def with_default(col: Column, value) -> Column:
    return F.coalesce(col, F.lit(value))


def suffix_number(col: Column) -> Column:
    """``checkpoint-123`` to 123; names without a digits-only second part give null."""
    digits = F.regexp_extract(col, r"^checkpoint-([0-9]+)(?:-|\z)", 1)
    return F.when(digits != "", digits.try_cast("bigint"))
