"""The text-file variant of vocabulary learning: word-boundary marks, character coverage, bytes.

A line is normalized and split on spaces; each word starts with a mark. Merges stay inside a run of
one script, digits stand alone, and characters outside the coverage are left to byte fallback. The
vocabulary is the fixed symbols, the 256 bytes, the merges by rank, and the covered characters by
frequency.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from corpusloom.operators.bpe import MergeRule, WordTable, characters, merge_rounds, pair_counts
from corpusloom.session import spread, written

# The space mark, the symbols in id order, the longest piece, the usual line limit.
MARK = chr(0x2581)
CONTROL_SYMBOLS = ("<pad>", "<unk>", "<s>", "</s>")
USER_SYMBOLS = ("<mask>",)
UNKNOWN_SYMBOL = "<unk>"
MAX_PIECE = 16
LIBRARY_LINE_BYTES = 4192
# Kinds of pieces, by the numbers of the model file.
NORMAL, UNKNOWN, CONTROL, USER, UNUSED, BYTE = 1, 2, 3, 4, 5, 6
# Code points that normalization removes, and those it turns into a space,
# and the one compatibility character it keeps.
_REMOVED = [*range(0x01, 0x09), 0x0B, *range(0x0E, 0x20), 0x7F, 0x8F, 0x9F]
_SPACED = [
    0x09, 0x0A, 0x0C, 0x0D, 0x61C, 0x1680, 0x200B, 0x200C, 0x200E, 0x200F, 0x2028, 0x2029, 0x2581,
    0xFEFF, 0xFFFD,
]
_KEPT = chr(0xFF5E)
_CONTROL_MAP = {**{c: None for c in _REMOVED}, **{c: " " for c in _SPACED}}
# Scripts that count as one.
_HAN_GROUP = ("HAN", "HIRAGANA", "KATAKANA")


@dataclass(frozen=True)
class PieceModel:
    """Pieces in id order; the merges are those after the fixed symbols and bytes.

    Scores, kinds and rules are those of a model that was read from a file; a learned one has its own by rule.
    """

    pieces: tuple[str, ...]
    n_merges: int
    control_symbols: tuple[str, ...] = CONTROL_SYMBOLS
    user_symbols: tuple[str, ...] = USER_SYMBOLS
    byte_fallback: bool = True
    add_dummy_prefix: bool = True
    remove_extra_whitespaces: bool = True
    scores: tuple[float, ...] | None = None
    kinds: tuple[int, ...] | None = None
    rules: tuple[tuple[str, str], ...] | None = None

    def piece_kinds(self) -> list[int]:
        """What each piece is, by the numbers of the model file."""
        if self.kinds is not None:
            return list(self.kinds)
        fixed = [UNKNOWN if s == UNKNOWN_SYMBOL else CONTROL for s in self.control_symbols]
        fixed += [USER] * len(self.user_symbols) + [BYTE] * (256 if self.byte_fallback else 0)
        return fixed + [NORMAL] * (len(self.pieces) - len(fixed))

    def piece_scores(self) -> list[float]:
        """The higher, the earlier a piece is made."""
        if self.scores is not None:
            return list(self.scores)
        fixed = len(self.control_symbols) + len(self.user_symbols) + (256 if self.byte_fallback else 0)
        return [0.0] * fixed + [-float(i) for i in range(len(self.pieces) - fixed)]

    def normalization(self) -> dict[str, str]:
        """The texts that normalization replaces, by the longest match at each place."""
        return compatibility_rules() if self.rules is None else dict(self.rules)

    def table(self, spark: SparkSession) -> DataFrame:
        return spark.createDataFrame(list(enumerate(self.pieces)), "id int, piece string").select("piece", "id")


def byte_pieces() -> list[str]:
    return [f"<0x{b:02X}>" for b in range(256)]


def compatible(word: str) -> str:
    """The word after normalization."""
    if word.isascii() and word.isprintable():
        return word
    parts = word.translate(_CONTROL_MAP).split(_KEPT)
    return _KEPT.join(unicodedata.normalize("NFKC", p).translate(_CONTROL_MAP) for p in parts)


@cache
def compatibility_rules() -> dict[str, str]:
    """What normalization replaces: single characters, and sequences that compose to one."""
    rules = {}
    for code in range(1, 0x110000):
        if 0xD800 <= code < 0xE000:
            continue
        char = chr(code)
        made = compatible(char)
        if made != char:
            rules[char] = made
        apart = unicodedata.normalize("NFD", char)
        if len(apart) > 1 and unicodedata.normalize("NFC", apart) == char:
            rules[apart] = made
            begun = unicodedata.normalize("NFC", apart[:-1])
            if len(begun) == 1:
                rules[begun + apart[-1]] = made
    return rules


@F.pandas_udf(StringType())
def _normalized(words: pd.Series) -> pd.Series:
    return words.map(compatible)


def marked_words(
    df: DataFrame,
    col: str,
    user_symbols: Sequence[str] = USER_SYMBOLS,
    max_line_bytes: int | None = None,
) -> DataFrame:
    """``word, n``: counted before they are normalized, so that each distinct word is normalized once.

    A symbol named by the user is a boundary. ``max_line_bytes`` leaves out longer lines.
    """
    lines = df
    if max_line_bytes is not None:
        lines = lines.where(F.octet_length(col) <= max_line_bytes)
    raw = lines.select(F.explode(F.split(F.col(col), "[ \t\n\r]+")).alias("word"))
    counted = raw.where(F.col("word") != "").groupBy("word").agg(F.count("*").alias("n"))
    clean = counted.select(F.explode(F.split(_normalized("word"), " +")).alias("word"), "n")
    whole = clean.where(F.col("word") != "").select(F.concat(F.lit(MARK), "word").alias("word"), "n")
    if user_symbols:
        cut = "|".join(re.escape(u) for u in sorted(user_symbols, key=len, reverse=True))
        whole = whole.select(F.explode(F.split("word", cut)).alias("word"), "n").where(F.col("word") != "")
    return whole.groupBy("word").agg(F.sum("n").alias("n"))


def covered_characters(words: DataFrame, coverage: float = 0.9995) -> DataFrame:
    """``symbol, n, rank``: the most frequent characters, until their share reaches the coverage.

    The running share goes over at most 1,114,112 characters, whatever the size of the corpus.
    """
    order = Window.orderBy(F.desc("n"), F.asc("symbol"))
    before = F.sum("n").over(order.rowsBetween(Window.unboundedPreceding, -1))
    total = F.sum("n").over(Window.partitionBy())
    counted = characters(words).withColumn("_share", F.coalesce(before, F.lit(0)) / total)
    return (
        counted.withColumn("rank", F.row_number().over(order) - 1)
        .where(F.col("_share").cast("float") < F.lit(coverage).cast("float"))
        .drop("_share")
    )


def _script_runs(spark: SparkSession, split_digits: bool) -> str:
    """A pattern for the parts of a word that merges may join: one script, digits on their own."""
    names = [s.toString() for s in spark._jvm.java.lang.Character.UnicodeScript.values()]
    digits = "0-9" if split_digits else ""
    common = f"[\\p{{IsCOMMON}}&&[^{digits}{MARK}\\x{{30FC}}]]+"
    han = "[" + "".join(f"\\p{{Is{n}}}" for n in _HAN_GROUP) + "\\x{30FC}]+"
    single = [f"\\p{{Is{n}}}+" for n in names if n not in (*_HAN_GROUP, "COMMON", "LATIN", "UNKNOWN")]
    runs = "|".join(["\\p{IsLATIN}+", common, han, *single])
    return (f"[{digits}]|" if digits else "") + f"{MARK}?(?:{runs})|{MARK}"


def mergeable_runs(words: DataFrame, chars: Sequence[str], split_digits: bool) -> DataFrame:
    """``symbols, n``: words cut where no merge may cross, with uncovered characters taken out."""
    pattern = _script_runs(words.sparkSession, split_digits)
    runs = words.select(F.explode(F.regexp_extract_all("word", F.lit(pattern), F.lit(0))).alias("run"), "n")
    class_of = "".join(f"\\x{{{ord(c):x}}}" for c in chars)
    covered = F.regexp_extract_all("run", F.lit(f"[{class_of}]+"), F.lit(0))
    parts = runs.select(F.explode(covered).alias("part"), "n").where(F.length("part") > 1)
    return (
        parts.groupBy("part").agg(F.sum("n").alias("n")).select(F.split("part", "").alias("symbols"), "n")
    )


class _PieceRule(MergeRule):
    """Frequency, then the shorter piece, then text order; each text is made one way only."""

    def __init__(self, n_merges: int):
        self.n_merges = n_merges
        self.pieces: dict[str, None] = {}

    def rank(self, n, pair):
        text = pair[0] + pair[1]
        return (-n, len(text), text, pair[0])

    def allowed(self, pair):
        return len(pair[0]) + len(pair[1]) <= MAX_PIECE

    def merge(self, pair):
        text = pair[0] + pair[1]
        if text in self.pieces:
            return None
        self.pieces[text] = None
        return text, False

    def full(self):
        return len(self.pieces) >= self.n_merges


def train_pieces(
    df: DataFrame,
    col: str = "content",
    vocab_size: int = 32000,
    coverage: float = 0.9995,
    byte_fallback: bool = True,
    split_digits: bool = True,
    control_symbols: Sequence[str] = CONTROL_SYMBOLS,
    user_symbols: Sequence[str] = USER_SYMBOLS,
    max_line_bytes: int | None = None,
    merges_per_round: int = 8192,
) -> PieceModel:
    """Learn a piece vocabulary from one text per row.

    The default reads texts whole; ``max_line_bytes=LIBRARY_LINE_BYTES`` skips long lines as the
    usual library does.
    """
    spark = df.sparkSession
    words = written(marked_words(spread(df.select(col)), col, user_symbols, max_line_bytes), "piece-words")
    chars = [r.symbol for r in covered_characters(words, coverage).orderBy("rank").collect()]
    fixed = [*control_symbols, *user_symbols, *(byte_pieces() if byte_fallback else [])]
    n_merges = vocab_size - len(fixed) - len(chars)
    if n_merges < 0:
        raise ValueError(f"vocab_size must be at least {len(fixed) + len(chars)}")
    rule = _PieceRule(n_merges)

    def best_pairs(state: DataFrame, k: int, mergeable: bool) -> list:
        text = F.concat("left", "right")
        counts = pair_counts(state).where(F.length(text) <= MAX_PIECE)
        if mergeable and rule.pieces:
            # The made pieces are bounded by the vocabulary size.
            made = spark.createDataFrame([(p,) for p in rule.pieces], "piece string")
            counts = counts.join(F.broadcast(made), text == F.col("piece"), "left_anti")
        return counts.orderBy(F.desc("n"), F.length(text), text, "left").limit(k).collect()

    if n_merges:
        runs = mergeable_runs(spread(words), chars, split_digits)
        merge_rounds(WordTable(runs), rule, best_pairs, merges_per_round)
    return PieceModel(
        (*fixed, *rule.pieces, *chars), len(rule.pieces), tuple(control_symbols), tuple(user_symbols), byte_fallback
    )
