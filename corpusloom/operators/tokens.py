"""Applying a learned vocabulary, and laying out token rows for causal training."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType

from corpusloom.functions.batches import in_parts
from corpusloom.functions.words import byte_alphabet
from corpusloom.operators.bpe import BpeModel, Merge
from corpusloom.operators.merging import MergeTable, merge_words
from corpusloom.operators.positions import batch_of_n
from corpusloom.session import written

MAX_LENGTH = 8192
LABEL_IGNORED = -100
# Bytes of word lists encoded at a time; the arrays made of them are some twenty times as large.
_ENCODED_BYTES = 1 << 22


def split_special(col: Column, special: Sequence[str], split) -> Column:
    """Words of a text in which special tokens stand on their own.

    The common text holds no special token and takes the plain split.
    """
    if not special:
        return split(col)
    longest_first = sorted(special, key=len, reverse=True)
    token = "|".join(re.escape(t) for t in longest_first)
    pieces = F.regexp_extract_all(col, F.lit(f"(?s){token}|(?:(?!{token}).)+"), F.lit(0))
    words = F.flatten(
        F.transform(
            pieces,
            lambda p: F.when(p.isin(list(special)), F.array(p)).otherwise(split(p)),
        )
    )
    found = F.lit(False)
    for t in special:
        found = found | F.contains(col, F.lit(t))
    return F.when(found, words).otherwise(split(col))


class _WordEncoder:
    """Ids of the words of a batch, by array operations."""

    def __init__(self, tokens: Sequence[str], merges: Sequence[Merge], special: Sequence[str], words: str):
        ids = {t: i for i, t in enumerate(tokens)}
        self.special = {t: ids[t] for t in special}
        self.table = MergeTable(merges)
        # The starting id of each code point, or of each byte; -1 for one outside the vocabulary.
        if words == "bytes":
            self.encoding, self.unit = "utf-8", np.uint8
            self.first = np.array([ids.get(c, -1) for c in byte_alphabet()], dtype=np.int32)
        else:
            self.encoding, self.unit = "utf-32-le", np.uint32
            self.first = np.full(0x110000, -1, dtype=np.int32)
            for i, t in enumerate(tokens):
                if len(t) == 1:
                    self.first[ord(t)] = i

    def __call__(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all words one after the other, and how many each word has.

        What is outside the vocabulary is dropped; a special token is one id.
        """
        spelled = [b"" if w in self.special else w.encode(self.encoding) for w in words]
        ids = self.first[np.frombuffer(b"".join(spelled), dtype=self.unit)]
        units = np.fromiter(map(len, spelled), np.int64, len(spelled)) // self.unit().itemsize
        owner = np.repeat(np.arange(len(words)), units)
        known = ids >= 0
        flat, size = merge_words(ids[known], np.bincount(owner[known], minlength=len(words)), self.table)
        whole = [i for i, w in enumerate(words) if w in self.special]
        if whole:
            starts = np.concatenate(([0], np.cumsum(size)))
            flat = np.insert(flat, starts[whole], [self.special[words[i]] for i in whole])
            size[whole] = 1
        return flat, size


def _encode_lists(words: pa.ListArray, encoder: _WordEncoder) -> pa.ListArray:
    """Encode each distinct word of a batch once, then put the ids together by array indexing."""
    missing = words.is_null().to_numpy(zero_copy_only=False)
    counts = np.nan_to_num(words.value_lengths().to_numpy(zero_copy_only=False)).astype(np.int64)
    distinct = words.flatten().dictionary_encode()
    pool, size = encoder(distinct.dictionary.to_pylist())
    start = np.concatenate(([0], np.cumsum(size)))
    which = distinct.indices.to_numpy(zero_copy_only=False)
    out_size = size[which]
    out_ends = np.concatenate(([0], np.cumsum(out_size)))
    places = np.arange(out_ends[-1]) + np.repeat(start[which] - out_ends[:-1], out_size)
    row_ends = out_ends[np.concatenate(([0], np.cumsum(counts)))]
    offsets = pa.array(row_ends, pa.int32())
    return pa.ListArray.from_arrays(
        offsets, pa.array(pool[places].astype(np.int32), pa.int32()), mask=pa.array(missing) if missing.any() else None
    )


def encode(
    df: DataFrame,
    col: str,
    model: BpeModel,
    max_length: int | None = MAX_LENGTH,
    on_error: str = "skip",
    out: str = "input_ids",
) -> DataFrame:
    """Add the token ids of a text column: a narrow job with no shuffle.

    A row without a text has no ids: ``on_error='skip'`` drops it, ``'keep'`` leaves null ids and an
    ``error``.
    """
    texts = df.where(F.col(col).isNotNull()) if on_error == "skip" else df
    words = split_special(F.col(col), model.special, model.splitter())
    encoded = texts.withColumn(out, encode_words(df.sparkSession, words, model, max_length))
    if on_error == "skip":
        return encoded
    return encoded.withColumn("error", F.when(F.col(out).isNull(), "no text"))


def encode_words(spark: SparkSession, words: Column, model: BpeModel, max_length: int | None) -> Column:
    """Ids of a column of word lists.

    Words are split on the JVM; Python sees only the word lists, as Arrow arrays, and encodes each
    distinct word of a batch once. The model is bounded by its vocabulary size and shipped as a
    broadcast.
    """
    shipped = spark.sparkContext.broadcast((model.tokens, model.merges, model.special, model.words))

    @F.arrow_udf(ArrayType(IntegerType()))
    def ids_of(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        encoder = _WordEncoder(*shipped.value)
        for lists in in_parts(batches, _ENCODED_BYTES):
            ids = _encode_lists(lists, encoder)
            yield ids if max_length is None else pc.list_slice(ids, 0, max_length)

    # Marked so that later filters stay above it and no row is encoded twice.
    return ids_of.asNondeterministic()(words)


def truncate(col: Column, n: int = MAX_LENGTH) -> Column:
    """The first ``n`` ids."""
    return F.slice(col, 1, n)


def pad_to(col: Column, n: int, pad_id: int = 1) -> Column:
    """Exactly ``n`` ids: cut, or padded on the right."""
    cut = F.slice(col, 1, n)
    return F.concat(cut, F.array_repeat(F.lit(pad_id), F.greatest(F.lit(n) - F.size(cut), F.lit(0))))


def causal_batch(df: DataFrame, order, n: int, pad_id: int = 1, col: str = "input_ids") -> DataFrame:
    """Consecutive rows in batches of ``n``, each padded to its longest row.

    Adds ``batch``, ``attention_mask`` and ``labels`` (the ids, with the pad id replaced by -100).
    A batch has ``n`` rows, so the window over it stays small. Ids are written once and moved once; places
    and widths come from the other columns and the sizes.
    """
    rows = written(df.withColumn("_row", F.monotonically_increasing_id()), "causal-rows")
    keys = [order] if isinstance(order, (str, Column)) else list(order)
    sizes = rows.withColumn("_size", F.size(col))
    try:
        narrow = sizes.drop(col)
        narrow.sort(*keys)
    except AnalysisException:  # the order goes by the ids themselves
        narrow = sizes
    widest = F.max("_size").over(Window.partitionBy("batch"))
    # Ties keep their input order.
    placed = batch_of_n(narrow, [*keys, "_row"], n).select("_row", "batch", "_size", widest.alias("_width"))
    sized = rows.join(placed.hint("shuffle_hash"), "_row").select(*df.columns, "batch", "_size", "_width")
    gap = F.col("_width") - F.col("_size")
    pad = F.array_repeat(F.lit(pad_id), gap)
    padded = sized.withColumn(col, F.concat(F.col(col), pad)).withColumn(
        "attention_mask",
        F.concat(F.array_repeat(F.lit(1), F.col("_size")), F.array_repeat(F.lit(0), gap)),
    )
    labels = F.transform(col, lambda x: F.when(x == pad_id, LABEL_IGNORED).otherwise(x))
    return padded.withColumn("labels", labels).drop("_size", "_width")


def decode(
    df: DataFrame, ids_col: str, model: BpeModel, skip_special: bool = True, out: str = "content"
) -> DataFrame:
    """Ids to text, tokens joined by a space.

    The vocabulary enters the plan as one constant array, so this stays on the JVM.
    """
    tokens = F.from_json(F.lit(json.dumps(list(model.tokens))), "array<string>")
    ids = F.col(ids_col)
    if skip_special:
        special = [i for i, t in enumerate(model.tokens) if t in model.special]
        ids = F.filter(ids, lambda i: ~i.isin(special)) if special else ids
    return df.withColumn(out, F.array_join(F.transform(ids, lambda i: F.get(tokens, i)), " "))
