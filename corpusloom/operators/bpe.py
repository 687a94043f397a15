"""Byte-pair vocabulary learning over the word counts of a corpus.

The corpus is reduced once to distinct words with counts. Words then live in a distributed table of
symbol ids and the rule is the usual one: merge the most frequent adjacent pair, ties to the smaller
left id and then the smaller right id, until the vocabulary is full or the best count is too low.

One Spark round settles many merges at once, exactly:

1. Pair counts are aggregated; the best ``K`` pairs are *hot*, the next one is the *floor*.
2. Words are cut at every pair that is not hot, and equal pieces are summed. This digest is all that
   merges above the floor can touch: a pair across a cut can only grow out of the pair that was cut,
   so it counts no more than that pair, and at equal count its ids are larger. It ranks below the
   floor.
3. The order of merges is worked out on the digest until the best pair ranks below the floor. A
   merge whose text is already a token reuses that token's id, which breaks the argument in 2 for
   later pairs, so it ends the round.
4. The merges are applied to the word table, which is written to the shared folder.

The digest is only brought to the driver within a fixed size (``DIGEST_ROWS`` pieces with
``DIGEST_SYMBOLS`` symbols in all, so a few very long runs do no harm). When it is larger, ``K`` is
lowered. Where even ``NARROW`` pairs have too large a digest, a round takes none: the counts of what stands left and
right of the ``BOUNDED`` best pairs are summed on the executors. A pair that a merge makes counts no more than the
most frequent neighbour of the merged pair, and a pair loses no more than its overlaps, so the merges up to the
first that such a pair could outrank are settled.
"""

from __future__ import annotations

import heapq
import json
from collections import defaultdict
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from corpusloom.functions.words import pretokenize_ws, split_bytes, to_byte_text
from corpusloom.operators.merging import MergeTable, merge_words
from corpusloom.operators.profile import word_counts
from corpusloom.session import scratch_path, spread, written

# Special tokens in id order.
SPECIAL_TOKENS = ("<s>", "<pad>", "</s>", "<unk>", "<mask>")
DIGEST_ROWS = 100_000
DIGEST_SYMBOLS = 4_000_000
# Pairs looked at in the first round; later rounds widen while the digest stays small.
_FIRST_WIDTH = 64
# The narrowest digest, the pairs looked at without one, and the rounds until a digest is tried again.
NARROW = 16
BOUNDED = 1024
_ROUNDS_BOUNDED = 8
# Working ids: a character is its code point, merges follow, special tokens come before. The order
# of working ids equals the order of the final ids.
_FIRST_MERGE = 0x110000
# A vocabulary larger than this is refused rather than brought to the driver.
MAX_VOCAB = 2_000_000

Merge = tuple[int, int, int]


@dataclass(frozen=True)
class BpeModel:
    """A learned vocabulary: tokens in id order and merges (left id, right id, new id) by rank."""

    tokens: tuple[str, ...]
    merges: tuple[Merge, ...]
    special: tuple[str, ...] = SPECIAL_TOKENS
    words: str = "ws"
    add_prefix_space: bool = True

    def splitter(self) -> Callable[[Column], Column]:
        return splitter(self.words, self.add_prefix_space)

    def vocab_table(self, spark: SparkSession) -> DataFrame:
        special = set(self.special)
        rows = [(t, i, t in special) for i, t in enumerate(self.tokens)]
        return spark.createDataFrame(rows, "token string, id int, special boolean")

    def merge_table(self, spark: SparkSession) -> DataFrame:
        text = self.tokens
        rows = [
            (rank, text[a], text[b], text[c], a, b, c) for rank, (a, b, c) in enumerate(self.merges)
        ]
        return spark.createDataFrame(
            rows,
            "rank int, left string, right string, merged string, left_id int, right_id int, id int",
        )


def splitter(words: str, add_prefix_space: bool = True) -> Callable[[Column], Column]:
    """The word split of a model; byte-level words are still plain text here."""
    if words == "ws":
        return pretokenize_ws
    if words == "bytes":
        return lambda col: split_bytes(col, add_prefix_space)
    raise ValueError(f"unknown word rule {words!r}")


def save_tokenizer(model: BpeModel, spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
    """Three small tables: vocabulary, merges, options."""
    model.vocab_table(spark).write.mode(mode).parquet(f"{path}/vocab")
    model.merge_table(spark).write.mode(mode).parquet(f"{path}/merges")
    options = [(list(model.special), model.words, model.add_prefix_space)]
    spark.createDataFrame(
        options, "special array<string>, words string, add_prefix_space boolean"
    ).write.mode(mode).parquet(f"{path}/options")


def tokenizer_json(model: BpeModel) -> str:
    """The model in the file format of the ``tokenizers`` library, for tools that read one file."""
    special = [t for t in model.tokens if t in set(model.special)]
    ids = {t: i for i, t in enumerate(model.tokens)}
    flags = {"single_word": False, "lstrip": False, "rstrip": False, "normalized": False, "special": True}
    if model.words == "ws":
        split, decoder = {"type": "Whitespace"}, None
    else:
        split = {"type": "ByteLevel", "add_prefix_space": model.add_prefix_space, "trim_offsets": True, "use_regex": True}
        decoder = split
    bpe = {
        "type": "BPE", "dropout": None, "unk_token": "<unk>" if "<unk>" in ids else None, "continuing_subword_prefix": None,
        "end_of_word_suffix": None, "fuse_unk": False, "byte_fallback": False, "ignore_merges": False, "vocab": ids,
        "merges": [[model.tokens[a], model.tokens[b]] for a, b, _ in model.merges],
    }
    return json.dumps({
        "version": "1.0", "truncation": None, "padding": None, "added_tokens": [{"id": ids[t], "content": t, **flags} for t in special],
        "normalizer": None, "pre_tokenizer": split, "post_processor": None, "decoder": decoder, "model": bpe,
    }, ensure_ascii=False)


def save_tokenizer_json(model: BpeModel, spark: SparkSession, path: str, mode: str = "errorifexists") -> None:
    """One text file with that format, in the folder ``path``."""
    spark.createDataFrame([(tokenizer_json(model),)], "value string").coalesce(1).write.mode(mode).text(path)


def load_tokenizer(spark: SparkSession, path: str) -> BpeModel:
    vocab = spark.read.parquet(f"{path}/vocab")
    if vocab.count() > MAX_VOCAB:
        raise ValueError(f"vocabulary over {MAX_VOCAB} tokens")
    tokens = [r.token for r in vocab.orderBy("id").collect()]
    merge_rows = spark.read.parquet(f"{path}/merges")
    if merge_rows.count() > MAX_VOCAB:
        raise ValueError(f"over {MAX_VOCAB} merges")
    rows = merge_rows.orderBy("rank").collect()
    merges = tuple((r.left_id, r.right_id, r.id) for r in rows)
    options = spark.read.parquet(f"{path}/options").first()
    return BpeModel(tuple(tokens), merges, tuple(options.special), options.words, options.add_prefix_space)


def special_tokens(spark: SparkSession, special: Sequence[str] = SPECIAL_TOKENS) -> DataFrame:
    return spark.createDataFrame(list(enumerate(special)), "id int, token string").select("token", "id")


def characters(words: DataFrame) -> DataFrame:
    """Each character of the words with its weighted count; at most one row per code point."""
    return (
        words.select(F.explode(F.split("word", "")).alias("symbol"), "n")
        .groupBy("symbol")
        .agg(F.sum("n").alias("n"))
    )


def alphabet(words: DataFrame, special: Sequence[str] = SPECIAL_TOKENS) -> DataFrame:
    """``token, id``: special tokens first, then every character in code-point order.

    The ranking runs over at most 1,114,112 characters, whatever the size of the corpus.
    """
    rank = F.row_number().over(Window.orderBy("symbol")) - 1 + len(special)
    known = F.col("symbol").isin(list(special))
    chars = characters(words).where(~known).select(F.col("symbol").alias("token"), rank.alias("id"))
    return special_tokens(words.sparkSession, special).unionByName(chars)


def with_symbols(words: DataFrame, special: Sequence[str] = ()) -> DataFrame:
    """Words as code points, the starting symbols; a one-character special token has its own id."""
    known = {ord(t): i - len(special) for i, t in enumerate(special) if len(t) == 1}

    def symbol(char: Column) -> Column:
        code = F.ascii(char)
        for c, i in known.items():
            code = F.when(F.ascii(char) == c, i).otherwise(code)
        return code

    return words.select(F.transform(F.split("word", ""), symbol).alias("symbols"), "n")


def pair_counts(words: DataFrame, symbols: str = "symbols", n: str = "n") -> DataFrame:
    """Adjacent pairs with the summed count of the words they occur in."""
    size = F.size(symbols)
    pairs = F.arrays_zip(
        F.slice(symbols, 1, size - 1).alias("left"), F.slice(symbols, 2, size - 1).alias("right")
    )
    return (
        words.where(size > 1)
        .select(F.col(n).alias("n"), F.inline(pairs).alias("left", "right"))
        .groupBy("left", "right")
        .agg(F.sum("n").alias("n"))
    )


def _flat(batch: pa.RecordBatch) -> tuple[pa.Array, np.ndarray]:
    """All symbols of a batch one after the other, and where each word ends."""
    column = batch.column("symbols")
    lengths = column.value_lengths().to_numpy(zero_copy_only=False)
    return column.flatten(), np.concatenate(([0], np.cumsum(lengths)))


def _hot_joints(flat: pa.Array, ends: np.ndarray, hot: Sequence[tuple]) -> np.ndarray:
    """For each place between two symbols, whether it is a hot pair inside one word."""
    if len(flat) < 2:
        return np.zeros(0, dtype=bool)
    coded = flat.dictionary_encode()
    code = {symbol: c for c, symbol in enumerate(coded.dictionary.to_pylist())}
    width = len(code)
    keys = [code[a] * width + code[b] for a, b in hot if a in code and b in code]
    codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
    joints = np.isin(codes[:-1] * width + codes[1:], np.array(keys, dtype=np.int64))
    inner = ends[1:-1]
    joints[inner[(inner > 0) & (inner < len(flat))] - 1] = False
    return joints


def hot_pieces(words: DataFrame, hot: Sequence[tuple]) -> DataFrame:
    """Words cut at every pair that is not hot, pieces of one symbol left out, equal pieces summed."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = _flat(batch)
            joints = _hot_joints(flat, ends, hot)
            edges = np.diff(np.concatenate(([False], joints, [False])).astype(np.int8))
            first, last = np.flatnonzero(edges == 1), np.flatnonzero(edges == -1)
            size = last - first + 1
            stops = np.concatenate(([0], np.cumsum(size)))
            places = np.arange(stops[-1]) + np.repeat(first - stops[:-1], size)
            owner = np.searchsorted(ends, first, side="right") - 1
            counts = batch.column("n").to_numpy(zero_copy_only=False)[owner]
            pieces = pa.ListArray.from_arrays(pa.array(stops, pa.int32()), flat.take(pa.array(places)))
            yield pa.RecordBatch.from_arrays([pieces, pa.array(counts, pa.int64())], ["symbols", "n"])

    return words.mapInArrow(cut, words.schema).groupBy("symbols").agg(F.sum("n").alias("n"))


def join_pair(symbols: list, pair: tuple, merged) -> list:
    """One merge in one word, left to right."""
    out, i = [], 0
    while i < len(symbols):
        if i + 1 < len(symbols) and (symbols[i], symbols[i + 1]) == pair:
            out.append(merged)
            i += 2
        else:
            out.append(symbols[i])
            i += 1
    return out


def apply_merges(words: DataFrame, merges: Sequence[tuple]) -> DataFrame:
    """Words after the given merges ``(left, right, merged)``; fully merged words leave the table."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = _flat(batch)
            coded = flat.dictionary_encode()
            symbols = list(dict.fromkeys([*coded.dictionary.to_pylist(), *(s for m in merges for s in m)]))
            code = {symbol: c for c, symbol in enumerate(symbols)}
            table = MergeTable([(code[a], code[b], code[c]) for a, b, c in merges])
            codes = coded.indices.to_numpy(zero_copy_only=False)
            merged, lengths = merge_words(codes, np.diff(ends), table)
            offsets = pa.array(np.concatenate(([0], np.cumsum(lengths))), pa.int32())
            made = pa.array(symbols, flat.type).take(pa.array(merged))
            lists = pa.ListArray.from_arrays(offsets, made)
            yield pa.RecordBatch.from_arrays([lists, batch.column("n")], ["symbols", "n"])

    return words.mapInArrow(run, words.schema).where(F.size("symbols") > 1)


class MergeRule:
    """What a merge loop counts, how it ranks pairs, and when it stops."""

    min_count = 1

    def pairs(self, symbols: list) -> list[tuple]:
        """The pairs of a word that count."""
        return list(zip(symbols, symbols[1:]))

    def rank(self, n: int, pair: tuple) -> tuple:
        """Sort key of a pair, best first."""
        raise NotImplementedError

    def allowed(self, pair: tuple) -> bool:
        return True

    def merge(self, pair: tuple):
        """The merged symbol and whether the round must end after it; None if it may not merge."""
        raise NotImplementedError

    def full(self) -> bool:
        raise NotImplementedError


class _BpeRule(MergeRule):
    """Token texts by working id, on the driver; at most ``vocab_size`` entries."""

    def __init__(self, special: Sequence[str], chars: Sequence[str], vocab_size: int, min_count: int):
        self.vocab_size = vocab_size
        self.min_count = min_count
        self.special = list(special)
        self.text = {i - len(special): t for i, t in enumerate(special)}
        self.ids = {t: i for i, t in self.text.items()}
        self.chars = [c for c in chars if c not in self.ids]
        for c in self.chars:
            self.text[ord(c)] = c
            self.ids[c] = ord(c)
        self.new: list[str] = []

    def rank(self, n, pair):
        return (-n, *pair)

    def merge(self, pair):
        joined = self.text[pair[0]] + self.text[pair[1]]
        if joined in self.ids:
            return self.ids[joined], True
        new = _FIRST_MERGE + len(self.new)
        self.new.append(joined)
        self.text[new] = joined
        self.ids[joined] = new
        return new, False

    def full(self):
        return len(self.ids) >= self.vocab_size

    def final(self, merges: Sequence[Merge]) -> tuple[tuple[str, ...], tuple[Merge, ...]]:
        tokens = (*self.special, *self.chars, *self.new)
        number = {self.ids[t]: i for i, t in enumerate(tokens)}
        return tokens, tuple((number[a], number[b], number[c]) for a, b, c in merges)


def settle(digest, floor: tuple | None, rule: MergeRule) -> tuple[list[tuple], bool]:
    """Merges in order, worked out on the digest, and whether training is over.

    ``floor`` is the rank of the best pair outside the digest, or None.
    """
    words = [list(s) for s, _ in digest]
    weight = [n for _, n in digest]
    counts: dict[tuple, int] = defaultdict(int)
    where: dict[tuple, set[int]] = defaultdict(set)
    for i, symbols in enumerate(words):
        for pair in rule.pairs(symbols):
            counts[pair] += weight[i]
            where[pair].add(i)
    heap = [(rule.rank(n, pair), pair) for pair, n in counts.items() if rule.allowed(pair)]
    heapq.heapify(heap)
    merges: list[tuple] = []
    while heap:
        if rule.full():
            return merges, True
        key, pair = heapq.heappop(heap)
        n = counts[pair]
        if -key[0] != n:
            if n > 0:
                heapq.heappush(heap, (rule.rank(n, pair), pair))
            continue
        if n < rule.min_count:
            break
        if floor is not None and key > floor:
            return merges, False
        outcome = rule.merge(pair)
        if outcome is None:
            continue
        new, last = outcome
        merges.append((*pair, new))
        if last:
            return merges, rule.full()
        raised = set()
        for i in where.pop(pair):
            old = words[i]
            words[i] = join_pair(old, pair, new)
            for p in rule.pairs(old):
                counts[p] -= weight[i]
            for p in rule.pairs(words[i]):
                counts[p] += weight[i]
                where[p].add(i)
                if new in p:
                    raised.add(p)
        counts[pair] = 0
        for p in raised:
            if rule.allowed(p):
                heapq.heappush(heap, (rule.rank(counts[p], p), p))
    return merges, floor is None


class WordTable:
    """The word table of the current round, kept in two alternating folders.

    A round reads one folder and writes the other, so a lost executor only repeats tasks and old
    states do not pile up.
    """

    def __init__(self, words: DataFrame):
        self.spark = words.sparkSession
        self.base = scratch_path(self.spark, "bpe-words")
        self.slot = 0
        self._write(words)
        even = spread(self.words)
        if even is not self.words:
            # A small table is written as one or two files; the merges run in Python on all cores.
            self._write(even)

    def _write(self, words: DataFrame) -> None:
        path = f"{self.base}/{self.slot}"
        words.write.mode("overwrite").parquet(path)
        self.words = self.spark.read.schema(words.schema).parquet(path)
        self.slot = 1 - self.slot

    def merge(self, merges: Sequence[tuple]) -> None:
        self._write(apply_merges(self.words, merges))


def neighbour_counts(words: DataFrame, pairs: Sequence[tuple]) -> DataFrame:
    """``pair, side, symbol, n``: what stands before (0) and after (1) each of the pairs, by their number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            flat, ends = _flat(batch)
            coded = flat.dictionary_encode()
            code = {symbol: c for c, symbol in enumerate(coded.dictionary.to_pylist())}
            width = len(code)
            known = sorted((code[a] * width + code[b], i) for i, (a, b) in enumerate(pairs) if a in code and b in code)
            if not known or len(flat) < 3:
                continue
            keys, numbers = (np.array(c, dtype=np.int64) for c in zip(*known))
            codes = coded.indices.to_numpy(zero_copy_only=False).astype(np.int64)
            owner = np.repeat(np.arange(len(ends) - 1), np.diff(ends))
            joints = codes[:-1] * width + codes[1:]
            at = np.minimum(np.searchsorted(keys, joints), len(keys) - 1)
            places = np.flatnonzero((keys[at] == joints) & (owner[:-1] == owner[1:]))
            number = numbers[at[places]]
            before = (places > 0) & (owner[places - 1] == owner[places])
            follows = np.minimum(places + 2, len(flat) - 1)
            after = (places + 2 < len(flat)) & (owner[follows] == owner[places])
            cells = np.concatenate([
                (number[before] * 2) * width + codes[places[before] - 1], (number[after] * 2 + 1) * width + codes[follows[after]]
            ])
            weights = batch.column("n").to_numpy(zero_copy_only=False)
            n = np.concatenate([weights[owner[places[before]]], weights[owner[places[after]]]])
            found, back = np.unique(cells, return_inverse=True)
            sums = np.zeros(len(found), np.int64)
            np.add.at(sums, back, n)
            which = found // width
            yield pa.RecordBatch.from_arrays(
                [pa.array(which // 2), pa.array(which % 2), coded.dictionary.take(pa.array(found % width)), pa.array(sums)],
                ["pair", "side", "symbol", "n"],
            )

    symbol = words.schema["symbols"].dataType.elementType.simpleString()
    counted = words.mapInArrow(count, f"pair long, side long, symbol {symbol}, n long")
    return counted.groupBy("pair", "side", "symbol").agg(F.sum("n").alias("n"))


def settle_by_bounds(words: DataFrame, best: list, rule: MergeRule) -> list[tuple]:
    """The merges of the best pairs, in order, that no pair made by them can outrank; no digest is needed.

    ``best`` holds at most ``BOUNDED`` rows, so what is brought to the driver is at most a number for each and
    the overlaps among them.
    """
    pairs = [(r.left, r.right) for r in best]
    around = written(neighbour_counts(words, pairs), "pair-neighbours")
    bound = {r.pair: r.n for r in around.groupBy("pair").agg(F.max("n").alias("n")).collect()}
    symbol = around.schema["symbol"].dataType.simpleString()
    known = words.sparkSession.createDataFrame(
        [(i, a, b) for i, (a, b) in enumerate(pairs)], f"number long, left {symbol}, right {symbol}"
    )
    own = F.broadcast(known.select(F.col("number").alias("pair"), F.col("right").alias("left")))
    other = F.broadcast(known.select("left", F.col("right").alias("symbol"), "number"))
    overlaps: dict[int, list[tuple[int, int]]] = defaultdict(list)
    for r in around.where("side = 1").join(own, "pair").join(other, ["left", "symbol"]).select("pair", "number", "n").collect():
        overlaps[r.pair].append((r.number, r.n))
        overlaps[r.number].append((r.pair, r.n))
    merges: list[tuple] = []
    taken: set[int] = set()
    # The most that a pair still to come, or one that has lost some of its places, can count.
    rival = 0
    for i, (pair, row) in enumerate(zip(pairs, best)):
        twice = pair[0] == pair[1]
        if row.n < rule.min_count or row.n <= rival or rule.full() or (twice and merges):
            break
        lost = max((n for j, n in overlaps[i] if j in taken), default=0)
        if lost:
            rival = max(rival, row.n - lost)
            continue
        outcome = rule.merge(pair)
        if outcome is None:
            continue
        merges.append((*pair, outcome[0]))
        if outcome[1] or twice:
            break
        taken.add(i)
        rival = max(rival, bound.get(i, 0))
    return merges


def _digest(state: WordTable, hot: list[tuple]):
    """The digest as a list, or None when it is over its fixed size, which is measured first."""
    path = f"{state.base}/digest"
    pieces = hot_pieces(state.words, hot)
    pieces.write.mode("overwrite").parquet(path)
    pieces = state.spark.read.schema(pieces.schema).parquet(path)
    size = pieces.agg(F.count("*").alias("rows"), F.coalesce(F.sum(F.size("symbols")), F.lit(0)).alias("symbols")).first()
    if size.rows > DIGEST_ROWS or size.symbols > DIGEST_SYMBOLS:
        return None
    return [(r.symbols, r.n) for r in pieces.collect()]


def merge_rounds(
    state: WordTable,
    rule: MergeRule,
    best_pairs: Callable[[DataFrame, int, bool], list],
    merges_per_round: int,
) -> list[tuple]:
    """Rounds until the rule is satisfied.

    ``best_pairs(words, k, mergeable)`` returns the ``k`` best rows ``left, right, n`` in rank order,
    with ``mergeable`` only those that the rule would merge.
    """
    merges: list[tuple] = []
    width, bounded = min(_FIRST_WIDTH, merges_per_round), 0
    while not rule.full():
        done, growth, finished = None, 4, False
        if bounded:
            bounded, growth = bounded - 1, 1
            done = settle_by_bounds(state.words, best_pairs(state.words, min(BOUNDED, merges_per_round), False), rule)
        elif width > 1:
            best = best_pairs(state.words, width + 1, False)
            pairs = [(r.left, r.right) for r in best]
            digest = _digest(state, pairs[:width]) if best else []
            if digest is None:
                if width <= NARROW:
                    bounded = _ROUNDS_BOUNDED
                width = min(width, max(width // 4, NARROW))
                continue
            floor = rule.rank(best[width].n, pairs[width]) if len(best) > width else None
            done, finished = settle(digest, floor, rule)
            growth = 4 if len(digest) * 8 < DIGEST_ROWS else 2
        if not done and (width == 1 or not finished):
            # One merge needs no digest: it is the best pair.
            one = best_pairs(state.words, 1, True)
            finished = not one
            done = [(p, rule.merge(p)[0]) for p in ((r.left, r.right) for r in one)]
            done = [(*p, new) for p, new in done]
        merges += done
        if finished or rule.full():
            break
        state.merge(done)
        width = min(width * growth, merges_per_round)
    return merges


def learn_merges(
    words: DataFrame,
    vocab_size: int,
    min_frequency: int,
    merges_per_round: int = 8192,
    special: Sequence[str] = SPECIAL_TOKENS,
) -> tuple[tuple[str, ...], tuple[Merge, ...]]:
    """Tokens and merges from a table ``word, n``.

    ``merges_per_round`` is the most pairs looked at in one round; 1 is the plain one-merge loop.
    """
    chars = [r.symbol for r in characters(words).select("symbol").orderBy("symbol").collect()]
    min_count = max(min_frequency, 1)
    rule = _BpeRule(special, chars, vocab_size, min_count)
    if rule.full():
        return rule.final([])

    def best_pairs(state: DataFrame, k: int, mergeable: bool) -> list:
        counts = pair_counts(state).where(F.col("n") >= min_count)
        return counts.orderBy(F.desc("n"), "left", "right").limit(k).collect()

    state = WordTable(with_symbols(spread(words), special).where(F.size("symbols") > 1))
    return rule.final(merge_rounds(state, rule, best_pairs, merges_per_round))


def bpe_train(
    df: DataFrame,
    col: str = "content",
    vocab_size: int = 8000,
    min_frequency: int = 1,
    merges_per_round: int = 8192,
    special: Sequence[str] = SPECIAL_TOKENS,
    words: str = "ws",
    add_prefix_space: bool = True,
) -> BpeModel:
    """Learn a byte-pair vocabulary from a text column.

    ``words='ws'`` splits on word boundaries, ``words='bytes'`` is the byte-level variant.
    """
    if vocab_size > MAX_VOCAB:
        raise ValueError(f"vocabulary over {MAX_VOCAB} tokens")
    counts = word_counts(spread(df.select(col)), col, pretokenize=splitter(words, add_prefix_space))
    if words == "bytes":
        # Spelled as bytes once per distinct word.
        counts = counts.withColumn("word", to_byte_text(F.col("word")))
    stored = written(counts, "bpe-counts")
    tokens, merges = learn_merges(stored, vocab_size, min_frequency, merges_per_round, special)
    return BpeModel(tokens, merges, tuple(special), words, add_prefix_space)
