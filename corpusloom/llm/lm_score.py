"""Language-model scoring by cross-entropy difference.

Two bigram models, one of a target and one of the background, are counted over every row. Words and pairs
of words are told apart by 64-bit hashes, so what is counted grows with the corpus. The
models are matched: the counts of the background are scaled to the target's number of words, and both are
smoothed alike over one vocabulary, that of all words seen and of ``2 ** WORD_BITS`` words at least. A
document's score is the mean over its words of target loss minus background loss, in nats: the lower, the
closer to the target.

Rows are packed into pieces of about ``PIECE_BYTES`` of text, and pieces dealt by chance into chunks of about
``CHUNK_BYTES``. Each chunk asks once for each of its distinct pairs,
words and words before: the sorted hashes, cut into ranges and packed, go with their counts to the task of a range, which
sums them and answers every chunk in the order in which it asked. So neither hashes nor counts are shuffled as rows,
a pair that occurs once costs a few bytes, and a frequent one is asked for once in a chunk. A chunk's texts are then read
again beside its answers. Both sizes are fixed, so the numbers of chunks and of ranges grow with the input.

Words are lower-cased A-Z between ASCII white space; the first word of a text follows a start mark. A
null or empty text has no words and null losses. Rows are scored as often as they come in; a null
``doc_id`` is background. Without any target row all scores compare equal models and are 0.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.llm.shingles import Shingler
from corpusloom.session import written

# The smoothed vocabulary has at least so many words. PAIR_BITS only serves ``cells``.
WORD_BITS, PAIR_BITS = 16, 18
# Texts of a piece and of a chunk (or one longer text), and texts whose keys one range of each kind receives on average, in bytes.
PIECE_BYTES, CHUNK_BYTES, RANGE_BYTES = 1 << 19, 8 << 20, 8 << 20
# Weight of the word model in the pair model, and of the uniform model in the word model.
PAIR_PRIOR, WORD_PRIOR = 20.0, 1.0
# Target ids that are broadcast, at most; beyond, documents are joined with them by a shuffle.
BROADCAST_IDS = 1_000_000

_PAIR = np.uint64(0x9E3779B97F4A7C15)
_START = np.uint64(0x94D049BB133111EB)
_PAIRS, _WORDS, _BEFORE = range(3)


# Cells of fixed tables: on few words, where hardly any two share one, they count what the models count.
_RANGES = ((0, 1 << WORD_BITS), (1 << WORD_BITS, 2 << WORD_BITS), (2 << WORD_BITS, (2 << WORD_BITS) + (1 << PAIR_BITS)))
_CELLS = _RANGES[-1][1]


def _before(words: np.ndarray) -> np.ndarray:
    """The word before each word of a text."""
    return np.concatenate([[_START], words[:-1]]).astype(np.uint64) if len(words) else words


def _pairs(before: np.ndarray, words: np.ndarray) -> np.ndarray:
    return ((before * _PAIR) ^ words) * _PAIR


def cells(words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The cells of a text's words, of the word before each, and of the pairs."""
    before = _before(words)
    mask = np.uint64((1 << WORD_BITS) - 1)
    return words & mask, before & mask, _pairs(before, words) >> np.uint64(64 - PAIR_BITS)


def _pieces(docs: DataFrame, target: DataFrame, text: str, doc_id: str, chunks: int) -> DataFrame:
    """``chunk, texts``: every row as ``doc_id, text, is_target`` in compressed pieces; ``target`` holds the ids of the target's documents."""
    ids = target.select(F.col(doc_id).alias("id")).where("id is not null").distinct().withColumn("is_target", F.lit(True))
    if ids.limit(BROADCAST_IDS + 1).count() <= BROADCAST_IDS:
        ids = F.broadcast(ids)
    rows = docs.select(F.col(f"`{doc_id}`").alias("id"), F.col(f"`{text}`").alias("text")).join(ids, "id", "left")
    rows = rows.select(F.col("id").cast("long").alias("doc_id"), "text", F.coalesce("is_target", F.lit(False)).alias("is_target"))
    size = PIECE_BYTES

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            bytes_ = np.cumsum(pc.fill_null(pc.binary_length(batch.column(1)), 0).to_numpy())
            starts = np.flatnonzero(np.diff(bytes_ // size, prepend=-1)).tolist()
            for a, b in zip(starts, [*starts[1:], batch.num_rows]):
                sink = pa.BufferOutputStream()
                with pa.ipc.new_stream(sink, batch.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
                    out.write_batch(batch.slice(a, b - a))
                yield pa.RecordBatch.from_arrays([pa.array([sink.getvalue().to_pybytes()], pa.binary())], ["texts"])

    # Written before its first use, so that a piece has the same chunk in every job.
    return rows.mapInArrow(pack, "texts binary").select(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(chunks)).alias("chunk"), "texts")


def _rows_of(pieces: pa.Table) -> pa.Table:
    """The rows of some pieces."""
    return pa.concat_tables(pa.ipc.open_stream(x.as_buffer()).read_all() for x in pieces.column("texts"))


def _packed(values: np.ndarray) -> bytes:
    """The numbers compressed, equal places of their bytes side by side."""
    return pa.compress(values.view(np.uint8).reshape(len(values), -1).T.tobytes(), "zstd", asbytes=True)


def _unpacked(packed: bytes, n: int, kind: type) -> np.ndarray:
    size = np.dtype(kind).itemsize
    planes = np.frombuffer(pa.decompress(packed, n * size, "zstd", asbytes=True), np.uint8).reshape(size, n)
    return np.ascontiguousarray(planes.T).view(kind).ravel()


def _words_of(table: pa.Table) -> tuple[np.ndarray, list[np.ndarray]]:
    """The number of words of each text, and the keys of each kind of all words in order."""
    shingler = Shingler(1)
    words = [w for batch in table.select(["text"]).to_batches() for w in shingler.words(batch.column(0))]
    none = [np.zeros(0, np.uint64)]
    before, after = np.concatenate([_before(w) for w in words] + none), np.concatenate(words + none)
    return np.array([len(w) for w in words], np.int64), [_pairs(before, after), after, before]


def asked(pieces: DataFrame, ranges: int) -> DataFrame:
    """``chunk, kind, range, n, keys, target, background``: the packed distinct keys of each chunk with its counts."""

    def ask(pieces: pa.Table) -> pa.Table:
        table = _rows_of(pieces)
        lengths, kinds = _words_of(table)
        mine = np.repeat(table.column("is_target").to_numpy(), lengths)
        out = []
        for kind, each in enumerate(kinds):
            keys, which = np.unique(each, return_inverse=True)
            counts = np.bincount(which, mine, len(keys)).astype(np.uint32), np.bincount(which, minlength=len(keys)).astype(np.uint32)
            # The product of the upper half is monotonous, so a range is a slice of the sorted keys.
            place = ((keys >> np.uint64(32)) * np.uint64(ranges)) >> np.uint64(32)
            starts = np.flatnonzero(np.diff(place, prepend=np.uint64(ranges)))
            for a, b in zip(starts.tolist(), [*starts[1:].tolist(), len(keys)]):
                out.append((kind, int(place[a]), b - a, _packed(keys[a:b]), *(_packed(c[a:b]) for c in counts)))
        columns = [list(c) for c in zip(*out)] or [[] for _ in range(6)]
        types = [pa.int32(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.binary()]
        chunk = pa.array([pieces.column("chunk")[0].as_py()] * len(out), pa.int64())
        return pa.Table.from_arrays([chunk, *(pa.array(c, t) for c, t in zip(columns, types))], ["chunk", "kind", "range", "n", "keys", "target", "background"])

    return pieces.groupBy("chunk").applyInArrow(
        ask, "chunk long, kind int, range long, n long, keys binary, target binary, background binary"
    )


def answered(requests: DataFrame) -> DataFrame:
    """``chunk, kind, range, n, target, background``: the counts of the keys asked for, in the same order.

    ``distinct, all_target, all_background`` are the sums of a range, in the first of its rows and 0 in the others.
    """

    def answer(table: pa.Table) -> pa.Table:
        sizes = table.column("n").to_pylist()
        parts = {n: np.concatenate([_unpacked(x, k, t) for x, k in zip(table.column(n).to_pylist(), sizes)])
                 for n, t in (("keys", np.uint64), ("target", np.uint32), ("background", np.uint32))}
        keys, which = np.unique(parts["keys"], return_inverse=True)
        counts = [np.bincount(which, parts[n], len(keys)).astype(np.int64) for n in ("target", "background")]
        ends = np.cumsum(sizes).tolist()
        packed = [[_packed(c[which[e - n : e]]) for n, e in zip(sizes, ends)] for c in counts]
        sums = [[s] + [0] * (len(sizes) - 1) for s in (len(keys), int(counts[0].sum()), int(counts[1].sum()))]
        out = table.select(["chunk", "kind", "range", "n"])
        for name, column, kind in zip(("target", "background", "distinct", "all_target", "all_background"), packed + sums, [pa.binary()] * 2 + [pa.int64()] * 3):
            out = out.append_column(name, pa.array(column, kind))
        return out

    return requests.groupBy("kind", "range").applyInArrow(
        answer, "chunk long, kind int, range long, n long, target binary, background binary, distinct long, all_target long, all_background long"
    )


def cross_entropy_difference(docs: DataFrame, target: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, n_words, target_loss, background_loss, score`` of every row."""
    size = docs.agg(F.sum(F.octet_length(F.col(f"`{text}`")))).first()[0] or 0
    pieces = written(_pieces(docs, target, text, doc_id, size // CHUNK_BYTES + 1), "lm-pieces")
    counts = written(answered(asked(pieces, size // RANGE_BYTES + 1)), "lm-counts")
    total = counts.where(F.col("kind") == _WORDS).agg(*[F.sum(n).alias(n) for n in ("distinct", "all_target", "all_background")]).first()
    totals = (total["all_target"] or 0, max(total["all_background"] or 0, 1))
    vocabulary = max(total["distinct"] or 0, 1 << WORD_BITS)
    # Without a target both models are the background's.
    models = [("target", 1.0) if totals[0] else ("background", 1.0), ("background", totals[0] / totals[1] if totals[0] else 1.0)]
    matched = totals[0] or totals[1]

    def score(pieces: pa.Table, answers: pa.Table) -> pa.Table:
        texts = _rows_of(pieces)
        lengths, kinds = _words_of(texts)
        got = sorted(answers.to_pylist(), key=lambda r: (r["kind"], r["range"]))
        keys, first, which = np.unique(kinds[_PAIRS], return_index=True, return_inverse=True)
        # The place of each distinct pair, of its word and of the word before among the answers.
        places = [np.arange(len(keys)), *(np.unique(kinds[k], return_inverse=True)[1][first] for k in (_WORDS, _BEFORE))]
        of_text, losses = np.repeat(np.arange(len(lengths)), lengths), []
        for name, scale in models:
            pair, word, before = (
                np.concatenate([np.zeros(0, np.int64), *(_unpacked(r[name], r["n"], np.int64) for r in got if r["kind"] == k)])[places[k]] * scale
                for k in (_PAIRS, _WORDS, _BEFORE)
            )
            single = (word + WORD_PRIOR) / (matched + WORD_PRIOR * vocabulary)
            loss = -np.log((pair + PAIR_PRIOR * single) / (before + PAIR_PRIOR))
            losses.append(np.bincount(of_text, loss[which], len(lengths)))
        return pa.Table.from_arrays(
            [texts.column("doc_id"), pa.array(lengths), *(pa.array(x) for x in losses)], ["doc_id", "n_words", "target_loss", "background_loss"]
        )

    summed = pieces.groupBy("chunk").cogroup(counts.select("chunk", "kind", "range", "n", "target", "background").groupBy("chunk")).applyInArrow(
        score, "doc_id long, n_words long, target_loss double, background_loss double"
    )
    # Null where there are no words.
    mean = [F.when(F.col("n_words") > 0, F.col(n) / F.col("n_words")).alias(n) for n in ("target_loss", "background_loss")]
    return summed.select("doc_id", "n_words", *mean).withColumn("score", F.col("target_loss") - F.col("background_loss"))
