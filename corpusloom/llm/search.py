"""Ranked lexical search of many queries at once, evaluating what they share only once.

* **Mining.** An item is a set of units, the first, second, ... occurrence of each of its terms. Units that
  the same items hold form one shared term set (a class), found by one grouping on the exclusive or of
  the items' hashes. An item is then the list of its classes, those held by most items first, and items
  that begin alike share that beginning, which is again a term set of theirs.
* **Postings.** One pass over the texts keeps, per document, its number of terms and the frequencies of the
  items' terms, and is written. Document frequencies and lengths are summed from it over all documents.
* **Combination.** A task turns the postings of a chunk of documents into one accumulator per class, then walks the
  items in the order of their class lists: the accumulator of a shared beginning is made once, and every item below
  adds its own classes to it. The classes below the beginnings and the items above make the sharing graph.
  All sums are integers, so their order does not matter. A task keeps the best documents of each item;
  those of all tasks are ranked by a window.

Items are dealt into blocks of about ``BLOCK_BYTES`` of text, so that what is broadcast is bounded however
many there are; every block is held against all documents.

Terms are the longest runs of ASCII letters, digits and non-ASCII characters, with A-Z lower-cased. A null
text has none. Rows that repeat an item's id and text count once; different texts of one id are one item. A
null id is an id. Each row of the documents is a document, also where ids repeat; equal scores go by
ascending id, nulls last. Columns of other names are ignored.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.session import written

# Text of the items of one block, about; a single longer item is a block of its own.
BLOCK_BYTES = 1 << 20
# Documents whose accumulators are held at a time, and the cells of those accumulators.
CHUNK = 1024
_CELLS = 1 << 22
# Texts are split in pieces of about this size.
_PIECE_BYTES = 1 << 20

_FOLD = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256)
)


def _pieces(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text; a long one in several lists, cut where a term ends."""
    at = 0
    while len(text) - at > _PIECE_BYTES:
        folded = text[at : at + _PIECE_BYTES].translate(_FOLD)
        end = folded.rfind(b" ") + 1
        if not end:  # a term longer than a piece
            more = text[at:].translate(_FOLD)
            end = more.find(b" ") + 1 or len(more)
            folded = more
        yield folded[:end].split()
        at += end
    yield text[at:].translate(_FOLD).split()


def _item_terms(items: DataFrame) -> DataFrame:
    """``id, term, n`` of the items ``id, text``."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, terms, counts = [], [], []
            for i, text in enumerate(batch.column(1).cast(pa.large_binary()).to_pylist()):
                found = Counter()
                for piece in _pieces(text or b""):
                    found.update(piece)
                at += [i] * len(found)
                terms += [t.decode() for t in found]
                counts += found.values()
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(at, pa.int64())), pa.array(terms, pa.string()), pa.array(counts, pa.int64())], ["id", "term", "n"]
            )

    schema = T.StructType([items.schema["id"], T.StructField("term", T.StringType()), T.StructField("n", T.LongType())])
    return items.mapInArrow(rows, schema).groupBy("id", "term").agg(F.sum("n").alias("n"))


def _mined(units: DataFrame) -> tuple[DataFrame, DataFrame]:
    """The classes of each item in order, and the units of each term in each class, of ``id, term, nth``."""
    key = F.col("id").cast("string")
    classes = units.groupBy("term", "nth").agg(
        F.struct(
            (-F.count("*")).alias("held"), F.bit_xor(F.xxhash64(F.lit(1), key, key.isNull())).alias("x"),
            F.bit_xor(F.xxhash64(F.lit(2), key, key.isNull())).alias("y"),
        ).alias("class")
    )
    members = classes.groupBy("class", "term").agg(F.count("*").alias("units"))
    lists = units.join(classes, ["term", "nth"]).groupBy("id").agg(F.sort_array(F.collect_set("class")).alias("classes"))
    return lists, members


class _Graph:
    """The sharing graph of one block of items, as plain arrays."""

    def __init__(self, lists: list, members: list):
        lists = sorted(lists, key=lambda r: [tuple(c) for c in r["classes"]])
        known = sorted({tuple(m["class"]) for m in members})
        number = {c: i for i, c in enumerate(known)}
        self.ids = [r["id"] for r in lists]
        paths = [[number[tuple(c)] for c in r["classes"]] for r in lists]
        # Where a path leaves the one before it, and what follows there.
        self.steps, before = [], []
        for path in paths:
            same = 0
            while same < min(len(path), len(before)) and path[same] == before[same]:
                same += 1
            self.steps.append((same, path[same:]))
            before = path
        terms = sorted({m["term"] for m in members})
        self.vocabulary = {t.encode(): i for i, t in enumerate(terms)}
        place = {t: i for i, t in enumerate(terms)}
        rows = sorted((place[m["term"]], number[tuple(m["class"])], m["units"]) for m in members)
        self.of_term = np.searchsorted([r[0] for r in rows], np.arange(len(terms) + 1))
        self.member_class = np.array([r[1] for r in rows], np.int64)
        self.member_units = np.array([r[2] for r in rows], np.int64)
        self.n_classes = len(known)


def _postings(docs: DataFrame, graph) -> DataFrame:
    """``doc_id, n, terms, tfs``: a document's length and its frequencies of the items' terms."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        number = graph.value.vocabulary.get
        for batch in batches:
            lengths, ends, terms, tfs = [], [0], [], []
            for text in batch.column(1).cast(pa.large_binary()):
                n, found = 0, Counter()
                for piece in _pieces(text.as_py() or b""):
                    n += len(piece)
                    found.update(map(number, piece))
                found.pop(None, None)
                lengths.append(n)
                terms += found.keys()
                tfs += found.values()
                ends.append(len(terms))
            ends = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0), pa.array(lengths, pa.int64()),
                    pa.ListArray.from_arrays(ends, pa.array(terms, pa.int32())), pa.ListArray.from_arrays(ends, pa.array(tfs, pa.int64())),
                ],
                ["doc_id", "n", "terms", "tfs"],
            )

    return docs.mapInArrow(rows, "doc_id long, n long, terms array<int>, tfs array<long>")


def _frequencies(postings: DataFrame, size: int) -> np.ndarray:
    """The document frequency of each of the ``size`` terms of a block."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found = np.zeros(size, np.int64)
        for batch in batches:
            found += np.bincount(batch.column(0).flatten().to_numpy(), minlength=size)
        at = np.flatnonzero(found)
        yield pa.RecordBatch.from_arrays([pa.array(at.astype(np.int32)), pa.array(found[at])], ["term", "df"])

    out = np.zeros(size, np.int64)
    for term, df in postings.select("terms").mapInArrow(rows, "term int, df long").groupBy("term").agg(F.sum("df")).collect():
        out[term] = df
    return out


def term_weights(df: np.ndarray, n_docs: int) -> np.ndarray:
    return np.floor(1000 * np.log((2 * n_docs + 2) / (2 * df + 1))).astype(np.int64)


class _Best:
    """The best documents of one item so far."""

    def __init__(self, k: int):
        self.k, self.least = k, 1
        self.scores, self.ids, self.nulls = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, nulls: np.ndarray) -> None:
        at = np.flatnonzero(scores >= self.least)
        if not len(at):
            return
        s, i, z = (np.concatenate([old, new[at]]) for old, new in ((self.scores, scores), (self.ids, ids), (self.nulls, nulls)))
        top = np.lexsort((i, z, -s))[: self.k]
        self.scores, self.ids, self.nulls = s[top], i[top], z[top]
        if len(top) == self.k:
            self.least = int(self.scores[-1])


def _accumulators(graph: _Graph, weights: np.ndarray, m: np.ndarray, ends: np.ndarray, terms: np.ndarray, tfs: np.ndarray):
    """Each class's sum for each of some documents, as a matrix, and the row of each class (-1: all zero)."""
    row = np.repeat(np.arange(len(m)), np.diff(ends))
    value = weights[terms] * ((1_000_000_000 * tfs) // (1000 * tfs + 8 * m[row]))
    first, n = graph.of_term[terms], np.diff(graph.of_term)[terms]
    each = np.repeat(np.arange(len(terms)), n)
    member = np.arange(len(each)) - np.repeat(np.cumsum(n) - n, n) + first[each]
    classes, at = np.unique(graph.member_class[member], return_inverse=True)
    sums = np.zeros(len(classes) * len(m), np.int64)
    np.add.at(sums, at * len(m) + row[each], graph.member_units[member] * value[each])
    rows = np.full(graph.n_classes, -1)
    rows[classes] = np.arange(len(classes))
    return sums.reshape(len(classes), len(m)), rows.tolist()


def _walk(graph: _Graph, sums: np.ndarray, rows: list[int]) -> Iterator[tuple[int, np.ndarray]]:
    """The scores of each item; accumulators of shared beginnings stay on the stack."""
    stack = [None]
    for item, (same, rest) in enumerate(graph.steps):
        del stack[same + 1 :]
        for c in rest:
            top = stack[-1]
            if rows[c] >= 0:
                top = sums[rows[c]] if top is None else top + sums[rows[c]]
            stack.append(top)
        if stack[-1] is not None:
            yield item, stack[-1]


def _best_documents(postings: DataFrame, graph, weights, n_docs: int, n_terms: int, k: int) -> DataFrame:
    """``item, doc_id, score``: the ``k`` best documents of each item in every task."""

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, w = graph.value, weights.value
        best = [_Best(k) for _ in shared.ids]

        def score(ids, nulls, m, ends, terms, tfs):
            if len(m) > 1 and min(len(terms), shared.n_classes) * len(m) > _CELLS:
                half = len(m) // 2
                cut = ends[half]
                score(ids[:half], nulls[:half], m[:half], ends[: half + 1], terms[:cut], tfs[:cut])
                return score(ids[half:], nulls[half:], m[half:], ends[half:] - cut, terms[cut:], tfs[cut:])
            for item, scores in _walk(shared, *_accumulators(shared, w, m, ends, terms, tfs)):
                best[item].add(scores, ids, nulls)

        for whole in batches:
            for at in range(0, whole.num_rows, CHUNK):
                batch = whole.slice(at, CHUNK)
                ids = batch.column(0)
                n = batch.column(1).to_numpy()
                terms, tfs = batch.column(2).flatten().to_numpy(), batch.column(3).flatten().to_numpy()
                if not len(terms):
                    continue
                ends = np.concatenate([[0], np.cumsum(batch.column(2).value_lengths().to_numpy())])
                m = 100 - 75 + (75 * n * n_docs) // n_terms
                score(ids.fill_null(0).to_numpy(), ids.is_null().to_numpy(zero_copy_only=False), m, ends, terms, tfs)
        for item, b in enumerate(best):
            if len(b.ids):
                ids = pa.array(b.ids, pa.int64(), mask=b.nulls)
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(b.ids), item, np.int32)), ids, pa.array(b.scores)], ["item", "doc_id", "score"])

    return postings.mapInArrow(rows, "item int, doc_id long, score long")


def ranked_search(
    docs: DataFrame, items: DataFrame, k: int = 10, doc_id: str = "doc_id", text: str = "text", item_id: str = "item_id", item_text: str = "text"
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``k`` documents with the highest scores above 0 of every item."""
    spark = docs.sparkSession
    texts = docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), F.col(f"`{text}`").cast("string").alias("text"))
    asked = items.select(F.col(f"`{item_id}`").alias("id"), F.col(f"`{item_text}`").cast("string").alias("text")).distinct()
    size = asked.agg(F.coalesce(F.sum(F.octet_length("text")), F.lit(0))).first()[0]
    blocks = -(-size // BLOCK_BYTES)
    key = F.col("id").cast("string")
    units = written(
        _item_terms(asked).withColumn("nth", F.explode(F.sequence(F.lit(1).cast("long"), F.col("n")))).drop("n")
        .withColumn("block", F.pmod(F.xxhash64(key, key.isNull()), F.lit(max(blocks, 1)))),
        "item-units",
    )
    kind = asked.schema["id"].dataType
    schema = T.StructType([T.StructField("item", T.IntegerType()), T.StructField("id", kind)])
    found = spark.createDataFrame([], T.StructType([schema["id"], T.StructField("doc_id", T.LongType()), T.StructField("score", T.LongType())]))
    for block in range(blocks):
        lists, members = _mined(units.where(F.col("block") == block).drop("block"))
        mined = _Graph(lists.collect(), members.collect())
        if not mined.ids:
            continue
        graph = spark.sparkContext.broadcast(mined)
        postings = written(_postings(texts, graph), "postings")
        n_docs, n_terms = postings.agg(F.count(F.when(F.col("n") > 0, 1)), F.coalesce(F.sum("n"), F.lit(0))).first()
        weights = spark.sparkContext.broadcast(term_weights(_frequencies(postings, len(mined.vocabulary)), n_docs))
        tops = written(_best_documents(postings, graph, weights, n_docs, n_terms, k), "item-tops")
        names = spark.createDataFrame(list(enumerate(mined.ids)), schema)
        found = found.union(tops.join(F.broadcast(names), "item").select("id", "doc_id", "score"))
    order = Window.partitionBy("id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select(F.col("id").alias(item_id), "rank", "doc_id", "score")


ORACLE = r"""
    WITH words AS (
      SELECT doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM documents),
    tf AS (SELECT doc_id, term, count(*) AS tf FROM words GROUP BY ALL),
    lengths AS (SELECT doc_id, CAST(sum(tf) AS BIGINT) AS n FROM tf GROUP BY doc_id),
    totals AS (SELECT count(*) AS N, CAST(sum(n) AS BIGINT) AS L FROM lengths),
    weights AS (
      SELECT term, CAST(floor(1000 * ln(CAST(2 * any_value(t.N) + 2 AS DOUBLE) / (2 * count(*) + 1))) AS BIGINT) AS w
      FROM tf, totals t GROUP BY term),
    asked AS (
      SELECT item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
      FROM (SELECT DISTINCT item_id, text FROM benchmark)),
    wanted AS (SELECT item_id, term, count(*) AS held FROM asked GROUP BY ALL),
    scores AS (
      SELECT item_id, doc_id,
        CAST(sum(held * w * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * l.n * t.N) // t.L)))) AS BIGINT) AS score
      FROM wanted JOIN tf USING (term) JOIN weights USING (term) JOIN lengths l USING (doc_id), totals t GROUP BY ALL),
    ranked AS (
      SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
      FROM scores WHERE score > 0)
    SELECT * FROM ranked WHERE rank <= 10
"""
