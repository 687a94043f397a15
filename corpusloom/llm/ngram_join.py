"""N-gram Jaccard self-join with adaptive multi-match prefixes, and the classes its links form.

Shingles have one global order: the most frequent ones last, otherwise by hash. If two sets of
which at least ``o`` elements must agree do so, their first ``n - o + l`` elements share at least
``l``. Each document chooses its ``l`` by the cost of the postings its prefix would meet; a pair is
looked at only if it shares as many prefix elements as the smaller ``l`` of the two asks for.

* Equal sets are one document from the start.
* Each document is first compared with the smallest of each posting list. That joins the copies of
  one original in a number of comparisons linear in the postings, and what has been joined is never
  paired again.
* Posting lists up to ``SHORT_LIST`` are joined with themselves. Longer ones are compared in blocks
  inside tasks, by parity bitmaps whose distance never exceeds the true difference of two sets, so
  no list is emitted as pairs and none lands in one task.
* Every pair left is verified on the whole sets.

A null or empty text, or one without words, has an empty set and no links. Rows that repeat a
``doc_id`` with one text are one document and are returned as often as they came in; a null ``doc_id`` links
with nothing and has no component. Other columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from corpusloom.functions.batches import giving_back, in_parts
from corpusloom.llm.graph import connected_components
from corpusloom.llm.shingles import Shingler
from corpusloom.session import small_batches, written

# Shingles put last in the order, at most; they only decide the order, never what is compared.
ORDERED_LAST = 1 << 17
# A task reports shingles that it has met so often; the sums over tasks rank them.
LOCAL_COUNT = 4
# The longest prefix extension tried, and what a verification costs in postings.
MOST_MATCHES = 8
VERIFY_COST = 10.0
# Posting lists up to this length are self-joined, longer ones compared in blocks of BLOCK documents.
SHORT_LIST = 128
BLOCK = 512
# Pending shingles of a counting task before it sums them.
_PENDING = 1 << 21


def least_overlap(n, num: int, den: int):
    """Elements that a set of ``n`` must share with any partner: |x & y| >= t * max(|x|, |y|)."""
    return -(-num * n // den)


class _Repeats:
    """Elements met more than once within ``_PENDING`` elements of a task, with the sums of their counts."""

    def __init__(self):
        self.pending, self.size = np.empty(_PENDING, np.int64), 0
        self.values, self.n = np.zeros(0, np.int64), np.zeros(0, np.int64)

    def add(self, s: np.ndarray) -> None:
        if self.size + len(s) > len(self.pending):
            self.merge()
            if len(s) > len(self.pending):
                self.pending = np.empty(len(s), np.int64)
        self.pending[self.size : self.size + len(s)] = s
        self.size += len(s)

    def merge(self) -> None:
        # Sorted in place, so that only what repeats is copied.
        met, self.size = self.pending[: self.size], 0
        met.sort()
        values, n = np.unique(met[1:][met[1:] == met[:-1]], return_counts=True)
        counts = np.concatenate([self.n, n + 1])
        self.values, at = np.unique(np.concatenate([self.values, values]), return_inverse=True)
        self.n = np.bincount(at, counts, len(self.values)).astype(np.int64)


def _frequent(docs: DataFrame, text: str, width: int) -> tuple[np.ndarray, np.ndarray]:
    """The shingles most repeated within tasks, with the sums of their counts, sorted by shingle."""

    @giving_back
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, met = Shingler(width), _Repeats()
        for batch in in_parts(batches):
            for s in shingler.sets(batch.column(0)):
                met.add(s)
        met.merge()
        often = met.n >= LOCAL_COUNT
        yield pa.RecordBatch.from_arrays([pa.array(met.values[often]), pa.array(met.n[often])], ["shingle", "n"])

    found = (
        docs.select(text).mapInArrow(count, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
        .orderBy(F.desc("n"), "shingle").limit(ORDERED_LAST).toPandas()
    ).sort_values("shingle")
    return found["shingle"].to_numpy(np.int64), found["n"].to_numpy(np.int64)


def _bitmap(s: np.ndarray) -> bytes:
    """Each bit is the parity of the elements that fall on it; its size follows the set's."""
    bits = 512
    while bits < 2 * len(s):
        bits *= 2
    ones = np.bincount(s.view(np.uint64) & np.uint64(bits - 1), minlength=bits) & 1
    return np.packbits(ones.astype(np.uint8), bitorder="little").tobytes()


def _folded(bitmap: np.ndarray, size: int) -> np.ndarray:
    while len(bitmap) > size:
        bitmap = bitmap[: len(bitmap) // 2] ^ bitmap[len(bitmap) // 2 :]
    return bitmap


def _may_link(nx, ny, apart, num: int, den: int):
    """Whether sets that differ in at least ``apart`` elements can reach the similarity."""
    # |x & y| = (nx + ny - d) / 2 and |x | y| = (nx + ny + d) / 2.
    return den * (nx + ny - apart) >= num * (nx + ny + apart)


def _sets(docs: DataFrame, text: str, doc_id: str, width: int, num: int, den: int, last) -> DataFrame:
    """Per row: size, digest, the longest prefix that any choice of ``l`` needs, and the bitmap."""

    @giving_back
    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler, (often, counts) = Shingler(width), last.value
        for batch in in_parts(batches):
            sizes, digests, prefixes, bitmaps = [], [], [], []
            for s in shingler.sets(batch.column(1)):
                n = len(s)
                sizes.append(n)
                digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest())
                bitmaps.append(_bitmap(s))
                p = min(n, n - least_overlap(n, num, den) + MOST_MATCHES)
                if n and len(often):
                    at = np.minimum(np.searchsorted(often, s), len(often) - 1)
                    rank = np.where(often[at] == s, counts[at], 0)
                    s = s[np.argsort(rank, kind="stable")]
                prefixes.append(s[:p])
            ends = np.cumsum([0] + [len(p) for p in prefixes])
            flat = np.concatenate(prefixes) if prefixes else np.zeros(0, np.int64)
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(sizes, pa.int32()),
                    pa.array(digests, pa.binary()),
                    pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(flat, pa.int64())),
                    pa.array(bitmaps, pa.binary()),
                ],
                ["doc_id", "n", "digest", "prefix", "bitmap"],
            )

    return docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).mapInArrow(
        rows, "doc_id long, n int, digest binary, prefix array<long>, bitmap binary"
    )


def _verified(pairs: DataFrame, sets: DataFrame, docs: DataFrame, text: str, doc_id: str, width: int, num: int, den: int) -> DataFrame:
    """The pairs ``a, b`` that link: first by bitmap, then on the whole sets."""

    @F.pandas_udf(T.BooleanType())
    def close(na: pd.Series, nb: pd.Series, ba: pd.Series, bb: pd.Series) -> pd.Series:
        out = []
        for x, y, p, q in zip(na, nb, ba, bb):
            p, q = np.frombuffer(p, np.uint8), np.frombuffer(q, np.uint8)
            size = min(len(p), len(q))
            apart = int(np.bitwise_count(_folded(p, size) ^ _folded(q, size)).sum())
            out.append(_may_link(x, y, apart, num, den))
        return pd.Series(out, dtype=bool)

    @F.arrow_udf("boolean")
    def linked(sa: pa.Array, sb: pa.Array) -> pa.Array:
        out = []
        for x, y in zip(sa, sb):
            x, y = np.frombuffer(x.as_buffer(), np.int64), np.frombuffer(y.as_buffer(), np.int64)
            same = len(np.intersect1d(x, y, assume_unique=True))
            out.append(den * same >= num * (len(x) + len(y) - same))
        return pa.array(out, pa.bool_())

    @giving_back
    def whole(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shingler = Shingler(width)
        for batch in in_parts(batches):
            found = pa.array([s.tobytes() for s in shingler.sets(batch.column(1))], pa.binary())
            yield pa.RecordBatch.from_arrays([batch.column(0), found], ["doc_id", "elements"])

    maps = sets.select("doc_id", "n", "bitmap")
    left = maps.select(F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("bitmap").alias("ba"))
    right = maps.select(F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("bitmap").alias("bb"))
    near = written(
        pairs.join(left, "a").join(right, "b")
        .where(den * F.least("na", "nb") >= num * F.greatest("na", "nb"))
        .where(close("na", "nb", "ba", "bb")).select("a", "b").distinct(),
        "near",
    )
    ids = near.select(F.col("a").alias(doc_id)).union(near.select("b")).distinct()
    texts = docs.select(F.col(doc_id).cast("long").alias(doc_id), F.col(text).alias("text")).join(ids, doc_id, "left_semi")
    elements = written(texts.mapInArrow(whole, "doc_id long, elements binary"), "elements")
    return (
        near.join(elements.select(F.col("doc_id").alias("a"), F.col("elements").alias("sa")), "a")
        .join(elements.select(F.col("doc_id").alias("b"), F.col("elements").alias("sb")), "b")
        .where(linked("sa", "sb")).select("a", "b").distinct()
    )


def _chosen(shared: DataFrame, num: int, den: int) -> DataFrame:
    """Per document the number of matches it asks for: the cheapest prefix by its posting lists."""
    base = F.col("n") - F.ceil(F.col("n") * num / F.lit(den))
    met = [F.sum(F.when(F.col("rank") < base + l, F.col("df") - 1).otherwise(0)).alias(f"c{l}") for l in range(1, MOST_MATCHES + 1)]
    costs = shared.groupBy("doc_id", "n").agg(*met)
    overlap = F.ceil(F.col("n") * num / F.lit(den))
    tried = F.array(*[F.struct((F.col(f"c{l}") * (1 + VERIFY_COST / l)).alias("cost"), F.lit(l).alias("l")) for l in range(1, MOST_MATCHES + 1)])
    return costs.select("doc_id", F.array_min(F.filter(tried, lambda x: x["l"] <= F.greatest(overlap, F.lit(1))))["l"].alias("l"))


def _short_lists(rows: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs that meet often enough, from the posting lists short enough to be joined."""
    short = rows.where(F.col("df") <= SHORT_LIST)
    a = short.select("token", *[F.col(c).alias(f"a_{c}") for c in ("doc_id", "n", "l", "component")])
    b = short.select("token", *[F.col(c).alias(f"b_{c}") for c in ("doc_id", "n", "l", "component")])
    met = (
        a.join(b, "token")
        .where("a_doc_id < b_doc_id and a_component <> b_component")
        .where(den * F.least("a_n", "b_n") >= num * F.greatest("a_n", "b_n"))
        .groupBy("a_doc_id", "b_doc_id")
        .agg(F.count("*").alias("met"), F.min(F.least("a_l", "b_l")).alias("asked"))
    )
    # A pair that also meets in a long list is found there.
    return met.where("met >= asked").select(F.col("a_doc_id").alias("a"), F.col("b_doc_id").alias("b"))


def _long_lists(rows: DataFrame, sets: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of the long posting lists whose bitmaps are close, found in blocks."""
    long = rows.where(F.col("df") > SHORT_LIST)
    open_lists = long.groupBy("token").agg(F.min("component").alias("lo"), F.max("component").alias("hi")).where("lo < hi").select("token")
    blocks = F.ceil(F.col("df") / F.lit(BLOCK)).cast("int")
    dealt = (
        long.join(open_lists, "token").withColumn("blocks", blocks)
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .join(sets.select("doc_id", "bitmap"), "doc_id")
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .select("token", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), "block", "doc_id", "n", "component", "bitmap")
    )

    def compare(group: pd.DataFrame) -> pd.DataFrame:
        i, j = int(group["i"].iloc[0]), int(group["j"].iloc[0])
        group = group.drop_duplicates("doc_id")
        x, y = group[group["block"] == i], group[group["block"] == j]
        size = min((len(b) for b in group["bitmap"]), default=64)
        found = []
        if len(x) and len(y):
            bits = lambda g: np.stack([_folded(np.frombuffer(b, np.uint8), size) for b in g["bitmap"]]).view(np.uint64)
            by, ny, cy, iy = bits(y), y["n"].to_numpy(), y["component"].to_numpy(), y["doc_id"].to_numpy()
            for bx, nx, cx, ix in zip(bits(x), x["n"].to_numpy(), x["component"].to_numpy(), x["doc_id"].to_numpy()):
                ok = (cy != cx) & (iy > ix if i == j else True) & (den * np.minimum(nx, ny) >= num * np.maximum(nx, ny))
                at = np.flatnonzero(ok)
                apart = np.bitwise_count(by[at] ^ bx).sum(axis=1, dtype=np.int64)
                at = at[_may_link(nx, ny[at].astype(np.int64), apart, num, den)]
                found += [(min(ix, iy[k]), max(ix, iy[k])) for k in at]
        return pd.DataFrame(found, columns=["a", "b"], dtype="int64")

    return dealt.groupBy("token", "i", "j").applyInPandas(compare, "a long, b long").distinct()


def ngram_jaccard(docs: DataFrame, text: str = "text", doc_id: str = "doc_id", width: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of every row; similarity ``num / den`` or more links.

    ``component_id`` is the smallest ``doc_id`` that links reach, the row's own included.
    """
    spark = docs.sparkSession
    small_batches(spark)
    last = spark.sparkContext.broadcast(_frequent(docs, text, width))
    sets = written(_sets(docs, text, doc_id, width, num, den, last), "sets")
    equal = sets.where("n > 0 and doc_id is not null").groupBy("digest").agg(F.min("doc_id").alias("same_as"))
    equal = written(equal, "equal-sets")
    # Copies are fewer than documents, and all that is joined of them is their ids.
    copies = sets.select("doc_id", "digest").join(equal, "digest").where("doc_id <> same_as").select("doc_id")
    one_each = sets.where("n > 0 and doc_id is not null").join(copies, "doc_id", "left_anti")

    postings = one_each.select("doc_id", "n", F.posexplode("prefix").alias("rank", "token"))
    lists = postings.groupBy("token").agg(F.count("*").alias("df"), F.min(F.struct("doc_id", "n")).alias("pivot")).where("df > 1")
    shared = written(postings.join(lists, "token"), "shared-postings")
    base = F.col("n") - F.ceil(F.col("n") * num / F.lit(den))
    cut = written(
        shared.join(_chosen(shared, num, den), "doc_id").where(F.col("rank") < base + F.col("l")).drop("rank"), "prefixes"
    )

    known = [docs, text, doc_id, width, num, den]
    alike = den * F.least("n", "pivot.n") >= num * F.greatest("n", "pivot.n")
    stars = cut.where("doc_id <> pivot.doc_id").where(alike).select(F.col("pivot.doc_id").alias("a"), F.col("doc_id").alias("b")).distinct()
    first = written(_verified(stars, sets, *known), "star-links")
    joined = connected_components(first)
    rows = written(
        cut.drop("pivot").join(joined.withColumnRenamed("node", "doc_id"), "doc_id", "left")
        .withColumn("component", F.coalesce("component", "doc_id")),
        "labelled-postings",
    )
    pairs = _short_lists(rows, num, den).union(_long_lists(rows, sets, num, den)).distinct()
    links = first.union(_verified(written(pairs, "pairs"), sets, *known))
    components = connected_components(links)
    named = equal.join(components, equal["same_as"] == components["node"], "left").select(
        "digest", F.coalesce("component", "same_as").alias("component")
    )
    return sets.select("doc_id", "n", "digest").join(named, "digest", "left").select(
        "doc_id", F.col("n").cast("long").alias("n_shingles"),
        F.when(F.col("n") > 0, F.when(F.col("doc_id").isNotNull(), F.col("component"))).otherwise(F.col("doc_id")).alias("component_id"),
    )
