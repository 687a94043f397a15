"""Exact dedup with a heavy-hitter split, in DataFrame functions only.

A frequent-items sketch (Misra-Gries, fixed size, so mergeable over any number of tasks) names
candidates for digests that many rows share. Their exact counts and winners are aggregated, which
combines in every task before the shuffle, and the ones that are truly frequent go to a broadcast
table of at most ``HEAVY`` rows: their rows are decided where they are read. All other digests are
shuffled as usual; none of them can hold more than a small share of the rows.

Texts are equal when their UTF-8 bytes are (SHA-256); null counts as empty. The row with the
largest ``doc_id`` stays; a null ``doc_id`` is smaller than any. Of rows that repeat both, one stays.
Other columns are neither compared nor changed, whatever their names.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.session import written

# Heavy digests at most, and counters of the sketch. An item with more than about 3.5 / COUNTERS of
# the rows is always named.
HEAVY = 1000
COUNTERS = 16384
# Rows that make a digest worth the broadcast.
HEAVY_ROWS = 32
# Winners of the other digests with several rows that are broadcast; more are joined by a shuffle.
BROADCAST_WINNERS = 200_000

# Working columns beside those of the caller.
_DIGEST, _BEST, _HEAVY_BEST, _COPY = "dedup digest", "dedup best", "dedup heavy best", "dedup copy"


def text_sha256(text: Column) -> Column:
    return F.sha2(F.encode(F.coalesce(text, F.lit("")), "UTF-8"), 256)


def heavy_digests(digests: DataFrame, digest: str = "text_sha256") -> DataFrame:
    """The digests held by many rows, at most ``HEAVY``, named by the sketch."""
    top = F.expr(f"approx_top_k({digest}, {HEAVY}, {COUNTERS})")
    return (
        digests.agg(top.alias("top")).select(F.explode("top").alias("t"))
        .where(F.col("t.count") >= HEAVY_ROWS).select(F.col("t.item").alias(digest)).limit(HEAVY)
    )


def _winners(rows: DataFrame) -> DataFrame:
    best = F.max(F.struct("doc_id", "row"))
    return rows.groupBy("text_sha256").agg(best.alias("best"), F.count("*").alias("group_size"))


def _split(rows: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Winners of the heavy digests, and the rows with a heavy and with an ordinary digest."""
    names = written(heavy_digests(rows), "heavy")
    winners = written(_winners(rows.join(F.broadcast(names), "text_sha256")), "heavy-winners")
    return winners, rows.join(F.broadcast(winners), "text_sha256"), rows.join(F.broadcast(names), "text_sha256", "left_anti")


def exact_groups(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """``doc_id, keep_id, group_size, kept, text_sha256`` of every row, dropped ones too."""
    rows = written(
        docs.select(F.col(doc_id).cast("long").alias("doc_id"), text_sha256(F.col(text)).alias("text_sha256"))
        .withColumn("row", F.monotonically_increasing_id()),
        "digests",
    )
    _, heavy, light = _split(rows)
    decided = heavy.unionByName(light.join(_winners(light), "text_sha256"))
    return decided.select(
        "doc_id", F.col("best.doc_id").alias("keep_id"), "group_size", (F.col("row") == F.col("best.row")).alias("kept"), "text_sha256"
    )


def exact_dedup(docs: DataFrame, text: str = "text", doc_id: str = "doc_id") -> DataFrame:
    """The rows of ``docs`` that stay, with their columns.

    Decisions are made on digests alone. Rows of heavy digests are removed where they are read; the
    others meet only the winners of digests that have several rows; texts move only where those are many. Of rows that repeat text and
    ``doc_id`` one is taken, by their other columns.
    """
    rows = written(
        docs.select(F.col(f"`{doc_id}`").cast("long").alias("doc_id"), text_sha256(F.col(f"`{text}`")).alias("text_sha256")), "digests"
    )
    names = F.broadcast(written(heavy_digests(rows), "heavy"))

    def several(part: DataFrame) -> DataFrame:
        each = part.groupBy("text_sha256", "doc_id").agg(F.count("*").alias("repeats"))
        best = each.groupBy("text_sha256").agg(F.max(F.struct("doc_id", "repeats")).alias("best"), F.sum("repeats").alias("rows"))
        # Names that no column of the caller has.
        return best.where("rows > 1").select(
            F.col("text_sha256").alias(_DIGEST), F.col("best").alias(_BEST)
        )

    heavy = written(several(rows.join(names, "text_sha256")), "heavy-winners")
    light = written(several(rows.join(names, "text_sha256", "left_anti")), "winners")
    if light.limit(BROADCAST_WINNERS + 1).count() <= BROADCAST_WINNERS:
        light = F.broadcast(light)
    best = F.col(f"`{_BEST}`")
    stays = best.isNull() | best["doc_id"].eqNullSafe(F.col(f"`{doc_id}`").cast("long"))
    left = docs.withColumn(_DIGEST, text_sha256(F.col(f"`{text}`")))
    left = left.join(F.broadcast(heavy), _DIGEST, "left").where(stays).withColumnRenamed(_BEST, _HEAVY_BEST)
    left = left.join(light, _DIGEST, "left").where(stays)
    repeats = F.coalesce(best["repeats"], F.col(f"`{_HEAVY_BEST}`")["repeats"], F.lit(1))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    if heavy.union(light).where(best["repeats"] > 1).isEmpty():
        return left.select(*columns)
    order = Window.partitionBy(F.col(f"`{_DIGEST}`")).orderBy(F.xxhash64(*[c.cast("string") for c in columns]))
    again = left.where(repeats > 1).withColumn(_COPY, F.row_number().over(order)).where(F.col(f"`{_COPY}`") == 1)
    return left.where(repeats == 1).select(*columns).unionByName(again.select(*columns))
