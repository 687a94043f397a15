"""Mixing sources to target weights by Poisson replication, in DataFrame functions only.

A source with target weight ``w`` and size ``s`` is repeated ``w * total / s`` times on average. A
document's number of copies is the inverse of that Poisson distribution at a number in (0, 1) hashed
from the seed and its id (its text where the id is null); so it does not depend on partitioning, and a
task run again gives the same rows. A second hash spreads the copies over the whole output.

A null source is a source of its own. Sizes are counted over all rows: characters, a null text has
none. A source with weight 0, or with empty texts only, leaves no row. Rows that repeat an id get
the same number of copies. All columns of the caller are kept.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The target of a source is its size to this power where no weights are given.
TEMPERATURE = 0.7
# 13 hexadecimal digits of a hash are 52 bits, exact in a double.
_DIGITS = 13
# A higher rate is drawn in equal parts up to this one, for which _TERMS terms reach past 2 ** -52.
_RATE_PART = 8.0
_TERMS = 48
# Rates of up to so many sources are broadcast; beyond, they are joined by a shuffle.
BROADCAST_SOURCES = 10_000

# Working columns beside those of the caller.
_SOURCE, _RATE, _COPY, _KEY = "mixing source", "mixing rate", "mixing copy", "mixing key"


def _uniform(*parts: Column) -> Column:
    digits = F.substring(F.sha2(F.concat_ws("|", *parts), 256), 1, _DIGITS)
    return (F.conv(digits, 16, 10).cast("double") + 0.5) / float(16**_DIGITS)


def _inverse_poisson(u: Column, rate: Column) -> Column:
    """The least k at which the distribution function reaches u."""
    first = F.exp(-rate)
    start = F.struct(first.alias("term"), first.alias("total"), F.when(u > first, 1).otherwise(0).alias("k"))

    def following(a: Column, i: Column) -> Column:
        term = a["term"] * rate / i
        total = a["total"] + term
        return F.struct(term.alias("term"), total.alias("total"), (a["k"] + F.when(u > total, 1).otherwise(0)).alias("k"))

    return F.aggregate(F.sequence(F.lit(1), F.lit(_TERMS)), start, following, lambda a: a["k"])


def copies(identity: Column, rate: Column, seed: int) -> Column:
    """The number of copies of a document: a Poisson number with mean ``rate``, fixed by its identity."""
    parts = F.greatest(F.ceil(rate / _RATE_PART), F.lit(1)).cast("int")
    numbers = F.transform(F.sequence(F.lit(1), parts), lambda j: _uniform(F.lit(str(seed)), j.cast("string"), identity))
    drawn = F.aggregate(numbers, F.lit(0), lambda n, u: n + _inverse_poisson(u, rate / parts))
    return F.when(rate > 0, drawn).otherwise(0)


def source_rates(docs: DataFrame, weights: dict[str | None, float] | None = None, text: str = "text", source: str = "source") -> DataFrame:
    """``source, size, rate``: how often the documents of each source are repeated on average.

    Without weights a source's target is its size to the power ``TEMPERATURE``; with them, a source
    that is not named has weight 0. The expected size of the output is that of the input.
    """
    length = F.coalesce(F.char_length(F.col(f"`{text}`")), F.lit(0))
    sizes = docs.groupBy(F.col(f"`{source}`").alias("source")).agg(F.sum(length).cast("double").alias("size"))
    target = F.pow("size", F.lit(TEMPERATURE))
    if weights is not None:
        target = F.lit(0.0)
        for name, weight in weights.items():
            target = F.when(F.col("source").eqNullSafe(F.lit(name)), float(weight)).otherwise(target)
    sizes = sizes.where("size > 0").withColumn("target", target)
    totals = sizes.agg(F.sum("size").alias("size"), F.sum("target").alias("target")).first()
    scale = float(totals["size"]) / float(totals["target"]) if totals["target"] else 0.0
    return sizes.select("source", "size", (F.col("target") * scale / F.col("size")).alias("rate"))


def mixed(
    docs: DataFrame, weights: dict[str | None, float] | None = None, seed: int = 0, text: str = "text", source: str = "source",
    doc_id: str = "doc_id", numbered: bool = False,
) -> DataFrame:
    """The documents repeated and shuffled; ``numbered`` adds ``copy`` (from 1) and ``shuffle_key``."""
    rates = source_rates(docs, weights, text, source).select(F.col("source").alias(_SOURCE), F.col("rate").alias(_RATE)).where(f"`{_RATE}` > 0")
    if rates.limit(BROADCAST_SOURCES + 1).count() <= BROADCAST_SOURCES:
        rates = F.broadcast(rates)
    identity = F.coalesce(F.col(f"`{doc_id}`").cast("string"), F.col(f"`{text}`"), F.lit(""))
    n = copies(identity, F.col(f"`{_RATE}`"), seed)
    out = (
        docs.join(rates, F.col(f"`{source}`").eqNullSafe(F.col(f"`{_SOURCE}`")))
        .withColumn(_COPY, n).where(F.col(f"`{_COPY}`") > 0)
        .withColumn(_COPY, F.explode(F.sequence(F.lit(1), F.col(f"`{_COPY}`"))))
        .withColumn(_KEY, F.sha2(F.concat_ws("|", F.lit(f"{seed} order"), F.col(f"`{_COPY}`").cast("string"), identity), 256))
    )
    out = out.repartition(F.col(f"`{_KEY}`")).sortWithinPartitions(F.col(f"`{_KEY}`"))
    more = [F.col(f"`{_COPY}`").alias("copy"), F.col(f"`{_KEY}`").alias("shuffle_key")] if numbered else []
    return out.select(*[F.col(f"`{c}`") for c in docs.columns], *more)


ORACLE = """
WITH sizes AS (
  SELECT source, CAST(sum(coalesce(length(text), 0)) AS DOUBLE) AS size FROM documents GROUP BY source
), rates AS (
  SELECT source, pow(size, 0.7) * ((SELECT sum(size) FROM sizes) / (SELECT sum(pow(size, 0.7)) FROM sizes WHERE size > 0)) / size AS rate
  FROM sizes WHERE size > 0
), drawn AS (
  SELECT d.doc_id, d.source, d.text, r.rate,
    (CAST('0x' || substr(sha256('0|1|' || coalesce(CAST(d.doc_id AS VARCHAR), d.text, '')), 1, 13) AS BIGINT) + 0.5) / 4503599627370496.0 AS u
  FROM documents d JOIN rates r ON d.source IS NOT DISTINCT FROM r.source
), steps AS (
  SELECT source, k, sum(exp(-rate + k * ln(rate) - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS reached
  FROM rates, range(0, 48) AS t(k)
), counted AS (
  SELECT d.doc_id, d.source, d.text, list_sum([CASE WHEN d.u > s.reached THEN 1 ELSE 0 END]) AS over
  FROM drawn d JOIN steps s ON d.source IS NOT DISTINCT FROM s.source
), n AS (SELECT doc_id, source, text, CAST(sum(over) AS INTEGER) AS n FROM counted GROUP BY ALL)
SELECT doc_id, source, text, CAST(copy AS INTEGER) AS copy,
  sha256('0 order|' || CAST(copy AS VARCHAR) || '|' || coalesce(CAST(doc_id AS VARCHAR), text, '')) AS shuffle_key
FROM n, range(1, n.n + 1) AS t(copy)
"""
