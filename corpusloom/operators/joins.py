"""Joins that hold when one key carries a large share of the rows."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.session import in_stable_order

# A key with more rows than this on the many side is split over several tasks.
HOT_ROWS = 1_000_000


def left_join_unique(left: DataFrame, right: DataFrame, key: str, hot_rows: int = HOT_ROWS) -> DataFrame:
    """Left join with a right side that has one row per key.

    Keys with more than ``hot_rows`` left rows are split: their rows get a slice number and the one
    right row is repeated for each slice, so no task sees more than about ``hot_rows`` rows of a key.
    The list of hot keys has at most ``rows / hot_rows`` entries. All rows are kept.
    """
    stable = in_stable_order(left)
    hot = (
        stable.where(F.col(key).isNotNull())
        .groupBy(key)
        .count()
        .where(F.col("count") > hot_rows)
        .select(key, F.ceil(F.col("count") / hot_rows).cast("int").alias("_slices"))
    )
    one = F.lit(1)
    # ``hot`` is small by its threshold, so it may be broadcast. Null keys match nothing; they only
    # need to be spread.
    numbered = stable.withColumn("_row", F.monotonically_increasing_id())
    sliced = numbered.join(F.broadcast(hot), key, "left").withColumn(
        "_slice",
        F.when(F.col(key).isNull(), F.pmod("_row", F.lit(1 << 20)))
        .otherwise(F.pmod("_row", F.coalesce("_slices", one)))
        .cast("int"),
    )
    repeated = right.join(F.broadcast(hot), key, "left").withColumn(
        "_slice", F.explode(F.sequence(F.lit(0), F.coalesce("_slices", one) - 1))
    )
    columns = [c for c in right.columns if c != key]
    return (
        sliced.drop("_slices", "_row")
        .join(repeated.select(key, "_slice", *columns), [key, "_slice"], "left")
        .select(*[F.col(c) for c in left.columns], *[F.col(c) for c in columns])
    )
