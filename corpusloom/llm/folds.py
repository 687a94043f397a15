"""The split of labelled rows, and bounded samples for fitting."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

FOLDS = 5


def held_out(doc_id: Column) -> Column:
    """Rows that no model may learn from; a row without an id is one of them."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % FOLDS == 0, F.lit(True))


def bounded(rows: DataFrame, most: int, *keys: str) -> DataFrame:
    """At most ``most`` rows, chosen by a hash of their keys."""
    return rows.orderBy(F.xxhash64(*keys), *keys).limit(most)
