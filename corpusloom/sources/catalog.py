"""File catalogue listing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpusloom.functions.clock import DEFAULT_ZONE, local_time
from corpusloom.functions.text import shared_flag, with_default


def list_catalog(
    listing: DataFrame,
    shared_only: bool = False,
    page_size: int | None = 100,
    zone: str = DEFAULT_ZONE,
    order: str = "id",
) -> DataFrame:
    """One page of a listing with columns ``id, name, modifiedTime, shared``.

    ``page_size=None`` lists everything. The order column makes the page well defined.
    """
    rows = listing
    if shared_only:
        rows = rows.where(F.coalesce("shared", F.lit(False)))
    rows = rows.orderBy(order)
    if page_size is not None:
        rows = rows.limit(page_size)
    return rows.select(
        with_default(F.col("id"), "").alias("id"),
        with_default(F.col("name"), "").alias("name"),
        shared_flag(F.col("shared")).alias("shared"),
        local_time(F.col("modifiedTime"), zone).alias("modified"),
    )
