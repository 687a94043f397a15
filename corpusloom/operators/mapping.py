"""User functions over rows and batches, run by Spark as Arrow batches."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Mapping, Sequence

import pandas as pd
from pyspark.sql import DataFrame

_FIRST_LABEL = 1 << 40


def map_batches(
    df: DataFrame,
    fn: Callable[[pd.DataFrame], pd.DataFrame],
    schema: str,
    drop: Sequence[str] = (),
) -> DataFrame:
    """Apply ``fn`` to each batch of rows. ``drop`` names input columns the result does not carry.

    Columns that are neither returned by ``fn`` nor dropped are passed along by the index of the
    batch: ``fn`` may filter, repeat or reorder rows as long as it keeps their labels. A result
    with other labels cannot be matched and is refused, whatever its length.
    """

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            # Labels that no fresh index has.
            batch.index = pd.RangeIndex(_FIRST_LABEL, _FIRST_LABEL + len(batch))
            out = fn(batch)
            kept = [c for c in batch.columns if c not in out.columns and c not in drop]
            if kept:
                if not out.index.isin(batch.index).all():
                    raise ValueError(f"columns {kept} cannot be passed along: the result has lost the index of its batch")
                out = pd.concat([batch.loc[out.index, kept].reset_index(drop=True), out.reset_index(drop=True)], axis=1)
            yield out

    return df.mapInPandas(run, schema)


def map_rows(df: DataFrame, fn: Callable[[dict], Mapping], schema: str) -> DataFrame:
    """Apply ``fn`` to each row as a dict."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            if len(batch):
                yield pd.DataFrame([dict(fn(row)) for row in batch.to_dict("records")])

    return df.mapInPandas(run, schema)


def lazy_map(df: DataFrame, fn: Callable[[dict], Mapping], schema: str) -> DataFrame:
    """The same, meant for a consumer that stops early: with ``limit`` only the first tasks run."""
    return map_rows(df, fn, schema)
