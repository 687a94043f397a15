"""Run states and checkpoints."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from corpusloom.functions.text import suffix_number, with_default


def _newest_first(order: Sequence[str]) -> list[Column]:
    return [F.col(o).desc() for o in order]


# Up to this rank Spark trims every group to its newest rows in each task before the shuffle
# (``spark.sql.optimizer.windowGroupLimitThreshold``).
_TRIMMED_BY_SPARK = 1000
_SLICES = 256


def _newest(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int) -> DataFrame:
    rank = F.row_number().over(Window.partitionBy(*by).orderBy(*_newest_first(order)))
    return df.withColumn("_rank", rank).where(F.col("_rank") <= n).drop("_rank")


def retain_last_n(df: DataFrame, by: Sequence[str], order: Sequence[str], n: int = 5) -> DataFrame:
    """The ``n`` newest rows of each group.

    A large group is trimmed before it meets in one task: by Spark for a small ``n``, else in slices
    first, which keep the ``n`` newest each.
    """
    if n <= _TRIMMED_BY_SPARK:
        return _newest(df, by, order, n)
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(_SLICES)))
    return _newest(_newest(sliced, [*by, "_slice"], order, n).drop("_slice"), by, order, n)


def latest_per_key(df: DataFrame, by: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The newest row of each group."""
    return retain_last_n(df, by, order, 1)


def sample_every_n_steps(df: DataFrame, n: int = 500) -> DataFrame:
    """Log rows at positive multiples of ``n`` steps; a missing loss becomes 0.0."""
    return df.where((F.col("step") % n == 0) & (F.col("step") > 0)).withColumn(
        "loss", with_default(F.col("loss"), 0.0)
    )


def newest_checkpoint(df: DataFrame, by: Sequence[str] = (), name: str = "name") -> DataFrame:
    """The largest number among ``checkpoint-N`` names, per group."""
    steps = df.where(F.col(name).startswith("checkpoint-")).withColumn("_n", suffix_number(F.col(name)))
    return steps.where(F.col("_n").isNotNull()).groupBy(*by).agg(F.max("_n").alias("checkpoint"))


def compare_resume(states: DataFrame, checkpoints: DataFrame) -> DataFrame:
    """Where each run resumes: its newest checkpoint, else its latest state, else from the start."""
    latest = latest_per_key(states, ["run_id"], ["ts", "step"]).select("run_id", "step")
    newest = newest_checkpoint(checkpoints, ["run_id"])
    both = latest.join(newest, "run_id", "full")
    source = (
        F.when(F.col("checkpoint").isNotNull(), F.concat(F.lit("checkpoint-"), F.col("checkpoint")))
        .when(F.col("step").isNotNull(), "state")
        .otherwise("start")
    )
    return both.select(
        "run_id",
        "step",
        "checkpoint",
        source.alias("resume_from"),
        F.coalesce(F.col("step") < F.col("checkpoint"), F.lit(False)).alias("state_is_older"),
    )
