"""Divergence guard over training logs: the first streak of non-finite values."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.strings import finite_number


def first_streaks(logs: DataFrame, run: str = "run_id", step: str = "step", value: str = "grad_norm", grace: int = 2, window: int = 3) -> DataFrame:
    """(run, fired_step): per run, the step at which `window` non-finite values in a row are complete; runs without one are absent.

    Steps up to `grace` and values that are no numbers count neither way; a finite value ends a streak.
    """
    finite = finite_number(F.col(value).cast("string"))
    seen = logs.filter(F.col(step) > grace).select(run, step, finite.alias("finite")).filter("finite is not null")
    order = Window.partitionBy(run).orderBy(step)
    islands = seen.withColumn("island", F.sum(F.col("finite").cast("int")).over(order.rowsBetween(Window.unboundedPreceding, 0)))
    streak = F.row_number().over(Window.partitionBy(run, "island").orderBy(step))
    bad = islands.filter(~F.col("finite")).withColumn("streak", streak)
    return bad.filter(F.col("streak") >= window).groupBy(run).agg(F.min(step).alias("fired_step"))
