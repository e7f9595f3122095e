"""Append-only work ledger: latest status, resumption, daily budgets, batches, retry schedule."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def latest(events: DataFrame, keys: list[str], ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """The last event of each key, as an aggregate: one row a key and task is shuffled, no group is sorted."""
    rest = [c for c in events.columns if c not in keys]
    return events.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(ts, tie)).alias("r")).select(*keys, "r.*")


def outstanding(work: DataFrame, events: DataFrame, keys: list[str], done: str = "done") -> DataFrame:
    """Work whose key has no `done` event: rerunning it repeats nothing that is finished."""
    return work.join(events.filter(F.col("status") == done).select(*keys).distinct(), keys, "left_anti")


def admit(requests: DataFrame, cap: float, by: list[str], amount: str, ts: str = "ts", tie: str = "event_id") -> DataFrame:
    """Adds used and admitted: in order of time, requests are admitted while the running amount of the key's day is within cap."""
    w = Window.partitionBy(*by, F.to_date(ts)).orderBy(ts, tie).rowsBetween(Window.unboundedPreceding, 0)
    return requests.withColumn("used", F.sum(amount).over(w)).withColumn("admitted", F.col("used") <= cap)


def batches(df: DataFrame, by: str, order: str, size: int = 10) -> DataFrame:
    """Adds batch_id from 0: `size` rows of a key in order make one request."""
    return df.withColumn("batch_id", F.floor((F.row_number().over(Window.partitionBy(by).orderBy(order)) - 1) / size))


def backoff(attempt: Column, base: float = 1.0, cap: float = 300.0) -> Column:
    """Seconds before the next try: base doubled with each attempt, at most cap."""
    return F.least(F.lit(cap), F.lit(base) * F.pow(F.lit(2.0), attempt))


def newest(df: DataFrame, by: str, order: str, keep: int = 2) -> DataFrame:
    """Retention: the `keep` newest rows of each key."""
    return df.withColumn("__rank", F.row_number().over(Window.partitionBy(by).orderBy(F.col(order).desc()))).filter(F.col("__rank") <= keep).drop("__rank")
