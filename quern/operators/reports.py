"""Run and evaluation reports."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def length_histogram(df: DataFrame, size: Column, by: str) -> DataFrame:
    """(by, p50, p90, p99, longest, n). Exact percentiles: Spark keeps counts of distinct lengths, not rows."""
    q = F.percentile(size, F.array(F.lit(0.5), F.lit(0.9), F.lit(0.99)))
    return df.groupBy(by).agg(q.alias("q"), F.max(size).alias("longest"), F.count(F.lit(1)).alias("n")).select(by, F.col("q")[0].alias("p50"), F.col("q")[1].alias("p90"), F.col("q")[2].alias("p99"), "longest", "n")


def device_peaks(peaks: DataFrame) -> DataFrame:
    """(run_id, peak_gb, per_device): bytes over 1e9, the largest of all devices and each device's."""
    each = peaks.groupBy("run_id", "device").agg(F.max("peak_bytes").alias("b"))
    per = F.transform(F.array_sort(F.collect_list(F.struct("device", "b"))), lambda x: F.round(x["b"] / 1e9, 2))
    return each.groupBy("run_id").agg(F.round(F.max("b") / 1e9, 2).alias("peak_gb"), per.alias("per_device"))


def throughput(runs: DataFrame) -> DataFrame:
    """Adds tok_per_sec_rank and tok_per_sec (all ranks); null for resumed runs and without a runtime."""
    tokens = F.col("steps") * F.col("batch") * F.col("accum") * F.col("seq")
    rate = F.when(~F.col("resumed") & (F.col("runtime_s") > 0), tokens / F.col("runtime_s"))
    return runs.withColumns({"tok_per_sec_rank": rate, "tok_per_sec": rate * F.col("world_size")})


def audit(passes: DataFrame, most: float = 0.15, by: str = "example_id") -> DataFrame:
    """One row (n, disagreement, rejudge): share of audited examples on which the two passes differ, and whether that is too many."""
    return passes.agg(F.count(F.lit(1)).alias("n"), F.avg((F.col("pass1") != F.col("pass2")).cast("int")).alias("disagreement")).withColumn("rejudge", F.col("disagreement") > most)


def win_rate(judgements: DataFrame, least: float = 0.55) -> DataFrame:
    """One row (items, rate, reached): an item's score is the mean of its two orders, the rate the mean of items."""
    items = judgements.groupBy("item_id").agg(F.avg("win").alias("w"))
    return items.agg(F.count(F.lit(1)).alias("items"), F.avg("w").alias("rate")).withColumn("reached", F.col("rate") >= least)


def decide(results: DataFrame, gain: float = 3.0, guard: float = -2.0, target: str = "target") -> DataFrame:
    """(delta, worst_guard, decision) from paired results (instrument, baseline, adapter): confirm, scale or stop."""
    d = F.col("adapter") - F.col("baseline")
    one = results.agg(F.max(F.when(F.col("instrument") == target, d)).alias("delta"), F.min(F.when(F.col("instrument") != target, d)).alias("worst_guard"))
    choice = F.when(F.coalesce("worst_guard", F.lit(0.0)) < guard, "stop").when(F.col("delta") >= gain, "scale").when(F.col("delta") > 0, "confirm").otherwise("stop")
    return one.withColumn("decision", choice)


def dataset_size(hours: Column, tok_per_sec: Column, avg_tokens: Column) -> Column:
    """Examples that a budget of hours can train on once."""
    return F.floor(hours * tok_per_sec * 3600 / avg_tokens)


def survival(df: DataFrame, stage: str, order: list[str]) -> DataFrame:
    """(stage, n, share of the stage before) for counts of a cascade in its order."""
    counts = df.groupBy(stage).agg(F.count(F.lit(1)).alias("c"))
    cells = {s: F.coalesce(F.sum(F.when(F.col(stage).isin(*order[i:]), F.col("c"))), F.lit(0)) for i, s in enumerate(order)}
    one = counts.agg(*[v.alias(f"n{i}") for i, v in enumerate(cells.values())])
    rows = F.array(*[F.struct(F.lit(s).alias("stage"), F.col(f"n{i}").alias("n"), (F.col(f"n{i}") / F.nullif(F.col(f"n{max(i - 1, 0)}"), F.lit(0))).alias("share")) for i, s in enumerate(order)])
    return one.select(F.inline(rows))
