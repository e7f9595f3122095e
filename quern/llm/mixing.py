"""Mixing sources to target weights by subset-sum budget fitting."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import P, checked_broadcast, key_of, settle

WORD = r"[^\x20\x09-\x0D]+"


def source_targets(totals: DataFrame, weights: tuple[float, ...], share: float, max_repeat: float) -> DataFrame:
    """Add `target` to one row per source (source, source_size).

    Sources in code-point order (null last) take the weights in turn and divide share times all sizes; a target stops at
    max_repeat times its source's size and the excess is shared anew by weight. That ends at target = min(cap, level *
    weight) with one common level, found from the caps in the order in which a rising level meets them. One row per source
    goes to a single task; sources are named in a mix, they do not grow with the documents.
    """
    by_name = Window.orderBy(F.col("source").asc_nulls_last())
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(F.row_number().over(by_name) - 1, F.lit(len(weights))) + 1).cast("int"))
    t = totals.withColumn("w", w).withColumn("cap", F.col("source_size") * F.lit(float(max_repeat)))
    every = Window.partitionBy(F.lit(0))
    met = Window.orderBy((F.col("cap") / F.col("w")).asc(), F.col("source").asc_nulls_last())
    before = met.rowsBetween(Window.unboundedPreceding, -1)
    t = t.withColumn("budget", F.sum("source_size").over(every) * F.lit(float(share)))
    t = t.withColumn("left_budget", F.col("budget") - F.coalesce(F.sum("cap").over(before), F.lit(0.0)))
    t = t.withColumn("left_w", F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    t = t.withColumn("level", F.col("left_budget") / F.col("left_w"))
    # The first source whose cap is not met fixes the level; where every cap is met, all get their caps.
    t = t.withColumn("level", F.min(F.when(F.col("cap") > F.col("level") * F.col("w"), F.struct(F.col("cap") / F.col("w"), "level"))).over(every)["level"])
    target = F.when(F.col("level").isNull(), F.col("cap")).otherwise(F.least("cap", F.col("level") * F.col("w")))
    return t.select("source", "source_size", target.alias("target"))


def fit_counts(lengths: np.ndarray, counts: np.ndarray, target: float, max_repeat: int, dp_budget: int) -> tuple[int, np.ndarray]:
    """Whole repeats of a source, and for each length how many documents are taken once more, so that words come nearest to target.

    Most of the budget is dealt in proportion to the counts, from long to short, carrying what a length cannot use. The last
    dp_budget words or so are a bounded knapsack over the documents that are left: reachable sums are the bits of an integer.
    """
    size = int((lengths * counts).sum())
    extra = np.zeros(len(lengths), dtype=np.int64)
    if size == 0:
        return 0, extra
    base = min(int(target // size), max_repeat)
    budget = round(target - base * size)
    if base == max_repeat or budget <= 0:
        return base, extra
    order = np.argsort(-lengths, kind="stable")
    share, carry = max(0, budget - dp_budget) / size, 0.0
    for i in order:
        want = share * counts[i] * lengths[i] + carry
        extra[i] = min(int(counts[i]), int(want // lengths[i]))
        carry = want - extra[i] * lengths[i]
    rest = budget - int((extra * lengths).sum())
    room = rest + int(lengths.max())
    mask, sums, steps = (1 << (room + 1)) - 1, 1, []
    for i in order[::-1]:
        n, part = min(int(counts[i] - extra[i]), room // int(lengths[i])), 1
        while n > 0 and not sums >> rest & 1:
            part = min(part, n)
            steps.append((i, part, sums))
            sums |= sums << part * int(lengths[i]) & mask
            n, part = n - part, part * 2
        if sums >> rest & 1:
            break
    low = (sums & ((1 << (rest + 1)) - 1)).bit_length() - 1
    high = (sums >> rest) & -(sums >> rest)
    at = rest + high.bit_length() - 1 if high and high.bit_length() - 1 < rest - low else low
    for i, part, reached in reversed(steps):
        if not reached >> at & 1:
            extra[i] += part
            at -= part * int(lengths[i])
    return base, extra


def _mix(
    docs: DataFrame, weights: tuple[float, ...] = (5, 2, 1), share: float = 1.5, max_repeat: int = 2, seed: int = 3407, dp_budget: int = 20_000,
    bucket_rows: int = 256, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
) -> DataFrame:
    """As `mix_to_targets`, with columns id, source, h (hash of id and text) and times."""
    text = F.col(text_col)
    sized = settle(
        docs.select(
            F.col(id_col).alias("id"), F.col(source_col).alias("source"), key_of(F.col(source_col)).alias("key"), F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long").alias("size"),
            F.xxhash64(F.lit(seed), F.col(id_col), text).alias("h"),
        ), "mix-sized",
    )
    targets = source_targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weights, share, max_repeat).withColumn("key", key_of(F.col("source")))
    targets = settle(targets, "mix-targets")
    lengths = sized.filter("size > 0").groupBy("key", "size").agg(F.count(F.lit(1)).alias("n")).join(targets.select("key", "target"), "key")

    def fit(pdf: pd.DataFrame) -> pd.DataFrame:
        base, extra = fit_counts(pdf["size"].to_numpy(np.int64), pdf["n"].to_numpy(np.int64), float(pdf["target"].iloc[0]), max_repeat, dp_budget)
        return pd.DataFrame({"key": pdf["key"], "size": pdf["size"], "n": pdf["n"], "base": base, "extra": extra})

    plan = settle(lengths.groupBy("key").applyInPandas(fit, "key string, size long, n long, base long, extra long"), "mix-plan")
    rows = sized.join(plan, ["key", "size"], "left").withColumn("bucket", F.pmod(F.col("h"), F.ceil(F.coalesce("n", F.lit(1)) / F.lit(bucket_rows))))
    rows = rows.withColumn("bucket", F.when(F.col("n").isNotNull(), F.col("bucket")).otherwise(F.pmod(F.col("h"), F.lit(1 << 20))))
    group = Window.partitionBy("key", "size")
    buckets = rows.filter("n is not null").groupBy("key", "size", "bucket").agg(F.count(F.lit(1)).alias("c"))
    buckets = buckets.withColumn("before", F.sum("c").over(group.orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)) - F.col("c")).drop("c")
    rows = rows.join(buckets, ["key", "size", "bucket"], "left")
    rank = F.col("before") + F.row_number().over(Window.partitionBy("key", "size", "bucket").orderBy("h", "id"))
    times = F.coalesce(F.col("base") + (rank <= F.col("extra")).cast("long"), F.lit(0))
    rows = rows.withColumn("taken", times * F.col("size"))
    return rows.withColumn("times", times).join(targets.select("key", "source_size", "target"), "key").select("id", "source", "h", "size", "source_size", "target", "taken", "times")


def mix_to_targets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **options) -> DataFrame:
    """How many words of each document the mix takes: columns id_col, size, source_size, target, taken, source_col.

    Counts documents by exact length in words, fits each source's target by `fit_counts`, and takes in each (source, length)
    the documents with the smallest seeded hash. Every document is taken a whole number of times, max_repeat at most.

    A group of documents of one source and length may be of any size: it is dealt by hash into buckets of about bucket_rows,
    and ranks are a bucket's offset, from counts alone, plus the rank inside the bucket. Text is read once and never shuffled.

    Null text has size 0 and is taken 0 times; a text of any length is one size; null sources form a source; null ids are ordinary; rows with the same id are
    separate documents; an empty table gives no rows; other columns are left out.
    """
    out = _mix(docs, id_col=id_col, text_col=text_col, source_col=source_col, **options)
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", "taken", F.col("source").alias(source_col))


def take_mix(docs: DataFrame, broadcast_rows: int = 500_000, seed: int = 3407, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """The documents that the mix of `mix_to_targets` takes, with all columns and `times`, how often each is taken (1 or more).

    Rows that repeat both id and text are taken equally often.
    """
    taken = _mix(docs, id_col=id_col, text_col=text_col, seed=seed, **options).filter("times > 0").groupBy(F.col("id").alias(P + "id"), F.col("h").alias(P + "h")).agg(F.max("times").alias("times"))
    taken = settle(taken, "mix-taken")
    wide = docs.drop("times").withColumn(P + "h", F.xxhash64(F.lit(seed), F.col(id_col), F.col(text_col)))
    joined = wide.join(checked_broadcast(taken, broadcast_rows), wide[id_col].eqNullSafe(taken[P + "id"]) & (wide[P + "h"] == taken[P + "h"]))
    return joined.select(*[wide[c] for c in docs.columns if c != "times"], "times")


__all__ = ["fit_counts", "mix_to_targets", "source_targets", "take_mix"]
