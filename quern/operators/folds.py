"""Sequential folds: greedy accumulate-and-reset, and best-fit packing. One group is one ordered sequence."""

from __future__ import annotations

from bisect import bisect_left, insort

import pandas as pd
from pyspark.sql import DataFrame


def least_chars(target_tokens: int | None, config_tokens: int = 6144, chars_per_token: int = 6) -> int:
    """The threshold in characters; a target of 0 or None is unset and the configured one holds."""
    return chars_per_token * (target_tokens or config_tokens)


def greedy_groups(rows: DataFrame, shard: str, order: str, size: str, least: int) -> DataFrame:
    """(shard, order, size, group_id): rows in order fill a group until its size is at least `least`; what then is left over goes.

    Groups never cross shards. Each reset depends on the one before, so a shard is one sequential pass over (order, size)
    pairs; shards run in parallel and bound what one task holds.
    """
    kinds = dict(rows.dtypes)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        ids, group, total = [], 0, 0
        for x in pdf[size].fillna(0):
            ids.append(group)
            total += x
            if total >= least:
                group, total = group + 1, 0
        return pdf.assign(group_id=ids)[lambda d: d["group_id"] < group][[shard, order, size, "group_id"]]

    return rows.select(shard, order, size).groupBy(shard).applyInPandas(fold, f"{shard} {kinds[shard]}, {order} {kinds[order]}, {size} {kinds[size]}, group_id long")


def shards_for(rows: int, most: int = 100_000) -> int:
    """How many shards keep each at some `most` rows."""
    return max(1, -(-rows // most))


def first_groups(rows: DataFrame, order: str, size: str, least: int, n: int, start: int = 1024) -> DataFrame:
    """(order, size, group_id): the first n groups over all rows in one order; what follows them is not looked at.

    Rows are taken in order, twice as many each time, until they complete n groups or there are no more, so what is gathered
    is bounded by what n groups hold.
    """
    kinds, spark = dict(rows.dtypes), rows.sparkSession
    while True:
        held = rows.select(order, size).orderBy(order).limit(start).collect()
        out, group, total, at = [], 0, 0, 0
        for i, (key, x) in enumerate(held):
            out.append((key, x, group))
            total += x or 0
            if total >= least:
                group, total, at = group + 1, 0, i + 1
                if group == n:
                    break
        if group == n or len(held) < start:
            return spark.createDataFrame(out[:at], f"{order} {kinds[order]}, {size} {kinds[size]}, group_id long")
        start *= 2


def best_fit_bins(sizes: list[int], capacity: int) -> list[int]:
    """Best fit decreasing: the bin of each size, longest first, in the fullest bin that has room; -1 for sizes beyond capacity."""
    out, room, made = [-1] * len(sizes), [], 0
    for i in sorted(range(len(sizes)), key=lambda k: (-sizes[k], k)):
        if sizes[i] > capacity:
            continue
        at = bisect_left(room, (sizes[i], -1))
        if at < len(room):
            left, b = room.pop(at)
        else:
            left, b, made = capacity, made, made + 1
        out[i] = b
        insort(room, (left - sizes[i], b))
    return out


def pack(rows: DataFrame, shard: str, order: str, size: str, capacity: int = 8192) -> DataFrame:
    """(shard, order, size, bin_id): rows of each shard packed into bins of `capacity`; longer rows are dropped, never cut."""
    kinds = dict(rows.dtypes)

    def fold(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(order, kind="stable")
        return pdf.assign(bin_id=best_fit_bins([int(x) for x in pdf[size]], capacity))[lambda d: d["bin_id"] >= 0][[shard, order, size, "bin_id"]]

    return rows.filter(f"{size} is not null").select(shard, order, size).groupBy(shard).applyInPandas(fold, f"{shard} {kinds[shard]}, {order} {kinds[order]}, {size} {kinds[size]}, bin_id long")
