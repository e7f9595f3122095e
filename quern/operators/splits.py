"""Hold-out and mixture by seeded hash: every choice is md5(seed, id), so reruns and other engines agree."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

SEED = 3407


def draw(id_col: str, seed: int = SEED) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(id_col).cast("string"), F.lit(""))))


def ranked(df: DataFrame, by: str, coarse: Column, order: list[Column]) -> DataFrame:
    """Adds __rank, the place of each row in its group by coarse, then order, and __n, the group's rows.

    A group of any size is dealt out by `coarse`: only counts of (group, coarse) are ordered in one place, and a row's rank is
    what precedes its part plus its rank inside it.
    """
    key = F.coalesce(F.concat(F.lit("v"), F.col(by).cast("string")), F.lit("n"))
    wide = df.withColumns({"__key": key, "__part": coarse})
    group = Window.partitionBy("__key")
    counts = wide.groupBy("__key", "__part").agg(F.count(F.lit(1)).alias("__c"))
    counts = counts.withColumn("__before", F.sum("__c").over(group.orderBy("__part")) - F.col("__c")).withColumn("__n", F.sum("__c").over(group)).drop("__c")
    inside = F.row_number().over(Window.partitionBy("__key", "__part").orderBy(*order))
    counts = counts.withColumnsRenamed({"__key": "__k", "__part": "__p"})
    both = wide.join(counts, (F.col("__key") == F.col("__k")) & F.col("__part").eqNullSafe(F.col("__p")))
    return both.withColumn("__rank", F.col("__before") + inside).drop("__key", "__part", "__before", "__k", "__p")


def holdout(df: DataFrame, stratum: str, share: float = 0.1, newest_first: str | None = None, id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Adds held_out: in each stratum, floor(share * rows), those with the latest `newest_first` first, then by draw."""
    drawn = draw(id_col, seed)
    coarse = -F.unix_date(F.col(newest_first).cast("date")) if newest_first and dict(df.dtypes)[newest_first] in ("date", "timestamp", "timestamp_ntz") else -F.col(newest_first) if newest_first else F.substring(drawn, 1, 4)
    order = ([F.col(newest_first).desc()] if newest_first else []) + [drawn, F.col(id_col)]
    out = ranked(df, stratum, coarse, order)
    return out.withColumn("held_out", F.col("__rank") <= F.floor(F.lit(share) * F.col("__n")).cast("long")).drop("__rank", "__n")


def mix(df: DataFrame, quotas: dict[str, int], stream: str, id_col: str = "doc_id", seed: int = SEED) -> DataFrame:
    """Of each stream the quota's number of rows, by draw; streams without a quota give none."""
    limit = F.coalesce(*[F.when(F.col(stream) == s, F.lit(q)) for s, q in quotas.items()], F.lit(0))
    drawn = draw(id_col, seed)
    return ranked(df.filter(limit > 0), stream, F.substring(drawn, 1, 4), [drawn, F.col(id_col)]).filter(F.col("__rank") <= limit).drop("__rank", "__n")


def shares(df: DataFrame, stream: str) -> DataFrame:
    """(stream, n, share) of all rows."""
    counts = df.groupBy(stream).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("total"))
    return counts.join(F.broadcast(total), F.lit(True)).select(stream, "n", (F.col("n") / F.col("total")).alias("share"))


def union_streams(*streams: DataFrame) -> DataFrame:
    """All streams under one schema; columns that a stream lacks are null."""
    out = streams[0]
    for s in streams[1:]:
        out = out.unionByName(s, allowMissingColumns=True)
    return out
