"""Assembly of the training set: provenance, exclusions, source audits, builder gates, and the whole cascade."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settled
from . import decontam, dedup, gates, splits


def with_provenance(examples: DataFrame, sources: DataFrame, key: str = "chunk_id") -> DataFrame:
    """Examples with `provenance`, the struct of their source's columns; examples of unknown sources are left out."""
    rest = [c for c in sources.columns if c != key]
    return examples.join(sources.select(key, F.struct(*rest).alias("provenance")), key)


def excluding(df: DataFrame, held: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not held out."""
    return df.join(held.select(key).distinct(), key, "left_anti")


def not_verbatim(df: DataFrame, grounding: DataFrame, text: str = "text", grounding_text: str = "text") -> DataFrame:
    """Rows whose text is no grounding text, by 256-bit hash: grounding is never trained on."""
    seen = grounding.select(F.sha2(F.trim(F.col(grounding_text)), 256).alias("__h")).distinct()
    return df.withColumn("__h", F.sha2(F.trim(F.col(text)), 256)).join(seen, "__h", "left_anti").drop("__h")


def sampled_rate(df: DataFrame, bad: Column, n: int = 200, id_col: str = "doc_id", seed: int = splits.SEED) -> DataFrame:
    """One row (n, rate): share of bad rows in the n rows that the seeded draw puts first, a report on a stated sample."""
    some = df.orderBy(splits.draw(id_col, seed), id_col).limit(n)
    return some.agg(F.count(F.lit(1)).alias("n"), F.avg(F.coalesce(bad, F.lit(False)).cast("int")).alias("rate"))


def admitted_sources(df: DataFrame, ok: Column, source: str, least: float, n: int = 500, id_col: str = "doc_id", seed: int = splits.SEED) -> DataFrame:
    """(source, audited, pass_rate, admitted): each source by an audit of its n rows first in the seeded draw."""
    drawn = splits.draw(id_col, seed)
    audited = splits.ranked(df.withColumn("__ok", F.coalesce(ok, F.lit(False))), source, F.substring(drawn, 1, 4), [drawn, F.col(id_col)]).filter(F.col("__rank") <= n)
    out = audited.groupBy(source).agg(F.count(F.lit(1)).alias("audited"), F.avg(F.col("__ok").cast("int")).alias("pass_rate"))
    return out.withColumn("admitted", F.col("pass_rate") >= least)


def paired(results: DataFrame, baseline: str = "base", adapter: str = "adapter") -> DataFrame:
    """(instrument, item_id, baseline, adapter): full outer pairs of (instrument, model, item_id, score)."""
    a = results.filter(F.col("model") == baseline).select("instrument", "item_id", F.col("score").alias("baseline"))
    b = results.filter(F.col("model") == adapter).select("instrument", "item_id", F.col("score").alias("adapter"))
    return a.join(b, ["instrument", "item_id"], "full")


def builder_gates(rendered: DataFrame, tokens: Column, pad: str = "<|endoftext|>", most: int = 8192) -> DataFrame:
    """One row (rows, over_length, unmasked, padded, ok): the three assertions on a rendered set with trained_chars."""
    one = rendered.agg(
        F.count(F.lit(1)).alias("rows"), F.count_if(tokens > most).alias("over_length"), F.count_if(F.col("trained_chars") == 0).alias("unmasked"), F.count_if(F.col("text").contains(pad)).alias("padded")
    )
    return one.withColumn("ok", (F.col("over_length") == 0) & (F.col("unmasked") == 0) & (F.col("padded") == 0))


def share_reached(df: DataFrame, what: Column, least: float = 0.8) -> DataFrame:
    """One row (share, ok): the share of rows that are `what`, against its floor."""
    return df.agg(F.avg(F.coalesce(what, F.lit(False)).cast("int")).alias("share")).withColumn("ok", F.col("share") >= least)


def without_near_copies(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """docs without the rows that a row with a smaller id is verified to be near: banding, then word sets."""
    members, classes, pairs = dedup.near_classes(docs, least, id_col, text)
    copies = members.join(classes.filter("copies > 1"), "k").filter(F.col("id") > F.col("first")).select("id")
    firsts = classes.select("k", "first")
    near = pairs.join(firsts.withColumnsRenamed({"k": "a", "first": "x"}), "a").join(firsts.withColumnsRenamed({"k": "b", "first": "y"}), "b").filter("x <> y").select(F.greatest("x", "y").alias("id"))
    return docs.join(copies.union(near).distinct().withColumnRenamed("id", id_col), id_col, "left_anti")


def assemble(docs: DataFrame, protected: DataFrame, quotas: dict[str, int], stratum: str, stream: str, floors: dict[str, Column], most_chars: int = 32_768) -> DataFrame:
    """The cascade: rule floors, length gate, near copies, decontamination, hold-out, mix. Adds split: train or held_out.

    Every stage's result is written once, as the next one reads it more than once; texts are written until the last stage that
    reads them, and keys of rows from there on.
    """
    rows = gates.drop_over_length(gates.passing(gates.with_reasons(docs, floors)), F.length("text"), most_chars)
    rows = settled(without_near_copies(settled(rows, "floors")).withColumn("__row", F.monotonically_increasing_id()), "distinct")
    keys = rows.select("__row", *dict.fromkeys(("doc_id", stratum, stream)))
    keys = settled(excluding(keys, decontam.contaminated(rows, protected), "doc_id"), "clean")
    keys = settled(splits.holdout(keys, stratum), "split")
    train = splits.mix(keys.filter(~F.col("held_out")), quotas, stream).select("__row", F.lit("train").alias("split"))
    return rows.join(train.unionByName(keys.filter("held_out").select("__row", F.lit("held_out").alias("split"))), "__row").drop("__row")
