"""Quality gates with reason codes, judge scores, licences."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def with_reasons(df: DataFrame, gates: dict[str, Column]) -> DataFrame:
    """Adds `reasons`, the names of the gates that a row fails, in the gates' order; a gate that is null counts as failed."""
    failed = [F.when(~F.coalesce(ok, F.lit(False)), F.lit(name)) for name, ok in gates.items()]
    return df.withColumn("reasons", F.array_compact(F.array(*failed)))


def passing(df: DataFrame) -> DataFrame:
    return df.filter(F.size("reasons") == 0).drop("reasons")


def reason_counts(df: DataFrame) -> DataFrame:
    """(reason, n): rows failing each gate, and under "passed" those that fail none."""
    return df.select(F.explode(F.when(F.size("reasons") == 0, F.array(F.lit("passed"))).otherwise(F.col("reasons"))).alias("reason")).groupBy("reason").agg(F.count(F.lit(1)).alias("n"))


def rule_floors(least_words: int = 20, languages: tuple[str, ...] = ("en",), text: str = "text", lang: str = "lang") -> dict[str, Column]:
    """Length, language and structure: the cheap gates before any judge."""
    t = F.col(text)
    return {
        "length": F.regexp_count(t, F.lit(r"[^\x20\x09-\x0D]+")) >= least_words,
        "language": F.col(lang).isin(*languages),
        "structure": ~t.contains("|") & F.trim(t).rlike(r"[.!?]$"),
    }


def drop_over_length(df: DataFrame, tokens: Column, most: int = 8192) -> DataFrame:
    """Rows of at most `most` tokens; longer ones are dropped, never cut."""
    return df.filter(tokens <= most)


def licensed(df: DataFrame, policy: DataFrame, license_col: str = "license") -> DataFrame:
    """Rows whose licence the policy (license, allowed) allows; unlisted ones are refused. The policy is a small closed list."""
    allowed = policy.filter("allowed").select(F.col("license").alias(license_col)).distinct()
    return df.join(allowed, license_col, "left_semi")


def score_with(examples: DataFrame, judge: str, family: str, scorer: Callable[[pd.DataFrame], pd.DataFrame], by: str = "example_id") -> DataFrame:
    """Long scores (by, judge, judge_family, criterion, score) of a pluggable judge: scorer maps a batch of examples to (by, criterion, score)."""
    kind = dict(examples.dtypes)[by]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            yield scorer(batch)[[by, "criterion", "score"]]

    made = examples.mapInPandas(run, f"{by} {kind}, criterion string, score int")
    return made.select(by, F.lit(judge).alias("judge"), F.lit(family).alias("judge_family"), "criterion", "score")


def judge_pass(scores: DataFrame, least: int = 4, judges: int = 2, by: str = "example_id") -> DataFrame:
    """(by, passed): every judge gives at least `least` on every criterion, and there are `judges` of them."""
    return scores.groupBy(by).agg((F.coalesce(F.every(F.col("score") >= least), F.lit(False)) & (F.count_distinct("judge") >= judges)).alias("passed"))


def judge_pairs(scores: DataFrame, by: str = "example_id") -> DataFrame:
    """Blind pairs of judges from different families, neither the generator's: (by, judge_a, judge_b)."""
    one = scores.filter("judge_family <> generator_family").select(by, "judge", "judge_family").distinct()
    a, b = (one.select(by, F.col("judge").alias(f"judge_{x}"), F.col("judge_family").alias(f"family_{x}")) for x in "ab")
    return a.join(b, by).filter("judge_a < judge_b AND family_a <> family_b").select(by, "judge_a", "judge_b")
