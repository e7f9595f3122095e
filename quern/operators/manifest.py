"""Run manifests: overrides, pins, warm-up, capability and visibility guards, snapshot lookup, modes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import last_token


def overlay(runs: DataFrame, overrides: DataFrame, key: str = "run_id") -> DataFrame:
    """runs with every non-null override in place; 0 is an override."""
    names = [c for c in runs.columns if c != key]
    over = overrides.select(key, *[F.col(c).alias(f"__o_{c}") for c in names if c in overrides.columns])
    return runs.join(over, key, "left").select(key, *[F.coalesce(f"__o_{c}", c).alias(c) if c in overrides.columns else F.col(c) for c in names])


def require_pin(configs: DataFrame, revision: str = "revision") -> DataFrame:
    """configs; a null revision raises when the row is read."""
    return configs.withColumn(revision, F.when(F.col(revision).isNotNull(), F.col(revision)).otherwise(F.raise_error("revision is null: pin it first").cast("string")))


def warmup_steps(ratio: Column, max_steps: Column) -> Column:
    """Ratio to steps, halves to even, never negative."""
    return F.greatest(F.lit(0), F.bround(ratio * max_steps, 0).cast("int"))


def precision_flags(bf16: Column) -> Column:
    return F.struct((~bf16).alias("fp16"), bf16.alias("bf16"))


def capable(major: Column, minor: Column, least: tuple[int, int] = (7, 0)) -> Column:
    return F.struct(major, minor) >= F.struct(F.lit(least[0]), F.lit(least[1]))


def capability(text: Column) -> Column:
    """struct<major, minor> of "7.5"; null if it is no such pair."""
    parts = F.split(F.trim(text), r"\.")
    pair = F.struct(F.get(parts, F.lit(0)).try_cast("int").alias("major"), F.get(parts, F.lit(1)).try_cast("int").alias("minor"))
    return F.when((F.size(parts) == 2) & pair["major"].isNotNull() & pair["minor"].isNotNull(), pair)


def visible(world_size: Column, devices: Column) -> Column:
    return (world_size <= 1) | (devices >= world_size)


def forbidden_modules(names: DataFrame, needle: str = "vision", marker: str = "lora_", column: str = "name") -> DataFrame:
    """(module), distinct and sorted: parents (without the last two parts) of names with the marker that hold the needle in any case."""
    module = F.regexp_replace(F.col(column), r"(\.[^.]*){1,2}$", "")
    return names.filter(F.col(column).contains(marker)).select(module.alias("module")).distinct().filter(F.lower("module").contains(needle)).orderBy("module")


def targeted(module: Column, pattern: str) -> Column:
    """Whether the whole module path matches."""
    return module.rlike(f"^(?:{pattern})$")


def resolve_sources(models: DataFrame, markers: DataFrame) -> DataFrame:
    """(repo, source, revision): the first snapshot, by path, whose marker ends in the pinned revision, with no revision; else the repo.

    markers has path and the marker file's value, "<repo> <revision>".
    """
    found = markers.select("path", last_token(F.col("value")).alias("pin")).groupBy("pin").agg(F.min("path").alias("path"))
    wide = models.join(found, models["revision"] == found["pin"], "left")
    return wide.select("repo", F.coalesce("path", "repo").alias("source"), F.when(F.col("path").isNull(), F.col("revision")).alias("revision"))


def mode_args(requests: DataFrame, modes: DataFrame) -> DataFrame:
    """requests with the args of their mode; an unknown mode raises when the row is read. Modes are a fixed small list."""
    wide = requests.join(modes, "mode", "left")
    return wide.withColumn("args", F.when(F.col("args").isNotNull(), F.col("args")).otherwise(F.raise_error(F.concat(F.lit("unknown mode "), F.col("mode"))).cast(modes.schema["args"].dataType)))


def tokens_per_step(seq: Column, batch: Column, accum: Column, ranks: Column) -> Column:
    return seq * batch * accum * ranks
