"""The corpus pipeline: stages over documents, each a (name, function) of (spark, docs, sf_dir).

Every stage but the last returns the columns of documents; each works on all that the one before it kept.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from quern.llm.common import settle
from quern.llm.decontaminate import mark_leaks
from quern.llm.jaccard import keep_one
from quern.llm.line_dedup import drop_boilerplate
from quern.llm.mixing import take_mix
from quern.llm.quality import label_grade, select_quality
from quern.sources.tables import spread


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are probably of the highest grade, by a classifier fitted to the labels."""
    return select_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"), label_grade()).select(*docs.columns)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without their source's boilerplate lines; n_chars follows the text."""
    return drop_boilerplate(docs, ratio=0.1, min_pages=3).withColumn("n_chars", F.length("text").cast("long")).select(*docs.columns)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return keep_one(docs).select(*docs.columns)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    marked = mark_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))
    return marked.filter(F.size("leaks") == 0).select(*docs.columns)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents that the mix takes, and how often (times)."""
    return take_mix(docs)


STAGES = [("quality", quality), ("line_dedup", line_dedup), ("near_duplicates", near_duplicates), ("decontamination", decontamination), ("mixing", mixing)]

#: No SQL: the classifier, the forest and the edit distance are beyond it; tests compare the stages with brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over documents, each one's result written to the shared folder and read by the next."""
    docs = spread(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    for name, stage in STAGES[:-1]:
        docs = settle(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
