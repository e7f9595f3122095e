"""Citations: every cited work must exist, exactly or nearly, and belong to the grounding."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..sources.shared import settled


def verify(citations: DataFrame, corpus: DataFrame, most: int = 2, by: str = "example_id", key: str = "citation") -> DataFrame:
    """(by, n_cited, n_exact, n_fuzzy, ok): ok if every distinct citation is in the corpus, exactly or within `most` edits.

    Only citations without an exact match are compared. A citation is cut into most + 1 pieces: `most` edits leave one of them
    whole, moved by `most` places at the most, so works are looked up by pieces and nothing in reach is passed over. Each
    citation then counts once, however many works are near.
    """
    cited = citations.filter(F.col(key).isNotNull()).select(by, F.col(key).alias("c")).distinct()
    works = settled(corpus.filter(F.col(key).isNotNull()).select(F.col(key).alias("w")).distinct(), "works")
    exact = settled(cited.join(works, F.col("c") == F.col("w"), "left").withColumn("exact", F.col("w").isNotNull()).drop("w"), "cited")
    missing = exact.filter(~F.col("exact")).select("c").distinct()

    def pieces(text: str, length: Column, shift: Column) -> DataFrame:
        start = F.expr(f"cast(piece * size div {most + 1} as int)")
        end = F.expr(f"cast((piece + 1) * size div {most + 1} as int)")
        at = (missing if text == "c" else works).select(text, F.explode(length).alias("size")).select(text, "size", F.explode(F.sequence(F.lit(0), F.lit(most))).alias("piece"))
        at = at.select(text, "size", "piece", start.alias("s"), (end - start).alias("l"), F.explode(shift).alias("d"))
        at = at.filter((F.col("s") + F.col("d") >= 0) & (F.col("s") + F.col("d") + F.col("l") <= F.length(text)))
        return at.select(text, "size", "piece", F.substr(F.col(text), F.col("s") + F.col("d") + 1, F.col("l")).alias("part")).distinct()

    some, none = F.sequence(F.lit(-most), F.lit(most)), F.array(F.lit(0))
    sizes = F.sequence(F.greatest(F.length("w") - most, F.lit(0)), F.length("w") + most)
    near = pieces("c", F.array(F.length("c")), none).join(pieces("w", sizes, some), ["size", "piece", "part"]).filter(F.levenshtein("c", "w", most) >= 0)
    near = near.select("c").distinct().withColumn("near", F.lit(True))
    each = exact.join(near, "c", "left").withColumn("near", F.coalesce("near", F.lit(False)))
    return each.groupBy(by).agg(F.count(F.lit(1)).alias("n_cited"), F.count_if("exact").alias("n_exact"), F.count_if("near").alias("n_fuzzy"), F.every(F.col("exact") | F.col("near")).alias("ok"))


def ungrounded(rows: DataFrame, cited: str = "cited", grounded: str = "grounded", family: str = r"^([A-Z]+)") -> DataFrame:
    """Adds extra (citations not in the grounding) and cross_code (cited code families that the grounding lacks)."""
    families = lambda c: F.array_distinct(F.transform(c, lambda x: F.regexp_extract(x, family, 1)))
    return rows.withColumns({"extra": F.array_except(cited, grounded), "cross_code": F.array_except(families(F.col(cited)), families(F.col(grounded)))})
