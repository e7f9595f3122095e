"""Decontamination against a protected set: exact word 13-grams, and embeddings above a calibrated threshold."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import word_ngrams

#: Words are runs of letters and digits of any script, in lower case.
_SPLIT = r"[^\p{L}\p{N}]+"


def ngrams(df: DataFrame, key: str, text: str = "text", n: int = 13) -> DataFrame:
    """(key, gram): the distinct hashed n-grams of each row."""
    tokens = F.filter(F.split(F.lower(F.coalesce(F.col(text), F.lit(""))), _SPLIT), lambda x: x != "")
    grams = F.transform(word_ngrams(tokens, n), lambda g: F.xxhash64(g))
    return df.select(key, F.explode(F.array_distinct(grams)).alias("gram"))


def contaminated(docs: DataFrame, protected: DataFrame, id_col: str = "doc_id", item: str = "item_id", text: str = "text", n: int = 13, quotable: DataFrame | None = None) -> DataFrame:
    """(id_col, n_shared): rows that share word n-grams with the protected set, but for those of `quotable` texts.

    Grams are 64-bit hashes; the protected side is distinct grams, so the join gives at most one row a document gram, and AQE
    broadcasts it if its measured size allows.
    """
    guard = ngrams(protected, item, text, n).select("gram").distinct()
    if quotable is not None:
        guard = guard.join(ngrams(quotable, quotable.columns[0], text, n).select("gram").distinct(), "gram", "left_anti")
    return ngrams(docs, id_col, text, n).join(guard, "gram", "left_semi").groupBy(id_col).agg(F.count(F.lit(1)).alias("n_shared"))


def calibrated_threshold(negatives: DataFrame, first: str, second: str, rate: float, cells: int = 10_000) -> float:
    """The least cosine, in steps of 1 / cells, that at most a share `rate` of known negatives reaches: a threshold for similarity_screen.

    Each row of `negatives` holds two vectors known not to be near. Their cosines are counted by step, so that at most
    2 * cells + 1 counts leave the cluster. A vector of zeros has a cosine of 0. Rows with a null vector or element,
    without a finite norm, or with vectors of different lengths are not counted; where none is left that is an error.
    """
    if not 0 <= rate < 1:
        raise ValueError("rate must be at least 0 and below 1")

    def dot(x: str, y: str) -> Column:
        products = F.zip_with(x, y, lambda a, b: a.cast("double") * b.cast("double"))
        return F.aggregate(products, F.lit(0.0), lambda total, one: total + one)

    norms = F.sqrt(dot(first, first)) * F.sqrt(dot(second, second))
    cosine = F.when(norms == 0, 0.0).otherwise(F.nanvl(dot(first, second) / norms, F.lit(None).cast("double")))
    step = F.floor(F.when(cosine > 1, 1.0).otherwise(cosine) * cells)
    counts = negatives.filter(F.size(first) == F.size(second)).select(step.alias("step")).filter("step is not null").groupBy("step").count().collect()
    least, above = rate * sum(r["count"] for r in counts), 0
    for r in sorted(counts, reverse=True):
        above += r["count"]
        if above > least:
            return (r["step"] + 1) / cells
    raise ValueError("no known negatives to calibrate on")


def similarity_screen(vectors: DataFrame, protected: DataFrame, threshold: float, id_col: str = "vec_id", vector: str = "embedding", block_rows: int = 2048) -> DataFrame:
    """(id_col, n_near): rows with protected vectors at a cosine of at least `threshold`, a calibrated parameter.

    Both sides are cut into blocks of about block_rows, and every block of vectors meets every block of protected ones in a
    task of its own: no set is gathered whole, and counts leave a task, never pairs. Null ids, null vectors and vectors with
    null elements are near nothing, nor are vectors of different lengths.
    """

    def blocks(df: DataFrame) -> tuple[DataFrame, int]:
        v = F.transform(vector, lambda x: x.cast("double"))
        known = df.select(F.col(id_col).alias("id"), v.alias("v")).filter("id is not null and v is not null and not exists(v, x -> x is null)")
        n = max(1, -(-known.count() // block_rows))
        return known.select("id", "v", F.size("v").alias("dim"), F.pmod(F.xxhash64("id"), F.lit(n)).alias("own")), n

    (rows, n), (guard, m) = blocks(vectors), blocks(protected)
    each = lambda k: F.explode(F.sequence(F.lit(0).cast("long"), F.lit(k - 1).cast("long")))
    rows = rows.select("id", "v", "dim", F.col("own").alias("p"), each(m).alias("q"))
    guard = guard.select("id", "v", "dim", each(n).alias("p"), F.col("own").alias("q"))

    def unit(v: pd.Series) -> np.ndarray:
        x = np.stack(v.to_numpy()).astype(np.float64)
        norm = np.sqrt((x * x).sum(1, keepdims=True))
        return np.divide(x, norm, out=np.zeros_like(x), where=norm > 0)

    def screen(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
        if not len(a) or not len(b):
            return pd.DataFrame({"id": a["id"][:0], "near": np.zeros(0, dtype=np.int64)})
        near = (unit(a["v"]) @ unit(b["v"]).T >= threshold) & (a["id"].to_numpy()[:, None] != b["id"].to_numpy()[None, :])
        counts = near.sum(1).astype(np.int64)
        return pd.DataFrame({"id": a["id"][counts > 0], "near": counts[counts > 0]})

    key = ["dim", "p", "q"]
    found = rows.groupBy(*key).cogroup(guard.groupBy(*key)).applyInPandas(screen, f"id {rows.schema['id'].dataType.simpleString()}, near long")
    return found.groupBy(F.col("id").alias(id_col)).agg(F.sum("near").alias("n_near"))
