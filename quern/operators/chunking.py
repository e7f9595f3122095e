"""Chunks of documents for grounding."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.strings import bound, words


def chunk_words(docs: DataFrame, size: int = 256, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, chunk_ix from 0, chunk_text, n_words): runs of `size` words; a text without words has none."""

    def cut(w: Column) -> Column:
        n = F.ceil(F.size(w) / size).cast("int")
        return F.when(n > 0, F.transform(F.sequence(F.lit(0), F.greatest(n, F.lit(1)) - 1), lambda i: F.slice(w, i * size + 1, size)))

    parts = bound(words(F.col(text)), cut)
    return docs.select(id_col, F.posexplode(parts).alias("chunk_ix", "w")).select(id_col, F.col("chunk_ix").cast("long"), F.array_join("w", " ").alias("chunk_text"), F.size("w").cast("long").alias("n_words"))


def chunk_paragraphs(docs: DataFrame, budget: int = 2048, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(id_col, chunk_ix, chunk_id, chunk_text, n_tokens): whole paragraphs up to `budget` words; a longer paragraph is a chunk alone.

    Structure is kept: a chunk is a run of paragraphs, so no citation is cut in two. chunk_id is a hash of id and number.
    """
    kind = dict(docs.dtypes)[id_col]

    def split(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            out = []
            for own, t in zip(pdf[id_col], pdf[text]):
                held, n, k = [], 0, 0
                for p in (t or "").split("\n"):
                    m = len(p.split())
                    if held and n + m > budget:
                        out.append((own, k, "\n".join(held), n))
                        held, n, k = [], 0, k + 1
                    if m:
                        held.append(p)
                        n += m
                if held:
                    out.append((own, k, "\n".join(held), n))
            yield pd.DataFrame(out, columns=[id_col, "chunk_ix", "chunk_text", "n_tokens"])

    made = docs.select(id_col, text).mapInPandas(split, f"{id_col} {kind}, chunk_ix long, chunk_text string, n_tokens long")
    return made.withColumn("chunk_id", F.md5(F.concat_ws("|", id_col, "chunk_ix")))
