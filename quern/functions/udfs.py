"""Python function surface: vectorised scalar and grouped functions and a table function."""

from __future__ import annotations

import math
from collections import Counter

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, IntegerType, StringType, StructField, StructType


@F.pandas_udf(DoubleType())
def word_entropy(texts: pd.Series) -> pd.Series:
    """Entropy in bits of a text's words; 0 for null and for texts without words."""

    def one(t: str | None) -> float:
        counts = Counter((t or "").split()).values()
        total = sum(counts)
        return -sum(c / total * math.log2(c / total) for c in counts) + 0.0

    return texts.map(one, na_action=None).astype(float)


@F.pandas_udf(DoubleType())
def trimmed_mean(values: pd.Series) -> float:
    """Mean of what lies between the 10th and the 90th percentile; null without values."""
    v = values.dropna()
    if not len(v):
        return float("nan")
    lo, hi = v.quantile(0.1), v.quantile(0.9)
    return float(v[(v >= lo) & (v <= hi)].mean())


@F.udtf(returnType=StructType([StructField("sentence_ix", IntegerType()), StructField("sentence", StringType())]))
class Sentences:
    """Rows of a text's sentences; none for null."""

    def eval(self, text: str):
        for i, s in enumerate(x.strip() for x in (text or "").split(".") if x.strip()):
            yield i, s
