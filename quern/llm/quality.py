"""Quality classifier: ordinal cumulative-link regression on graded ratings with hashed-text weights."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from .common import settle, small_batches
from .words import mix, text_bytes, words_of_bytes

#: Density steps (share of a text's bytes) of the style features.
DENSITY = np.array([1e-9, 1e-3, 5e-3, 2e-2, 8e-2, 0.2, 0.4])
#: Bytes whose density is a feature: ASCII punctuation, digits and line feeds.
SIGNS = np.array([10, *range(33, 65), *range(91, 97), *range(123, 127)])
#: Signs that ordinary prose hardly has.
SYMBOLS = np.frombuffer(b"#$%&*+<=>@[\\]^_`{|}~", dtype=np.uint8)
#: Bytes in a word's heads.
HEADS = (4, 5)
#: Style features, whose ids follow the hashed ones, and their share of the penalty: one is worth more than one word among hundreds.
STYLES, STYLE_PENALTY = (len(SIGNS) + 3) * len(DENSITY), 0.125
#: Rows that the fit handles at once.
BLOCK = 512


@dataclass
class OrdinalModel:
    """P(grade <= k) = sigmoid(thresholds[k] - weights . features), with ordered thresholds and one weight a hash."""

    weights: np.ndarray
    thresholds: np.ndarray
    grades: np.ndarray


def features(column: pa.Array, dim: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct feature ids of each text and offsets: hashed words and word heads (below dim), and style (STYLES ids from dim on).

    Style is the density of each sign, of the symbols together, of words that repeat the one before and of words met before,
    in steps; a text in a high step has the features of the lower ones too.
    """
    data, offsets = text_bytes(column)
    n = len(offsets) - 1
    hashes, cuts = words_of_bytes(data, offsets)
    size, total = np.maximum(np.diff(offsets), 1), np.maximum(np.diff(cuts), 1)
    doc = np.repeat(np.arange(n), np.diff(cuts))
    place = np.full(256, -1)
    place[SIGNS] = np.arange(len(SIGNS))
    where = place[data]
    seen = where >= 0
    signs = np.bincount(np.repeat(np.arange(n), np.diff(offsets))[seen] * len(SIGNS) + where[seen], minlength=n * len(SIGNS)).reshape(n, len(SIGNS))
    symbols = signs[:, np.isin(SIGNS, SYMBOLS)].sum(1)
    own = np.unique(doc * (1 << 40) + (hashes >> np.uint64(24)).astype(np.int64))
    fresh = np.bincount(own >> 40, minlength=n)
    same = np.bincount(doc[1:][(hashes[1:] == hashes[:-1]) & (doc[1:] == doc[:-1])], minlength=n)
    # A text of n words has some 8 * sqrt(n) different ones; a short one no fewer than it has words.
    met = np.where(np.diff(cuts) > 0, np.maximum(0, 1 - fresh / np.minimum(total, 8 * np.sqrt(total))), 0)
    style = np.column_stack([signs / size[:, None], symbols / size, same / total, met])
    step = np.searchsorted(DENSITY, style, side="right")
    d, s = np.nonzero(step)
    ids, docs = [(hashes >> np.uint64(20)) % np.uint64(dim)], [doc]
    for head in HEADS:
        ids.append(mix(words_of_bytes(data, offsets, head)[0] + np.uint64(head)) % np.uint64(dim))
        docs.append(doc)
    for k in range(1, len(DENSITY) + 1):
        at = step[d, s] >= k
        ids.append((dim + s[at] * len(DENSITY) + k - 1).astype(np.uint64))
        docs.append(d[at])
    both = np.unique(np.concatenate(docs).astype(np.int64) * (dim + STYLES) + np.concatenate(ids).astype(np.int64))
    return (both % (dim + STYLES)).astype(np.int32), np.searchsorted(both // (dim + STYLES), np.arange(n + 1))


def _row_sums(values: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """Sum of each row's values, by itself, so that it does not depend on the rows beside it."""
    out = np.zeros(len(cuts) - 1)
    some = np.flatnonzero(np.diff(cuts))
    if len(some):
        out[some] = np.add.reduceat(values.astype(np.float64), cuts[some])
    return out


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 0.5 * (1 + np.tanh(x / 2))


def fit_ordinal(ids: np.ndarray, cuts: np.ndarray, ratings: np.ndarray, dim: int, l2: float | np.ndarray = 0.5, steps: int = 150) -> OrdinalModel:
    """Maximum likelihood with an l2 penalty (one, or one a weight), by L-BFGS on weights, first threshold and the logs of the gaps between thresholds."""
    grades = np.unique(ratings)
    k, rows = len(grades), len(ratings)
    if k < 2:
        return OrdinalModel(np.zeros(dim), np.zeros(0), grades)
    y = np.searchsorted(grades, ratings)
    lens = np.diff(cuts)
    below = np.array([(y <= i).mean() for i in range(k - 1)])
    start = np.log(below / (1 - below))
    x = np.concatenate([np.zeros(dim), start[:1], np.log(np.maximum(np.diff(start), 1e-3))])

    def thresholds(x: np.ndarray) -> np.ndarray:
        return np.cumsum(np.concatenate([x[dim : dim + 1], np.exp(x[dim + 1 :])]))

    def loss(x: np.ndarray) -> tuple[float, np.ndarray]:
        t, g, total = np.concatenate([[-np.inf], thresholds(x), [np.inf]]), np.zeros_like(x), 0.0
        g[:dim], d_t = l2 * x[:dim], np.zeros(k - 1)
        for a in range(0, rows, BLOCK):  # in blocks, so that little more than the sample itself is held
            b = min(a + BLOCK, rows)
            own, y_own = ids[cuts[a] : cuts[b]], y[a:b]
            z = _row_sums(x[own], cuts[a : b + 1] - cuts[a])
            hi, lo = _sigmoid(t[y_own + 1] - z), _sigmoid(t[y_own] - z)
            p = np.maximum(hi - lo, 1e-12)
            d_hi, d_lo = hi * (1 - hi) / p, lo * (1 - lo) / p
            g[:dim] += np.bincount(own, weights=np.repeat(d_hi - d_lo, lens[a:b]), minlength=dim)
            d_t += [d_lo[y_own == i + 1].sum() - d_hi[y_own == i].sum() for i in range(k - 1)]
            total -= np.log(p).sum()
        tail = np.cumsum(d_t[::-1])[::-1]
        g[dim] = tail[0]
        g[dim + 1 :] = tail[1:] * np.exp(x[dim + 1 :])
        return total + 0.5 * float((l2 * x[:dim]) @ x[:dim]), g

    f, g = loss(x)
    small, past = 0, []
    for _ in range(steps):
        d, alphas = -g, []
        for s, u, r in reversed(past):
            alphas.append(r * float(s @ d))
            d = d - alphas[-1] * u
        if past:
            d *= 1 / (past[-1][2] * float(past[-1][1] @ past[-1][1]))
        for (s, u, r), a in zip(past, reversed(alphas)):
            d = d + s * (a - r * float(u @ d))
        slope, t = float(g @ d), 1.0 if past else min(1.0, 1 / max(1e-12, float(np.abs(g).sum())))
        while t > 1e-10:
            f_new, g_new = loss(x + t * d)
            if f_new <= f + 1e-4 * t * slope:
                break
            t /= 2
        else:
            break
        s, u = t * d, g_new - g
        x, gain, f, g = x + s, f - f_new, f_new, g_new
        if float(s @ u) > 1e-12:
            past = [*past[-7:], (s, u, 1 / float(s @ u))]
        small = small + 1 if gain < 1e-5 * rows else 0
        if small == 3:
            break
    return OrdinalModel(x[:dim], thresholds(x), grades)


def tails(model: OrdinalModel, ids: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """P(grade > k) for each text (row) and threshold k."""
    return 1 - _sigmoid(model.thresholds[None, :] - _row_sums(model.weights[ids], cuts)[:, None])


def train(
    docs: DataFrame, ratings: DataFrame, grade: Column, max_rows: int = 8_000, max_features: int = 8_000_000, dim: int = 1 << 18, l2: float = 0.5, id_col: str = "doc_id",
    text_col: str = "text",
) -> OrdinalModel:
    """Fit on a bounded sample of rated documents: the first max_rows by a hash of the id, as far as they have max_features feature ids together.

    Features are computed on the executors; ids and grades of the sample are broadcast, its feature ids (4 bytes each) come to
    the driver. Of documents that share a rated id the smallest text counts, so no id brings more than one row; an id with
    several ratings has the lowest. Ties of the hash go to the smaller id.
    """
    small_batches(docs.sparkSession)
    few = ratings.select(F.col(id_col).alias("id"), grade.cast("int").alias("grade")).filter("id is not null and grade is not null")
    few = few.groupBy("id").agg(F.min("grade").alias("grade")).orderBy(F.xxhash64("id"), "id").limit(max_rows)
    rated = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col), F.lit("")).alias("t")).join(F.broadcast(few), "id").groupBy("id", "grade").agg(F.min("t").alias("t"))

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, cuts = features(b.column("t"), dim)
            yield pa.RecordBatch.from_arrays([b.column("id").cast(pa.int64()), b.column("grade"), pa.array(np.diff(cuts)), pa.array([ids[i:j].tobytes() for i, j in zip(cuts[:-1], cuts[1:])], pa.binary())], ["id", "grade", "n", "ids"])

    made = settle(rated.mapInArrow(extract, "id long, grade int, n long, ids binary").withColumn("h", F.xxhash64("id")), "rated")
    first = Window.orderBy("h", "id").rowsBetween(Window.unboundedPreceding, 0)  # of max_rows small rows
    held = [r["id"] for r in made.select("h", "id", F.sum("n").over(first).alias("n")).filter(F.col("n") <= max_features).collect()]
    keep = docs.sparkSession.createDataFrame([(i,) for i in held], "id long")
    rows = sorted(made.join(F.broadcast(keep), "id").select("h", "id", "grade", "ids").collect())
    cuts = np.concatenate([[0], np.cumsum([len(r[3]) // 4 for r in rows])]).astype(np.int64)
    ids, graded = np.frombuffer(b"".join(r[3] for r in rows), dtype=np.int32), np.array([r[2] for r in rows], dtype=np.int64)
    del rows
    return fit_ordinal(ids, cuts, graded, dim + STYLES, np.concatenate([np.full(dim, l2), np.full(STYLES, l2 * STYLE_PENALTY)]))


def score_quality(docs: DataFrame, model: OrdinalModel, text_col: str = "text") -> DataFrame:
    """docs with expected_grade and p_best, the probability of the highest grade (both double).

    Whole texts are scored where they lie: no shuffle. Null text counts as empty, and empty text is scored by the thresholds
    alone. A model of fewer than two grades knows nothing to reject: p_best is 1, expected_grade its grade (0 if it has none).
    All columns and repeated rows stay; columns named like the new ones are replaced; an empty table gives no rows.
    """
    small_batches(docs.sparkSession)
    docs = docs.drop("expected_grade", "p_best")
    if len(model.grades) < 2:
        only = float(model.grades[0]) if len(model.grades) else 0.0
        return docs.withColumns({"expected_grade": F.lit(only), "p_best": F.lit(1.0)})
    shared = docs.sparkSession.sparkContext.broadcast(OrdinalModel(model.weights.astype(np.float32), model.thresholds, model.grades))

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for b in batches:
            p = tails(m, *features(b.column(text_col), len(m.weights) - STYLES))
            expected = m.grades[0] + (p * np.diff(m.grades)[None, :]).sum(1)
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array(expected), pa.array(p[:, -1])], [*b.schema.names, "expected_grade", "p_best"])

    return docs.mapInArrow(score, StructType([*docs.schema.fields, StructField("expected_grade", DoubleType()), StructField("p_best", DoubleType())]))


def select_quality(docs: DataFrame, ratings: DataFrame, grade: Column, least: float = 0.5, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """docs (with expected_grade and p_best) whose probability of the highest grade is at least `least`."""
    return score_quality(docs, train(docs, ratings, grade, id_col=id_col, text_col=text_col), text_col).filter(F.col("p_best") >= least)


def label_grade() -> Column:
    """Grades of the labels: 0 toxic, 1 clean but of low quality, 2 clean and good; null without a rating."""
    return F.when(F.col("toxic") == 1, 0).when(F.col("quality") == 1, 2).when(F.col("quality") == 0, 1)


__all__ = ["OrdinalModel", "features", "fit_ordinal", "label_grade", "score_quality", "select_quality", "tails", "train"]
