import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from quern.llm.quality import STYLES, OrdinalModel, features, fit_ordinal, label_grade, score_quality, select_quality, tails, train
from quern.llm.queries import op5_quality

SF = "/root/testdata/sf0.1"
SMALL = "/root/testdata/sf0.001"


def test_held_out_accuracy(spark):
    docs, labels = spark.read.parquet(f"{SF}/documents.parquet"), spark.read.parquet(f"{SF}/labels.parquet")
    learn, held = labels.filter("doc_id % 4 <> 0"), labels.filter("doc_id % 4 = 0")
    kept = select_quality(docs, learn, label_grade()).select("doc_id").distinct()
    all_, got = {}, {}
    for name, df in (("all", held), ("kept", held.join(kept, "doc_id"))):
        target = all_ if name == "all" else got
        for r in df.groupBy(label_grade().alias("g")).count().collect():
            target[r.g] = r["count"]
    assert got[2] / all_[2] > 0.97 and got.get(0, 0) / all_[0] < 0.15 and got.get(1, 0) / all_[1] < 0.25, (got, all_)


def test_gradient_and_order():
    rng = np.random.default_rng(0)
    x = [np.unique(rng.integers(0, 40, size=rng.integers(1, 12))) for _ in range(1500)]
    w = rng.normal(size=40)
    z = np.array([w[i].sum() for i in x]) + rng.logistic(size=1500)
    y = np.searchsorted([-1.5, 1.0, 2.5], z) * 2
    ids, cuts = np.concatenate(x).astype(np.int32), np.concatenate([[0], np.cumsum([len(i) for i in x])])
    m = fit_ordinal(ids, cuts, y, 64, l2=0.01)
    assert (np.diff(m.thresholds) > 0).all() and np.corrcoef(m.weights[:40], w)[0, 1] > 0.95
    assert list(m.grades) == [0, 2, 4, 6]
    p = tails(m, ids, cuts)
    assert (np.diff(p, axis=1) <= 1e-12).all() and abs(p[:, 0].mean() - (y > 0).mean()) < 0.03


def test_features_are_those_of_the_text_alone():
    texts = ["The cat sat.", None, "", "x | y | z ### !!!", "of of of of of", "a" * 50_000 + " b", "The cat sat."]
    ids, cuts = features(pa.array(texts), 1 << 16)
    for i, t in enumerate(texts):
        own, c = features(pa.array([t], pa.string()), 1 << 16)
        assert own.tolist() == ids[cuts[i] : cuts[i + 1]].tolist() and len(set(own.tolist())) == len(own)
    assert ids[cuts[0] : cuts[1]].tolist() == ids[cuts[6] : cuts[7]].tolist() and cuts[1] == cuts[2] == cuts[3]


def test_scores_are_the_formula(spark):
    m = OrdinalModel(np.zeros((1 << 10) + STYLES), np.array([-1.0, 0.5]), np.array([0, 1, 2]))
    m.weights[features(pa.array(["good"]), 1 << 10)[0]] = 0.5
    df = spark.createDataFrame([(1, "good", 9), (1, "good", 9), (2, None, 9), (3, "", 9)], "doc_id long, text string, p_best int")
    n = len(features(pa.array(["good"]), 1 << 10)[0])
    s = lambda x: 1 / (1 + math.exp(-x))
    got = sorted((r.doc_id, r.expected_grade, r.p_best) for r in score_quality(df, m).collect())
    for (i, e, p), z in zip(got, (0.5 * n, 0.5 * n, 0, 0)):
        assert p == pytest.approx(1 - s(0.5 - z), rel=1e-5) and e == pytest.approx(2 - s(-1 - z) - s(0.5 - z), rel=1e-5)
    assert len(got) == 4 and set(score_quality(df, m).columns) == {"doc_id", "text", "expected_grade", "p_best"}


def test_no_labels_one_grade_and_empty(spark):
    df = spark.createDataFrame([(1, "a"), (2, None)], "doc_id long, text string")
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    one = spark.createDataFrame([(1, 1, 0), (None, 1, 0), (2, None, None)], "doc_id long, quality int, toxic int")
    for labels in (none, one):
        assert select_quality(df, labels, label_grade()).count() == 2
    assert select_quality(df.limit(0), one, label_grade()).count() == 0
    assert train(df, one, label_grade()).grades.tolist() == [2]
    assert df.select(F.lit(1)).count() == 2


def test_fit_is_the_optimum():
    """Against the likelihood written out row by row: no small step in any coordinate lowers it."""
    rng = np.random.default_rng(3)
    x = [np.unique(rng.integers(0, 8, size=rng.integers(1, 6))) for _ in range(120)]
    y = rng.integers(0, 3, size=120)
    ids, cuts = np.concatenate(x).astype(np.int32), np.concatenate([[0], np.cumsum([len(i) for i in x])])
    l2 = np.array([0.5] * 6 + [0.0625] * 2)
    m = fit_ordinal(ids, cuts, y, 8, l2)
    s = lambda v: 1 / (1 + math.exp(-v))

    def loss(w, t):
        total = 0.5 * float((l2 * w) @ w)
        for own, g in zip(x, y):
            z = w[own].sum()
            upper, lower = (s(t[g] - z) if g < 2 else 1.0), (s(t[g - 1] - z) if g else 0.0)
            total -= math.log(upper - lower)
        return total

    least = loss(m.weights, m.thresholds)
    for k in range(8):
        for step in (0.02, -0.02):
            w = m.weights.copy()
            w[k] += step
            assert loss(w, m.thresholds) > least - 1e-6
    for k in range(2):
        for step in (0.02, -0.02):
            t = m.thresholds.copy()
            t[k] += step
            assert loss(m.weights, t) > least - 1e-6


def test_query_is_the_formula_over_all_documents(spark):
    docs, labels = spark.read.parquet(f"{SMALL}/documents.parquet"), spark.read.parquet(f"{SMALL}/labels.parquet")
    m = train(docs, labels, label_grade())
    w, want = m.weights.astype(np.float32), {}
    for r in docs.collect():
        z = float(w[features(pa.array([r.text], pa.string()), len(w) - STYLES)[0]].astype(np.float64).sum())
        above = [1 / (1 + math.exp(t - z)) for t in m.thresholds]
        if above[-1] >= 0.5:
            want[r.doc_id] = (float(m.grades[0]) + sum(p * (b - a) for p, a, b in zip(above, m.grades, m.grades[1:])), above[-1])
    got = {r.doc_id: (r.expected_grade, r.p_best) for r in op5_quality(spark, SMALL).collect()}
    assert set(got) == set(want) and len(got) < docs.count()
    assert all(got[i] == pytest.approx(want[i], rel=1e-6) for i in want)


def test_repeated_ids_ties_and_bounds(spark):
    rows = [(i % 20, f"good words here number{i}" if i % 2 else f"bad ### text {i}", 0) for i in range(40)] + [(None, "x", 0), (3, None, 0), (4, "long " * 200_000, 0)]
    df = spark.createDataFrame(rows, "doc_id long, text string, grade int")
    labels = spark.createDataFrame([(i % 20, i % 2, 0) for i in range(60)], "doc_id long, quality int, toxic int")
    one = train(df, labels, label_grade(), max_rows=10)
    assert one.grades.tolist() == [1, 2] and (train(df.repartition(5), labels, label_grade(), max_rows=10).weights == one.weights).all()
    assert train(df, labels, label_grade(), max_features=0).grades.tolist() == []
    assert score_quality(df, one).count() == len(rows)
