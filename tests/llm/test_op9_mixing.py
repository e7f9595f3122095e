import itertools
import random
import re

import numpy as np
import pytest

from quern.llm.mixing import fit_counts, mix_to_targets, take_mix
from quern.llm.queries import op9_mixing
from tests.compare import SMALL


def targets(sizes, weights=(5, 2, 1), share=1.5):
    """Share the budget by weight, hold each at its cap, share the excess anew until none is above."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: s.encode()) + [s for s in sizes if s is None]
    w = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    left, free, out = share * sum(sizes.values()), set(names), {}
    while free:
        level = left / sum(w[s] for s in free)
        over = {s for s in free if level * w[s] > 2 * sizes[s]}
        if not over:
            return out | {s: level * w[s] for s in free}
        for s in over:
            out[s] = 2.0 * sizes[s]
            left -= out[s]
        free -= over
    return out


def check(rows, texts):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t in texts]
    sizes = {}
    for (s, _), n in zip(texts, size):
        sizes[s] = sizes.get(s, 0) + n
    want, taken = targets(sizes), dict.fromkeys(sizes, 0)
    assert sorted(r.size for r in rows) == sorted(size)
    for r in rows:
        assert r.source_size == sizes[r.source] and r.target == pytest.approx(want[r.source]) and r.taken in (0, r.size, 2 * r.size)
        taken[r.source] += r.taken
    return {s: taken[s] - want[s] for s in sizes}


def test_query_hits_every_target_and_repeats(spark):
    texts = [(r.source, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    rows = op9_mixing(spark, SMALL).collect()
    gaps = check(rows, texts)
    assert max(abs(g) for g in gaps.values()) < 60
    assert sorted(rows, key=str) == sorted(op9_mixing(spark, SMALL).collect(), key=str)


def test_odd_rows(spark):
    rng = random.Random(3)
    texts = [(s, " ".join(["w"] * rng.randrange(1, 40))) for s in ("b", "a", "é", "Z", None) for _ in range(120)] + [("b", None), ("empty", ""), ("empty", " \t")] + [("b", "same words here")] * 50
    df = spark.createDataFrame([(i if i % 7 else None, s, t, 0) for i, (s, t) in enumerate(texts)], "doc_id long, source string, text string, size int")
    for bucket in (256, 2):
        gaps = check(mix_to_targets(df, bucket_rows=bucket).collect(), texts)
        assert max(abs(g) for g in gaps.values()) <= 0.5 + 1e-9
    assert mix_to_targets(df.limit(0)).count() == 0
    taken = {(r.doc_id, r.text): r.times for r in take_mix(df).collect()}
    assert set(taken.values()) <= {1, 2} and take_mix(df).columns == [*df.columns, "times"]


def test_fit_is_the_nearest_subset_sum():
    rng = np.random.default_rng(0)
    for _ in range(200):
        lengths = np.unique(rng.integers(1, 30, size=rng.integers(1, 5)))
        counts = rng.integers(1, 4, size=len(lengths))
        total = int((lengths * counts).sum())
        target = float(rng.uniform(0, 2 * total))
        base, extra = fit_counts(lengths, counts, target, 2, 20_000)
        assert (extra <= counts).all() and base in (0, 1, 2)
        got = base * total + int((extra * lengths).sum())
        sums = {sum(n * x for n, x in zip(c, lengths)) for c in itertools.product(*[range(k + 1) for k in counts])}
        best = min(abs(base * total + s - round(target)) for s in sums)
        assert abs(got - round(target)) == best, (lengths, counts, target)


def test_large_fit_is_exact():
    lengths, counts = np.arange(1, 3000), np.full(2999, 50)
    for target in (1e6, 123_456_789.0, 2.2e8):
        base, extra = fit_counts(lengths, counts, target, 2, 20_000)
        assert base * int((lengths * counts).sum()) + int((extra * lengths).sum()) == target


def test_column_order_and_long_texts(spark):
    assert op9_mixing(spark, SMALL).columns == ["doc_id", "size", "source_size", "target", "taken", "source"]
    df = spark.createDataFrame([(1, "a", "w " * 300_000), (2, "a", "w"), (3, "b", "w w")], "doc_id long, source string, text string")
    got = {r.doc_id: (r.size, r.source_size) for r in mix_to_targets(df).collect()}
    assert got == {1: (300_000, 300_001), 2: (1, 300_001), 3: (2, 2)}
