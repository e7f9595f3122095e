import random

import pytest

from quern.operators import folds, guard
from quern.streaming import guards, runs


def greedy(spark, sizes, least):
    rows = spark.createDataFrame([(0, i, n) for i, n in enumerate(sizes)], "shard int, i int, n int")
    out = folds.greedy_groups(rows.repartition(3), "shard", "i", "n", least).orderBy("i").collect()
    return [(r.i, r.group_id) for r in out]


def test_threshold_is_inclusive_and_rest_is_dropped(spark):
    assert greedy(spark, [5, 5, 5], 10) == [(0, 0), (1, 0)]
    assert greedy(spark, [None, 10, 3], 10) == [(0, 0), (1, 0)]
    assert greedy(spark, [1, 2], 10) == []


def test_groups_of_long_rows(spark):
    out = greedy(spark, [4000] * 200, folds.least_chars(6144))
    assert max(g for _, g in out) == 19 and len(out) == 200 and folds.least_chars(0, 8192) == 6 * 8192


def test_random_folds_against_a_loop(spark):
    rng = random.Random(1)
    for _ in range(3):
        sizes, least = [rng.randrange(50) for _ in range(40)], rng.randrange(1, 120)
        want, held, total, g = [], [], 0, 0
        for i, n in enumerate(sizes):
            held.append((i, g))
            total += n
            if total >= least:
                want += held
                held, total, g = [], 0, g + 1
        assert greedy(spark, sizes, least) == want


def test_packing(spark):
    sizes = [5, 4, 3, 3, 9, 11, 2]
    bins = folds.best_fit_bins(sizes, 10)
    assert bins[5] == -1
    for b in set(bins) - {-1}:
        assert sum(s for s, x in zip(sizes, bins) if x == b) <= 10
    assert max(bins) + 1 == 3
    rows = spark.createDataFrame([(i % 2, i, n) for i, n in enumerate([*sizes, None])], "s int, i int, n int")
    assert folds.pack(rows, "s", "i", "n", 10).count() == 6


CASES = [
    (2, 3, [(1, "nan"), (2, "nan")], None),
    (2, 3, [(i, "nan") for i in range(1, 6)], 5),
    (2, 3, [(3, "nan"), (4, "0.31"), (5, "nan"), (6, "nan"), (7, "nan")], 7),
    (0, 2, [(1, "inf"), (2, "nan")], 2),
    (0, 2, [(1, "nan"), (2, None), (3, "n/a"), (4, "nan")], 4),
    (0, 2, [(1, "-inf"), (2, "1e3"), (3, "Infinity"), (4, "nan")], 4),
]


@pytest.mark.parametrize("grace,window,logs,fired", CASES)
def test_streaks(spark, grace, window, logs, fired):
    df = spark.createDataFrame([("r", s, v) for s, v in logs], "run_id string, step long, grad_norm string")
    got = guard.first_streaks(df, grace=grace, window=window).collect()
    assert [r.fired_step for r in got] == ([] if fired is None else [fired])
    streak, first = 0, None
    for s, v in logs:
        streak = guards.advance(streak, s, v, grace)
        first = s if first is None and streak >= window else first
    assert first == fired


def test_stream_guard_fails_the_query_and_resumes(spark, tmp_path):
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", runs.ROCKS)
    schema = "run_id string, step long, grad_norm string"
    src = tmp_path / "in"
    path, check = f"file://{tmp_path}/out", f"file://{tmp_path}/check"

    def add(*rows):
        spark.createDataFrame([("r", *x) for x in rows], schema).coalesce(1).write.mode("append").json(f"file://{src}")

    def stream():
        return guards.guard_divergence(spark.readStream.schema(schema).json(f"file://{src}"))

    add((3, "nan"), (4, "nan"))
    runs.run_to_end(stream(), path, check)
    assert spark.read.schema("run_id string, step long, streak int").parquet(path).count() == 2
    add((5, "nan"))
    with pytest.raises(Exception, match="3 non-finite values"):
        runs.run_to_end(stream(), path, check)


def test_retries_and_tee():
    tries = []

    def work(k):
        tries.append(k)
        if k < 2:
            raise OSError("again")
        return k

    assert runs.retried(work) == 2 and tries == [0, 1, 2]
    with pytest.raises(OSError):
        runs.retried(lambda k: (_ for _ in ()).throw(OSError("no")), attempts=2)
