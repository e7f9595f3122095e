import math
import random

from pyspark.sql import functions as F

from quern.llm import topk
from quern.llm.queries import ORACLE_SQL, QUERIES
from quern.llm.topk import exact_top_k
from tests.compare import SMALL, of_spark, oracle


def plain(rows, k=5):
    clean = [(i, [math.floor(256 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for n, (q, v) in enumerate(clean):
        if q % 50 == 0:
            scored = sorted((-sum(a * b for a, b in zip(v, w)), i) for m, (i, w) in enumerate(clean) if m != n and len(w) == len(v))[:k]
            out += [(q, r + 1, i, -s) for r, (s, i) in enumerate(scored)]
    return sorted(out)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, score string")
    return sorted(tuple(r) for r in exact_top_k(df, F.col("vec_id") % 50 == 0, **options).collect())


def test_equals_sql(spark):
    assert of_spark(QUERIES["op4_topk"](spark, SMALL)) == oracle(ORACLE_SQL["op4_topk"])


def test_ties_nulls_and_odd_rows(spark, monkeypatch):
    rng = random.Random(1)
    f32 = lambda x: float(F32(x))
    rows = [(i, [f32(rng.gauss(0, 1)) for _ in range(8)]) for i in range(200)]
    rows += [(300 + i, rows[3][1]) for i in range(30)] + [(400, None), (401, [None] * 8), (402, [float("nan")] * 8), (403, [float("inf")] * 8), (None, [1.0] * 8), (450, [1.0, 2.0]), (451, [3.0, 1.0]), (500, [])]
    for options in ({}, {"n_pivots": 1, "pivot_sample": 3}, {"query_block": 2}):
        assert run(spark, rows, **options) == plain(rows)
    monkeypatch.setattr(topk, "WAVE", 2)
    assert run(spark, rows, query_block=1) == plain(rows)


def F32(x):  # noqa: N802
    import numpy as np

    return np.float32(x)


def test_few_rows_huge_values_and_empty(spark):
    assert run(spark, [(0, [1.0, 2.0]), (1, [2.0, 0.5])]) == [(0, 1, 1, 256 * 512 + 512 * 128)]
    assert run(spark, [(0, [1.0])]) == []
    big = run(spark, [(0, [2.0**40, 1.0]), (1, [2.0**20, 1.0])])
    assert big == [(0, 1, 1, min(2**63 - 1, 2**48 * 2**28 + 256 * 256))]
    assert run(spark, []) == []


def test_repeated_ids_are_rows_of_their_own(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i % 60, [float(F32(rng.gauss(0, 1))) for _ in range(4)]) for i in range(150)]
    rows += [rows[0], rows[0], rows[50]]
    assert run(spark, rows) == plain(rows) and sum(q == 0 for q, *_ in run(spark, rows)) == 25
    spark.createDataFrame(rows, "vec_id long, embedding array<float>").coalesce(1).write.parquet(f"file://{tmp_path}/embeddings.parquet")
    con = __import__("duckdb").connect()
    con.sql(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{tmp_path}/embeddings.parquet/*.parquet')")
    assert sorted(con.sql(ORACLE_SQL["op4_topk"]).fetchall()) == sorted(tuple(r) for r in QUERIES["op4_topk"](spark, f"file://{tmp_path}").collect()) == plain(rows)
