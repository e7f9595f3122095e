import hashlib
import random

import numpy as np
import pytest

from quern.llm.exact_substrings import GRAM, remove_repeats
from quern.llm.queries import ORACLE_SQL, op10_suffix_dedup
from quern.llm.suffixes import permuted_common_prefixes, suffix_array
from tests.compare import SMALL, of_spark, oracle


def test_suffix_arrays():
    rng = np.random.default_rng(0)
    for _ in range(200):
        s = np.concatenate([rng.integers(1, int(rng.integers(2, 6)), size=int(rng.integers(1, 70))), [0]])
        sa = suffix_array(s, 6)
        assert sa.tolist() == sorted(range(len(s)), key=lambda i: s[i:].tolist())
        common = permuted_common_prefixes(np.concatenate([s, np.arange(-80, 0)]), sa, 9)
        for a, b, n in zip(sa[:-1], sa[1:], common):
            k = 0
            while k < 9 and max(a, b) + k < len(s) and s[a + k] == s[b + k]:
                k += 1
            assert n == k


def plain(rows, length=50):
    first = {}
    data = [(i, (t or "").encode()) for i, t in rows]
    for i, x in data:
        if i is not None:
            for p in range(len(x) - length + 1):
                w = x[p : p + length]
                first[w] = min(first.get(w, i), i)
    out = []
    for i, x in data:
        gone = bytearray(len(x))
        if i is not None:
            for p in range(len(x) - length + 1):
                if first[x[p : p + length]] < i:
                    gone[p : p + length] = b"\x01" * length
        runs = sum(1 for k in range(len(x)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(x), sum(gone), runs, hashlib.sha256(bytes(b for b, g in zip(x, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows, **options):
    df = spark.createDataFrame([(i, t, 1) for i, t in rows], "doc_id long, text string, chunk int").repartition(3)
    return sorted(((r.doc_id, r.n_bytes, r.n_removed, len(r.spans), r.kept_sha256) for r in remove_repeats(df, **options).collect()), key=str)


def test_against_brute_force(spark):
    rng = random.Random(1)
    passages = ["".join(rng.choice("abcé \n") for _ in range(rng.randrange(30, 130))) for _ in range(12)]
    texts = ["".join(rng.choice(passages)[rng.randrange(8) :] if rng.random() < 0.6 else "".join(rng.choice("xyzü") for _ in range(rng.randrange(60))) for _ in range(rng.randrange(9))) for _ in range(60)]
    texts += ["a" * 49, "a" * 50, "a" * 51, "a" * 500, "ab" * 200, "ba" * 100, None, "", "z" * 50, passages[0] * 40] * 2
    rows = [(i // 2 if i % 9 == 0 else i, t) for i, t in enumerate(texts)] + [(None, passages[1] * 2), (None, None)]
    for options in ({}, {"chunk_bytes": 300, "shard_bytes": 500}):
        assert run(spark, rows, **options) == plain(rows)


def test_query_on_all_rows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in op10_suffix_dedup(spark, SMALL).collect()), key=str)
    assert got == plain(rows)


def test_long_text_and_empty_table(spark):
    rng = random.Random(2)
    long = "".join(rng.choice("abcdefgh") for _ in range(200_000))
    rows = [(1, long), (2, "q" * 10 + long[70_000:130_000] + "r"), (3, long[-49:])]
    assert run(spark, rows) == plain(rows)
    assert run(spark, []) == []


def test_long_suffix_arrays():
    rng = np.random.default_rng(4)
    for n, sigma in ((20_000, 3), (30_000, 200), (5_000, 2)):
        own = rng.integers(1, sigma, size=n)
        s = np.concatenate([own, own[: n // 2], own[n // 3 :], [0]])
        sa = suffix_array(s, sigma)
        rank = np.zeros(len(s), dtype=np.int64)
        rank[sa] = np.arange(len(s))
        assert sorted(sa.tolist()) == list(range(len(s)))
        a, b = sa[:-1], sa[1:]  # each suffix is below the next: by first symbol, then by the order of what follows
        assert ((s[a] < s[b]) | ((s[a] == s[b]) & (rank[np.minimum(a + 1, len(s) - 1)] < rank[np.minimum(b + 1, len(s) - 1)]))).all()
    s = np.concatenate([np.tile([1, 2], 4_000), np.full(3_000, 1), [0]])
    assert suffix_array(s, 3).tolist() == sorted(range(len(s)), key=lambda i: bytes(s[i:].tolist()))


def test_equals_sql(spark):
    assert of_spark(op10_suffix_dedup(spark, SMALL)) == oracle(ORACLE_SQL["op10_suffix_dedup"])


def test_tables_on_the_way_are_deleted(spark):
    docs = spark.createDataFrame([(1, "x" * 80), (2, "x" * 90)], "doc_id long, text string")
    before = {t.name for t in spark.catalog.listTables()}
    assert remove_repeats(docs).count() == 2 and {t.name for t in spark.catalog.listTables()} == before


def test_length_below_an_anchor(spark):
    docs = spark.createDataFrame([(1, "a")], "doc_id long, text string")
    with pytest.raises(ValueError, match="length"):
        remove_repeats(docs, length=GRAM - 1)
