import itertools
import random

import numpy as np
import pytest

from quern.llm.components import components
from quern.llm.jaccard import forest_depth, jaccard_groups, keep_one, trees_for
from quern.llm.queries import op3_jaccard
from tests.compare import SMALL

from .plainwords import WORD


def shingle_set(text):
    w = WORD.findall((text or "").lower())
    return frozenset(tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))) if w else frozenset()


def plain(rows):
    """{position: (class, links)} by comparing all pairs."""
    sets = [shingle_set(t) for _, t in rows]
    root, links = list(range(len(rows))), [0] * len(rows)

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, j in itertools.combinations(range(len(rows)), 2):
        k = len(sets[i] & sets[j])
        if sets[i] and sets[j] and rows[i][0] is not None and rows[j][0] is not None and 10 * k >= 8 * (len(sets[i]) + len(sets[j]) - k):
            links[i] += 1
            links[j] += 1
            a, b = sorted((top(i), top(j)), key=lambda x: rows[x][0])
            root[b] = a
    return [(rows[i][0], rows[top(i)][0], links[i]) for i in range(len(rows))]


def variants(rng, n):
    words = [f"w{rng.randrange(400)}" for _ in range(60)]
    for _ in range(n):
        w = list(words)
        for _ in range(rng.randrange(4)):
            w[rng.randrange(len(w))] = f"v{rng.randrange(1000)}"
        yield " ".join(w)


@pytest.mark.parametrize("block,leaf", [(64_000, 64), (150, 64), (64_000, 8), (150, 2)])
def test_against_all_pairs(spark, block, leaf):
    rng = random.Random(3)
    texts = [t for n in (1, 2, 3, 25, 40) for t in variants(rng, n)] + ["a b c", "A b, c!", "a b c d", "", None, "...", "one"] * 2
    rows = list(enumerate(texts))
    df = spark.createDataFrame([(i, t, 0, "x") for i, t in rows], "doc_id long, text string, class_id int, prefix string").repartition(5)
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard_groups(df, block_shingles=block, leaf=leaf, block_rows=16).collect())
    assert got == sorted(plain(rows))
    kept = {r.doc_id for r in keep_one(df).collect()}
    assert kept == {i for i, c, _ in got if i == c} and keep_one(df).columns == df.columns


def test_query_on_all_rows(spark):
    rows = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in op3_jaccard(spark, SMALL).collect())
    assert got == sorted(plain(rows))


def test_pages_of_one_template_and_a_dense_family(spark):
    """Unlike pages that share half their words fill nodes without being links; a dense family is one."""
    rng = random.Random(6)
    template = [f"t{i}" for i in range(60)]
    rows = [(i, " ".join(template + [f"p{i}_{j}" for j in range(rng.randrange(30, 50))])) for i in range(150)]
    rows += [(1000 + i, t) for i, t in enumerate(variants(rng, 120))]
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), leaf=16).collect())
    assert got == sorted(plain(rows)) and all(c == i and not k for i, c, k in got if i < 1000)


def test_scripts_without_spaces_and_very_long_texts(spark):
    rng = random.Random(8)
    han = "".join(chr(rng.randrange(0x4E00, 0x5E00)) for _ in range(200))
    long = " ".join(f"w{rng.randrange(10**6)}" for _ in range(150_000))
    rows = [(1, han), (2, han[:190] + "新" + han[191:]), (3, han[::-1]), (4, long), (5, long + " more"), (6, long[: len(long) // 2])]
    got = sorted((r.doc_id, r.class_id, r.n_links) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == [(1, 1, 1), (2, 1, 1), (3, 3, 0), (4, 4, 1), (5, 4, 1), (6, 6, 0)] == sorted(plain(rows))


def test_one_id_on_different_texts(spark):
    a, b = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    rows = [(1, a), (1, b), (2, a + " z"), (3, b + " z"), (4, b + " z y")]
    got = sorted((r.doc_id, r.n_links) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string")).collect())
    assert got == sorted((i, k) for i, _, k in plain(rows)) == [(1, 1), (1, 2), (2, 1), (3, 2), (4, 2)]


def test_repeated_and_null_ids_and_empty_tables(spark):
    t = "one two three four five six seven"
    df = spark.createDataFrame([(1, t), (1, t), (None, t), (2, t + " eight")], "doc_id long, text string")
    got = sorted(((r.doc_id, r.class_id, r.text_id, r.n_links) for r in jaccard_groups(df, similarity=0.7).collect()), key=str)
    assert got == sorted([(1, 1, 1, 2), (1, 1, 1, 2), (2, 1, 2, 2), (None, None, None, 0)], key=str)
    assert jaccard_groups(df.limit(0)).count() == 0


def test_depth_meets_the_recall():
    for trees, recall in ((8, 0.9), (32, 0.9999), (64, 0.99)):
        d = forest_depth(trees, 16, 0.8, recall)
        assert 1 - (1 - 0.8**d) ** trees >= recall or d == 1
        assert d == 16 or 1 - (1 - 0.8 ** (d + 1)) ** trees < recall
        more = trees_for(12, 0.8, recall)
        assert 1 - (1 - 0.8**12) ** more >= recall > 1 - (1 - 0.8**12) ** (more - 1)


def test_components(spark):
    rng = np.random.default_rng(0)
    edges = [(int(a), int(b)) for a, b in rng.integers(0, 60, size=(40, 2))] + [(i, i + 1) for i in range(100, 160)] + [(200, 200 + i) for i in range(1, 50)]
    root = {}

    def top(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            a, b = sorted((top(a), top(b)))
            root[b] = a
    got = {r.node: r.root for r in components(spark.createDataFrame(edges, "u long, v long")).collect()}
    assert got == {x: top(x) for x in root}
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0


@pytest.mark.parametrize("ids", [range(1000), range(1000, 0, -1), [(i * 7919) % 1009 for i in range(1000)]])
def test_rounds_grow_with_the_logarithm(spark, ids):
    ids, counts = list(ids), []
    got = components(spark.createDataFrame(list(zip(ids, ids[1:])), "u long, v long"), counts).collect()
    assert {r.root for r in got} == {min(ids)} and len(got) == 1000 and len(counts) <= 20
