"""The pipeline's stages against brute force, each on its own input."""

import collections

import corpus_pipeline

from .plainwords import WORD
from .test_op3_jaccard import plain as groups
from .test_op8_line_dedup import plain as boilerplate
from .test_op9_mixing import targets

SF = "/root/testdata/sf0.01"


def test_stages(spark, tmp_path):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    columns, kept = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, SF).write.parquet(f"file://{tmp_path}/{name}")
        out = spark.read.parquet(f"file://{tmp_path}/{name}")
        kept[name] = (docs.collect(), out.collect())
        assert out.columns == columns + ["times"] * (name == "mixing")
        docs = out
    before, after = kept["quality"]
    toxic = {r.doc_id: r for r in spark.read.parquet(f"{SF}/labels.parquet").collect()}
    good = [i for i, r in toxic.items() if r.quality == 1 and r.toxic == 0]
    left = {r.doc_id for r in after}
    assert sum(i in left for i in good) >= 0.98 * len(good)
    assert sum(i in left for i, r in toxic.items() if r.toxic == 1) <= 0.1 * sum(r.toxic for r in toxic.values())

    before, after = kept["line_dedup"]
    want = collections.Counter((s, t) for s, t, _, _ in boilerplate([(r.source, r.text) for r in before], 0.1, 3))
    assert collections.Counter((r.source, r.text) for r in after) == want and all(r.n_chars == len(r.text) for r in after)

    before, after = kept["near_duplicates"]
    rows = [(r.doc_id, r.text) for r in before if WORD.search(r.text.lower())]
    root = dict.fromkeys(r.doc_id for r in before)
    root.update({i: c for i, c, _ in fast_groups(rows)})
    assert {r.doc_id for r in after} == {i for i, c in root.items() if c in (None, i)}

    before, after = kept["decontamination"]
    items = [f" {' '.join(WORD.findall(r.text.lower()))} " for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    clean = {r.doc_id for r in before if not any(x in f" {' '.join(WORD.findall(r.text.lower()))} " for x in items)}
    left = {r.doc_id for r in after}
    assert left <= clean and len(clean - left) <= 3  # near ones go as well

    before, after = kept["mixing"]
    sizes = collections.Counter()
    for r in before:
        sizes[r.source] += len(r.text.split())
    taken = collections.Counter()
    for r in after:
        taken[r.source] += r.times * len(r.text.split())
    for s, t in targets(sizes).items():
        assert abs(taken[s] - t) <= max(30, 0.02 * t)


def fast_groups(rows):
    """As `plain` of the Jaccard tests, with only pairs that share a shingle compared."""
    by = collections.defaultdict(list)
    for i, (_, t) in enumerate(rows):
        w = WORD.findall(t.lower())
        for s in {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}:
            by[s].append(i)
    near = collections.defaultdict(set)
    for own in by.values():
        for i in own[1:]:
            near[own[0]].add(i)
    root = list(range(len(rows)))

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, others in near.items():
        for j in others:
            a, b = sorted((top(i), top(j)))
            root[b] = a
    families = collections.defaultdict(list)
    for i in range(len(rows)):
        families[top(i)].append(rows[i])
    return [x for own in families.values() for x in groups(own)]


def test_empty_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, docs, SF).count() == 0


def test_nulls_long_texts_repeats_and_clashing_columns(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet").limit(60)
    columns, types = docs.columns, dict(docs.dtypes)
    odd = [{"doc_id": 10**6, "text": None}, {"doc_id": None, "text": "some words. " * 30}, {"doc_id": 10**6 + 1, "text": "long words here. " * 60_000, "source": None}, {"doc_id": 10**6 + 2, "text": ""}]
    schema = ", ".join(f"{c} {types[c]}" for c in columns)
    rows = spark.createDataFrame([tuple(r.get(c) for c in columns) for r in odd * 2], schema)
    wide = docs.unionByName(rows).selectExpr("*", "1 AS leaks", "2 AS p_best", "3 AS n_lines", "4 AS times", "5 AS class_id", "6 AS __q_key")
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, wide, SF)
        got = out.collect()
        assert out.columns == (wide.columns if name != "mixing" else [*[c for c in wide.columns if c != "times"], "times"])
        assert 0 < len(got) <= wide.count() and (name != "line_dedup" or len(got) == wide.count())
        if name == "near_duplicates":  # rows that repeat an id stay together, texts without words and null ids are left alone
            assert sum(r.doc_id is None for r in got) == 2 and sum(r.text in (None, "") for r in got) >= 4
