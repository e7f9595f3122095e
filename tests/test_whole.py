"""Cases that a cut by bucket, id, prefix or position would lose."""

import itertools
import random

from pyspark.sql import functions as F

from quern.operators import assembly, citations, decontam, dedup
from quern.plans import curation
from tests.compare import of_spark, oracle


def test_all_pairs_of_a_bucket(spark):
    texts = [" ".join(f"w{i}" for i in range(50)) + "".join(f" x{k}_{j}" for j in range(6)) for k in range(12)]
    rows = list(enumerate([*texts, texts[3], texts[3], "", None, texts[0] + " more"]))
    d = spark.createDataFrame(rows, "doc_id long, text string")
    sets = {i: set((t or "").split()) for i, t in rows}
    signed = d.select("doc_id", dedup.signature(F.col("text")).alias("sig")).cache()
    sigs = {r.doc_id: r.sig for r in signed.collect()}
    banded = {(a, b) for a, b in itertools.combinations(sets, 2) if sigs[a] and sigs[b] and any(sigs[a][i : i + 2] == sigs[b][i : i + 2] for i in (0, 2, 4, 6))}
    assert len(banded) > len(sets)
    for block in (1024, 3):
        assert sorted((r.a, r.b) for r in dedup.candidates(signed, block_rows=block).collect()) == sorted(banded)
    near = {(a, b) for a, b in banded if len(sets[a] & sets[b]) >= 0.8 * len(sets[a] | sets[b])}
    assert sorted((r.a, r.b) for r in dedup.near_pairs(d).collect()) == sorted(near)
    gone = {b for _, b in near}
    assert sorted(r.doc_id for r in assembly.without_near_copies(d).collect()) == sorted(set(sets) - gone)


def test_screen_takes_every_protected_vector(spark):
    whole = """SELECT v.vec_id, count(*) AS n_near FROM embeddings v JOIN embeddings p ON p.label = 0 AND p.vec_id <> v.vec_id
        WHERE list_cosine_similarity(v.embedding::DOUBLE[], p.embedding::DOUBLE[]) >= 0.35 GROUP BY v.vec_id"""
    sf = "/root/testdata/sf0.1"
    assert of_spark(curation.embed_screen(spark, sf)) == oracle(whole, sf)
    v = spark.read.parquet(f"{sf}/embeddings.parquet")
    assert of_spark(decontam.similarity_screen(v, v.filter("label = 0"), 0.35, block_rows=100)) == oracle(whole, sf)


def test_citations_spoiled_anywhere(spark):
    rng, work = random.Random(5), "AIR 1978 SC 597 Maneka"
    spoiled = [work[:i] + "#" + work[i + 1 :] for i in range(len(work))] + [work[:i] + work[i + 1 :] for i in range(len(work))] + ["##" + work, "a", "", "xy", "abcd"]
    for _ in range(60):
        t = list(work)
        for _ in range(rng.randrange(1, 4)):
            k = rng.randrange(len(t))
            t[k : k + 1] = rng.choice([[], ["#"], [t[k], "%"]])
        spoiled.append("".join(t))
    works = [work, "abc", "IPC 302"]

    def edits(a, b):
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, last + (x != y))
        return row[-1]

    c = spark.createDataFrame(list(enumerate(spoiled)), "example_id long, citation string")
    got = {r.example_id: r.ok for r in citations.verify(c, spark.createDataFrame([(w,) for w in works], "citation string")).collect()}
    assert got == {i: any(edits(x, w) <= 2 for w in works) for i, x in enumerate(spoiled)}
