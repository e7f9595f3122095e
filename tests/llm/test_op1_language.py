"""Fusion against a plain loop, held-out accuracy, and edge cases."""

import math

import pytest
from pyspark.sql import functions as F

from quern.llm.language import DIM, fuse, page_evidence, train_text
from quern.llm.queries import op1_language
from tests.compare import SMALL

ITEMS = "doc_id long, text string, declared string, suffix string, host string, domain string"


@pytest.fixture(scope="module")
def model(spark):
    return train_text(spark.read.parquet(f"{SMALL}/documents.parquet"), max_rows=150)


def test_held_out_accuracy(spark, model):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    none = F.lit(None).cast("string")
    items = docs.select("doc_id", "text", none.alias("declared"), none.alias("suffix"), F.col("source").alias("host"), none.alias("domain"))
    right = fuse(items, model, ["doc_id"]).withColumnRenamed("lang", "found").join(docs.select("doc_id", "lang"), "doc_id").filter("found = lang").count()
    assert right >= 985


def trigram_score(text, row):
    b = text.lower().encode()
    total = 0.0
    for i in range(len(b) - 2):
        h = (b[i] * 0x9E3779B1 + b[i + 1] * 0x85EBCA77 + b[i + 2] * 0xC2B2AE3D) % 2**32 >> 16
        total += float(row[h % DIM])
    return total


def plain(items, model, host_strength=5.0, domain_strength=20.0, smoothing=1.0, most=40.0):
    langs, soft, scores = model.languages, [], []
    for x in items:
        t = x[1] or ""
        n = max(0, len(t.lower().encode()) - 2)
        s = [trigram_score(t, row) * min(n / 3, most) / max(n, 1) for row in model.logs]
        s = [v - max(s) for v in s]
        e = [math.exp(v) for v in s]
        scores.append(s)
        soft.append([v / sum(e) if n else 0.0 for v in e])
    K = range(len(langs))
    total = [sum(s[k] for s in soft) for k in K]
    q = [(t + 1) / (sum(total) + len(langs)) for t in total]

    def likelihood(i):
        sums = {}
        for x, s in zip(items, soft):
            if x[i] is not None:
                sums[x[i]] = [a + b for a, b in zip(sums.get(x[i], [0.0] * len(langs)), s)]
        per = [sum(v[k] for v in sums.values()) + smoothing * len(sums) for k in K]
        return {v: [math.log((c[k] + smoothing) / per[k]) for k in K] for v, c in sums.items()}

    declared, suffix, out = likelihood(2), likelihood(3), {}
    for j, x in enumerate(items):
        prior = q
        for i, strength in ((5, domain_strength), (4, host_strength)):
            if x[i] is not None:
                own = [sum(s[k] for y, s in zip(items, soft) if y[i] == x[i] and (i == 5 or y[5] == x[5])) - soft[j][k] for k in K]
                own = [max(v, 0) for v in own]
                prior = [(own[k] + strength * prior[k]) / (sum(own) + strength) for k in K]
        zero = [0.0] * len(langs)
        lp = [scores[j][k] + math.log(prior[k]) + declared.get(x[2], zero)[k] + suffix.get(x[3], zero)[k] for k in K]
        e = [math.exp(v - max(lp)) for v in lp]
        out[x[0]] = (langs[e.index(max(e))], max(e) / sum(e))
    return out


def test_fusion_against_a_loop(spark, model):
    rows = [
        (1, "the and of", "en", "com", "a.b.com", "b.com"), (2, "la de", "fr", "fr", "c.fr", "c.fr"), (3, None, "fr", "fr", "c.fr", "c.fr"), (4, "", None, None, None, None),
        (5, "der die und einer", None, "de", "d.de", "d.de"), (6, "th", "de", "com", "e.b.com", "b.com"), (7, "x", None, None, None, None), (8, "der die und einer", None, "de", "d.de", "d.de"),
    ]
    got = {r.doc_id: (r.lang, r.confidence, r.text_lang) for r in fuse(spark.createDataFrame(rows, ITEMS), model, ["doc_id"]).collect()}
    want = plain(rows, model)
    assert len(got) == len(rows) and got[4][2] is None
    for k, (lang, p) in want.items():
        assert got[k][0] == lang and got[k][1] == pytest.approx(p, rel=1e-4), k


def test_empty_tables_and_models(spark, model):
    none = spark.createDataFrame([], ITEMS)
    assert fuse(none, model, ["doc_id"]).count() == 0
    docs = spark.createDataFrame([], "doc_id long, text string, lang string")
    empty = train_text(docs)
    assert empty.languages == [] and fuse(spark.createDataFrame([(1, "a", None, None, None, None)], ITEMS), empty, ["doc_id"]).first().lang is None


def test_page_evidence(spark):
    html = '<!DOCTYPE html><HTML class="x" lang=\'FR-ca\'><head><script>var a="<p>no";</script><style>p{}</style></head><body><!-- <b>no</b> -->Bonjour <b>le</b> monde</body></html>'
    rows = [(1, "https://user@www.example.fr:80/a?b", html), (2, "nonsense", None), (3, "http://h.example.org", '<meta http-equiv="Content-Language" content="de">x')]
    got = {r.page_id: r for r in page_evidence(spark.createDataFrame(rows, "page_id long, url string, html string")).collect()}
    assert (got[1].declared, got[1].suffix, got[1].host, got[1].domain) == ("fr", "fr", "www.example.fr", "example.fr")
    assert got[1].text.split() == ["Bonjour", "le", "monde"]
    assert tuple(got[2])[1:] == (None,) * 5 and got[3].declared == "de"


def test_query_covers_both_tables(spark):
    got = op1_language(spark, SMALL)
    assert got.filter("doc_id is not null").count() == 200 and got.filter("page_id is not null").count() == 50


def test_declared_far_into_the_page(spark):
    head = "<html><head><style>" + "p{} " * 3000 + "</style><script>var a='<html lang=\"xx\">';</script>"
    pages = [(1, "http://a.de/", "<!-- <html lang='xx'>" + "x" * 9000 + '--><html lang="de"><body>a'), (2, "http://a.fr/", head + '<meta http-equiv="content-language" content="fr"></head>b'), (3, "http://a.en/", head)]
    got = {r.page_id: r.declared for r in page_evidence(spark.createDataFrame(pages, "page_id long, url string, html string")).collect()}
    assert got == {1: "de", 2: "fr", 3: None}


def test_scores_do_not_depend_on_the_batch(model):
    import numpy as np
    import pyarrow as pa

    from quern.llm.language import text_scores

    texts = ["der die und einer", "x" * 1_500_000, None, "", "ab", "la de " * 300_000, "the and of", "é"]
    sums, n = text_scores(pa.array(texts), model.logs)
    for i, t in enumerate(texts):
        own, own_n = text_scores(pa.array([t], pa.string()), model.logs)
        assert (own[0] == sums[i]).all() and own_n[0] == n[i]
    assert np.isfinite(sums).all()


def test_long_texts_repeats_null_ids_and_other_columns(spark, model):
    rows = [(1, "der die und einer " * 50_000, None, None, "h", None, 5), (None, "la de", None, None, "h", None, 5), (2, None, None, None, "h", None, 5), (2, None, None, None, "h", None, 5)]
    df = spark.createDataFrame(rows, ITEMS + ", scores int")
    one = sorted(map(tuple, fuse(df, model, ["doc_id"]).collect()), key=str)
    two = sorted(map(tuple, fuse(df.repartition(3), model, ["doc_id"]).collect()), key=str)
    assert len(one) == 4 and sum(r[0] is None for r in one) == 1 and [r[0] for r in one].count(2) == 2
    assert [(a[0], a[1], a[3]) for a in one] == [(b[0], b[1], b[3]) for b in two] and all(abs(a[2] - b[2]) < 1e-9 for a, b in zip(one, two))
