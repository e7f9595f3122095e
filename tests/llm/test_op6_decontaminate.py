import random

import numpy as np

from quern.llm.decontaminate import best_match, item_class, mark_leaks

from .plainwords import WORD


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(new[-1] + 1, row[j + 1] + 1, row[j] + (x != y)))
        row = new
    return row[-1]


def best_by_force(item, text):
    return min(edit_distance(item, text[a:b]) for a in range(len(text) + 1) for b in range(a, len(text) + 1))


def test_best_match_is_the_least():
    rng = np.random.default_rng(1)
    for _ in range(60):
        item, text = (rng.integers(0, 4, size=n).astype(np.uint64) for n in (rng.integers(1, 7), rng.integers(1, 12)))
        edits, a, b = best_match(item, text)
        assert edits == best_by_force(item.tolist(), text.tolist()) == edit_distance(item.tolist(), text[a:b].tolist())


def test_least_grams_is_a_bound():
    for n in range(1, 80):
        c = item_class(n, 0.2)
        assert c.edits == int(0.2 * n) and (c.least == n - c.q + 1 - c.edits * c.q or c.q == 1) and c.least >= 1


def edited(rng, words, k):
    w = list(words)
    for _ in range(k):
        kind, i = rng.randrange(3), rng.randrange(len(w))
        w[i : i + (kind != 0)] = [] if kind == 1 else [f"n{rng.randrange(10**6)}"]
    return w


def test_recall_and_no_false_alarm(spark):
    rng = random.Random(4)
    vocabulary = [f"word{i}" for i in range(300)]
    items = [(i, " ".join(rng.choice(vocabulary) for _ in range(rng.randrange(3, 60)))) for i in range(40)]
    rows, planted = [], set()
    for d in range(240):
        filler = [rng.choice(vocabulary) for _ in range(rng.randrange(200))]
        if d % 2:
            item, text = items[rng.randrange(len(items))]
            own = text.split()
            at = rng.randrange(len(filler) + 1)
            filler[at:at] = edited(rng, own, rng.randrange(int(0.2 * len(own)) + 1))
            planted.add((d, item))
        rows.append((d, " ".join(filler)))
    got = [(r.doc_id, x) for r in mark_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")).collect() for x in r.leaks]
    found = {(d, x.item_id) for d, x in got}
    assert len(planted - found) <= 0.03 * len(planted)
    by_item = {i: t.lower().split() for i, t in items}
    texts = dict(rows)
    for d, x in got:  # every leak is one, exactly, where it says
        span = [m[0] for m in WORD.finditer(texts[d][x.start_char : x.end_char].lower())]
        assert len(span) == x.n_words and edit_distance(by_item[x.item_id], span) == x.edits <= int(0.2 * len(by_item[x.item_id]))
    for d, t in rows:  # exact ones are never missed
        for i, w in by_item.items():
            assert f" {' '.join(w)} " not in f" {t} " or (d, i) in found


def test_edges(spark):
    passage = "alpha beta gamma delta epsilon zeta eta theta iota kappa lambda mu"
    docs = spark.createDataFrame([(1, passage.upper() + "!", 7), (1, passage.upper() + "!", 7), (2, None, 7), (3, "", 7), (None, "x " * 50_000 + passage, 7), (4, "alpha beta", 7)], "doc_id long, text string, leaks int")
    items = spark.createDataFrame([(1, passage), (2, passage), (3, None), (4, ""), (5, "..."), (None, passage)], "item_id long, text string")
    got = {(r.doc_id, tuple(x.item_id for x in r.leaks)) for r in mark_leaks(docs, items).collect()}
    assert got == {(1, (1, 2)), (2, ()), (3, ()), (None, (1, 2)), (4, ())}
    assert mark_leaks(docs, items).count() == 6 and mark_leaks(docs, items, item_block=1).filter("size(leaks) = 2").count() == 3
    assert mark_leaks(docs.limit(0), items).count() == 0 and mark_leaks(docs, items.limit(0)).filter("size(leaks) > 0").count() == 0


def test_long_items(spark):
    rng = random.Random(8)
    item = [f"w{rng.randrange(500)}" for _ in range(400)]
    rows = [(d, " ".join(["x"] * d + edited(rng, item, 60) + ["y"] * 9)) for d in range(12)]
    got = mark_leaks(spark.createDataFrame(rows, "doc_id long, text string"), spark.createDataFrame([(1, " ".join(item))], "item_id long, text string"))
    assert got.filter("size(leaks) = 1").count() >= 11
