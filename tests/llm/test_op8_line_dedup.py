import re
from collections import Counter, defaultdict

from quern.llm.line_dedup import drop_boilerplate
from quern.llm.queries import ORACLE_SQL, QUERIES
from tests.compare import SMALL, of_spark, oracle


def plain(rows, ratio, least):
    pages, holds = Counter(), defaultdict(Counter)
    for host, text in rows:
        pages[host] += 1
        holds[host].update(set((text or "").split("\n")))
    out = []
    for host, text in rows:
        lines = text.split("\n") if text else []
        kept = [x for x in lines if not x.strip(" ") or not (holds[host][x] >= least and holds[host][x] > pages[host] * ratio)]
        out.append((host, "\n".join(kept) if lines else text, len(lines), len(lines) - len(kept)))
    return out


def run(spark, rows, **options):
    df = spark.createDataFrame([(h, t, 1, "x") for h, t in rows], "source string, text string, n_lines int, __q_key string")
    out = drop_boilerplate(df, **options)
    assert out.columns == ["source", "text", "__q_key", "n_lines", "n_removed"]
    return sorted(((r.source, r.text, r.n_lines, r.n_removed) for r in out.collect()), key=str)


def test_equals_sql(spark):
    assert of_spark(QUERIES["op8_line_dedup"](spark, SMALL)) == oracle(ORACLE_SQL["op8_line_dedup"])


def test_against_a_loop(spark):
    rows = [("a", f"head\nbody {i}\n\nfoot\nfoot") for i in range(8)] + [("a", "head"), ("a", ""), ("a", None), ("a", "\n\n \n")]
    rows += [("b", f"head\nown {i}") for i in range(2)] + [(None, "x\ny"), (None, "x"), (None, "x\nz"), (None, "w")] + [("c", "only\n" + "z" * 100_000)] * 3
    for ratio, least in ((0.1, 3), (0.7, 2), (0.99, 1)):
        for hosts in (2_000, 0):
            assert run(spark, rows, ratio=ratio, min_pages=least, broadcast_hosts=hosts) == sorted(plain(rows, ratio, least), key=str)


def test_empty_and_native(spark):
    assert run(spark, []) == []
    df = spark.createDataFrame([("a", "x")], "source string, text string")
    assert not re.search("Python|Pandas|Arrow", drop_boilerplate(df)._jdf.queryExecution().executedPlan().toString())
