"""One query for each corpus operator, over its whole table, and DuckDB SQL where SQL can express it."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.tables import spread
from .decontaminate import mark_leaks
from .exact_substrings import remove_repeats
from .jaccard import jaccard_groups
from .language import fuse, page_evidence, train_text
from .line_dedup import drop_boilerplate
from .mixing import mix_to_targets
from .pii import replace_pii
from .quality import label_grade, select_quality
from .secrets import find_secrets, spans_digest
from .topk import exact_top_k


def _read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spread(spark.read.parquet(f"{sf_dir}/{table}.parquet"))


def op1_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Languages of all documents (host: their source) and of all pages, which fill doc_id and page_id respectively."""
    docs = _read(spark, sf_dir, "documents")
    none = F.lit(None).cast("string")
    texts = docs.select("doc_id", F.lit(None).cast("long").alias("page_id"), "text", none.alias("declared"), none.alias("suffix"), F.col("source").alias("host"), none.alias("domain"))
    pages = page_evidence(_read(spark, sf_dir, "pages")).withColumn("doc_id", F.lit(None).cast("long"))
    return fuse(texts.unionByName(pages), train_text(docs), ["doc_id", "page_id"])


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spans_digest(find_secrets(_read(spark, sf_dir, "documents")))


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_groups(_read(spark, sf_dir, "documents"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_top_k(_read(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = select_quality(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"), label_grade())
    return found.select("doc_id", "expected_grade", "p_best")


def op6_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    marked = mark_leaks(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"))
    return marked.select("doc_id", F.inline("leaks"))


def op7_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replace_pii(_read(spark, sf_dir, "documents"), "quern").select("doc_id", "text", "n_replaced")


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line goes if more than 10 % of its source's documents hold it, and at least 3 of them."""
    return drop_boilerplate(_read(spark, sf_dir, "documents"), ratio=0.1, min_pages=3).select("doc_id", "source", "text", "n_lines", "n_removed")


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mix_to_targets(_read(spark, sf_dir, "documents"))


def op10_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_bytes", "n_removed", F.size("spans").cast("long").alias("n_spans"), "kept_sha256")


QUERIES = {f.__name__: f for f in (op1_language, op2_secrets, op3_jaccard, op4_topk, op5_quality, op6_decontaminate, op7_pii, op8_line_dedup, op9_mixing, op10_suffix_dedup)}

OP4_SQL = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id AS id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), s AS (
  SELECT q.rid, q.id AS query_id, c.id AS vec_id,
         CAST(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) AS BIGINT) AS score
  FROM v q JOIN v c ON q.id % 50 = 0 AND c.rid <> q.rid AND len(q.v) = len(c.v)
), r AS (
  SELECT *, CAST(row_number() OVER (PARTITION BY rid ORDER BY score DESC, vec_id) AS INTEGER) AS rank FROM s
)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 5
"""

OP8_SQL = """
WITH t AS (SELECT row_number() OVER () AS rid, * FROM documents),
l AS (SELECT rid, source, unnest(string_split(text, chr(10))) AS line,
             unnest(range(len(string_split(text, chr(10))))) AS i FROM t WHERE text <> ''),
total AS (SELECT source, count(*) AS n FROM t GROUP BY source),
often AS (
  SELECT l.source, l.line FROM l JOIN total ON l.source IS NOT DISTINCT FROM total.source
  WHERE trim(l.line) <> '' GROUP BY l.source, l.line, total.n
  HAVING count(DISTINCT l.rid) >= 3 AND count(DISTINCT l.rid) > total.n * 0.1::DOUBLE
),
m AS (SELECT l.*, often.line IS NOT NULL AS gone FROM l LEFT JOIN often ON l.source IS NOT DISTINCT FROM often.source AND l.line = often.line),
d AS (SELECT rid, count(*) AS n_lines, count_if(gone) AS n_removed,
             coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text FROM m GROUP BY rid)
SELECT t.doc_id, t.source, coalesce(d.text, t.text) AS text,
       CAST(coalesce(d.n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(d.n_removed, 0) AS BIGINT) AS n_removed
FROM t LEFT JOIN d ON t.rid = d.rid
"""

#: Every 50-byte window, the smallest id that holds it, and the runs that windows of larger ids cover.
OP10_SQL = """
WITH t AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS x FROM documents),
w AS (SELECT rid, doc_id, p, array_slice(x, p + 1, p + 50) AS s FROM t, unnest(range(CAST(greatest(octet_length(x) - 49, 0) AS BIGINT))) u(p) WHERE doc_id IS NOT NULL),
f AS (SELECT s, min(doc_id) AS least FROM w GROUP BY s HAVING min(doc_id) < max(doc_id)),
gone AS (SELECT w.rid, w.p FROM w JOIN f ON w.s = f.s WHERE f.least < w.doc_id),
n AS (SELECT rid, p, CASE WHEN p <= lag(p) OVER (PARTITION BY rid ORDER BY p) + 50 THEN 0 ELSE 1 END AS fresh FROM gone),
i AS (SELECT rid, p, sum(fresh) OVER (PARTITION BY rid ORDER BY p ROWS UNBOUNDED PRECEDING) AS run FROM n),
r AS (SELECT rid, run, min(p) AS a, max(p) + 50 AS b FROM i GROUP BY rid, run),
k AS (SELECT t.rid, r.a, r.b, coalesce(lag(r.b) OVER (PARTITION BY t.rid ORDER BY r.a), 0) AS before, t.x FROM t JOIN r ON t.rid = r.rid),
c AS (SELECT rid, count(*) AS n_spans, sum(b - a) AS n_removed, max(b) AS last, string_agg(CASE WHEN a > before THEN hex(array_slice(x, before + 1, a)) ELSE '' END, '' ORDER BY a) AS kept FROM k GROUP BY rid)
SELECT t.doc_id, CAST(octet_length(x) AS BIGINT) AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, CAST(coalesce(n_spans, 0) AS BIGINT) AS n_spans,
       sha256(CASE WHEN c.rid IS NULL THEN x ELSE unhex(kept || CASE WHEN last < octet_length(x) THEN hex(array_slice(x, last + 1, octet_length(x))) ELSE '' END) END) AS kept_sha256
FROM t LEFT JOIN c ON t.rid = c.rid
"""

ORACLE_SQL = {"op10_suffix_dedup": OP10_SQL, "op4_topk": OP4_SQL, "op8_line_dedup": OP8_SQL}
