"""Streaming, sink and Python-function queries; streams run to their end over the tables' files."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.udfs import Sentences, trimmed_mean, word_entropy
from ..operators import guard
from ..sources.shared import shared_path
from ..sources.tables import write_partitioned
from ..streaming import guards, runs
from .relational import table


def _complete(stream: DataFrame, label: str) -> DataFrame:
    """The final state of an aggregate: every batch replaces the result."""
    spark, path = stream.sparkSession, shared_path(stream.sparkSession, label)
    q = runs.collect_to(stream, lambda df, _: df.write.mode("overwrite").parquet(path), shared_path(spark, "checkpoint"), "complete")
    if not runs.with_limit(q, 600):
        raise TimeoutError(label)
    return spark.read.parquet(path)


def _appended(stream: DataFrame, label: str) -> DataFrame:
    spark, path = stream.sparkSession, shared_path(stream.sparkSession, label)
    schema = stream.schema
    runs.run_to_end(stream, path, shared_path(spark, "checkpoint"))
    return spark.read.schema(schema).parquet(path)


def stream_tumbling(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _complete(runs.tumbling(runs.stream_table(spark, sf_dir, "events")), "tumbling")
    return out.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n")


def stream_sliding(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _complete(runs.sliding(runs.stream_table(spark, sf_dir, "events")), "sliding")
    return out.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "n")


def stream_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = _complete(runs.sessions(runs.stream_table(spark, sf_dir, "events")), "session")
    return out.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = runs.stream_table(spark, sf_dir, "events")
    return _appended(runs.distinct_events(e.select("user_id", "event_type", "ts"), ["user_id", "event_type"], late="60 days"), "dedup").select("user_id", "event_type")


def stream_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = runs.stream_table(spark, sf_dir, "events")
    a = e.filter("event_type = 'signup'").select("user_id", F.col("event_id").alias("signup_id"), F.col("ts").alias("signup_ts"))
    b = runs.stream_table(spark, sf_dir, "events").filter("event_type = 'purchase'").select("user_id", F.col("event_id").alias("purchase_id"), F.col("ts").alias("purchase_ts"))
    return _appended(runs.interval_join(a, b, "user_id", "signup_ts", "purchase_ts", "1 day", "60 days").select("signup_id", "purchase_id"), "join")


def _logs(e: DataFrame) -> DataFrame:
    value = F.when(F.col("event_type") == "error", "nan").when(F.col("event_type") == "view", "n/a").otherwise(F.col("value").cast("string"))
    return e.select(F.col("user_id").cast("string").alias("run_id"), F.col("event_id").alias("step"), value.alias("grad_norm"))


def stream_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", runs.ROCKS)
    found = _appended(guards.guard_divergence(_logs(runs.stream_table(spark, sf_dir, "events", 1000)), 2, 2, stop=False), "guard")
    return found.filter("streak >= 2").groupBy("run_id").agg(F.min("step").alias("fired_step"))


def batch_guard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return guard.first_streaks(_logs(table(spark, sf_dir, "events")), grace=2, window=2)


def sink_partitioned(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = shared_path(spark, "orders")
    write_partitioned(table(spark, sf_dir, "orders").withColumn("y", F.year("o_orderdate")), path, ["y"])
    return spark.read.parquet(path).filter("y = 1995").select("o_orderkey", F.col("y").cast("int"))


def sink_formats(spark: SparkSession, sf_dir: str) -> DataFrame:
    n, parts = table(spark, sf_dir, "nation"), []
    for fmt in ("json", "csv", "orc", "parquet"):
        path = shared_path(spark, fmt)
        n.write.format(fmt).options(**({"header": "true"} if fmt == "csv" else {})).save(path)
        parts.append(spark.read.schema(n.schema).format(fmt).options(**({"header": "true"} if fmt == "csv" else {})).load(path).withColumn("fmt", F.lit(fmt)))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out.groupBy("fmt").agg(F.count(F.lit(1)).alias("n"), F.sum("n_nationkey").cast("long").alias("keys"), F.max("n_name").alias("last"))


def udf_scalar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "benchmark").select("item_id", F.round(word_entropy("text"), 6).alias("entropy"))


def udf_agg(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").groupBy("c_nationkey").agg(F.round(trimmed_mean("c_acctbal"), 2).alias("mean"))


def udtf(spark: SparkSession, sf_dir: str) -> DataFrame:
    spark.udtf.register("quern_sentences", Sentences)
    return spark.sql("SELECT b.item_id, s.sentence_ix, s.sentence FROM {b} b, LATERAL quern_sentences(b.text) s", b=table(spark, sf_dir, "benchmark"))


def win_hot_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Shares of few large groups: totals are summed before the shuffle and joined, so no task sorts a group."""
    counts = table(spark, sf_dir, "events").groupBy("event_type", "user_id").agg(F.count(F.lit(1)).alias("n"))
    totals = counts.groupBy("event_type").agg(F.sum("n").alias("total"))
    return counts.join(totals, "event_type").select("event_type", "user_id", "n", F.round(F.col("n") / F.col("total"), 6).alias("share"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    f.__name__: f
    for f in (stream_tumbling, stream_sliding, stream_session, stream_dedup, stream_join, stream_guard, batch_guard, sink_partitioned, sink_formats, udf_scalar, udf_agg, udtf, win_hot_keys)
}

_GUARD = """
    WITH s AS (SELECT user_id::VARCHAR AS run_id, event_id AS step, event_type = 'error' AS bad FROM events WHERE event_id > 2 AND event_type <> 'view'),
    i AS (SELECT *, sum((NOT bad)::INT) OVER (PARTITION BY run_id ORDER BY step) AS island FROM s),
    n AS (SELECT run_id, step, row_number() OVER (PARTITION BY run_id, island ORDER BY step) AS streak FROM i WHERE bad)
    SELECT run_id, min(step) AS fired_step FROM n WHERE streak >= 2 GROUP BY run_id"""

ORACLE_SQL = {
    "stream_tumbling": "SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2",
    "stream_sliding": """
        SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, count(*) AS n
        FROM (SELECT unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS s FROM events) GROUP BY s""",
    "stream_session": """
        WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
        s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
        SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, sid""",
    "stream_dedup": "SELECT DISTINCT user_id, event_type FROM events",
    "stream_join": """
        SELECT a.event_id AS signup_id, b.event_id AS purchase_id FROM events a JOIN events b ON a.user_id = b.user_id
        AND a.event_type = 'signup' AND b.event_type = 'purchase' AND b.ts >= a.ts AND b.ts <= a.ts + INTERVAL 1 DAY""",
    "stream_guard": _GUARD,
    "batch_guard": _GUARD,
    "sink_partitioned": "SELECT o_orderkey, 1995 AS y FROM orders WHERE year(o_orderdate) = 1995",
    "sink_formats": "SELECT fmt, count(*) AS n, sum(n_nationkey)::BIGINT AS keys, max(n_name) AS last FROM nation, (VALUES ('json'), ('csv'), ('orc'), ('parquet')) f(fmt) GROUP BY fmt",
    "udf_scalar": """
        WITH w AS (SELECT item_id, unnest(list_filter(regexp_split_to_array(text, '\\s+'), lambda x: x <> '')) AS w FROM benchmark),
        c AS (SELECT item_id, w, count(*) AS c, sum(count(*)) OVER (PARTITION BY item_id) AS t FROM w GROUP BY item_id, w)
        SELECT item_id, round(-sum(c / t * log2(c / t)), 6) + 0 AS entropy FROM c GROUP BY item_id""",
    "udf_agg": """
        WITH q AS (SELECT c_nationkey, quantile_cont(c_acctbal, 0.1) AS lo, quantile_cont(c_acctbal, 0.9) AS hi FROM customer GROUP BY c_nationkey)
        SELECT c.c_nationkey, round(avg(c_acctbal), 2) AS mean FROM customer c JOIN q ON c.c_nationkey = q.c_nationkey AND c_acctbal BETWEEN lo AND hi GROUP BY c.c_nationkey""",
    "udtf": """
        WITH s AS (SELECT item_id, list_filter(list_transform(string_split(text, '.'), lambda x: trim(x, E' \\n\\t\\r')), lambda x: x <> '') AS l FROM benchmark)
        SELECT item_id, CAST(i - 1 AS INT) AS sentence_ix, l[i] AS sentence FROM s, unnest(range(1, len(l) + 1)) t(i)""",
    "win_hot_keys": """
        WITH c AS (SELECT event_type, user_id, count(*) AS n FROM events GROUP BY event_type, user_id)
        SELECT event_type, user_id, n, round(n / sum(n) OVER (PARTITION BY event_type), 6) AS share FROM c""",
}
