"""Relational queries over the star schema: joins, aggregates, windows, sets, functions.

A query is SQL in which {table} stands for a table; where the dialects differ, the DataFrame form is in a function and the
SQL serves as its check only.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


SAME_SQL = {
    "join_inner": """
        SELECT o.o_orderpriority, count(*) AS n_lines, round(sum(l.l_extendedprice * (1 - l.l_discount)), 2) AS revenue
        FROM {orders} o JOIN {lineitem} l ON o.o_orderkey = l.l_orderkey GROUP BY o.o_orderpriority""",
    "join_left": """
        SELECT c.c_custkey, count(o.o_orderkey) AS n_orders FROM {customer} c
        LEFT JOIN {orders} o ON c.c_custkey = o.o_custkey AND o.o_orderstatus = 'F' GROUP BY c.c_custkey""",
    "join_right": """
        SELECT n.n_name, count(s.s_suppkey) AS n_suppliers FROM {supplier} s RIGHT JOIN {nation} n ON s.s_nationkey = n.n_nationkey GROUP BY n.n_name""",
    "join_full": """
        WITH o AS (SELECT o_custkey, count(*) AS n FROM {orders} WHERE o_orderstatus = 'P' GROUP BY o_custkey)
        SELECT c.c_custkey, o.o_custkey, coalesce(o.n, 0) AS n_orders FROM {customer} c FULL OUTER JOIN o ON c.c_custkey = o.o_custkey""",
    "join_cross": "SELECT r.r_name, n.n_name, r.r_regionkey = n.n_regionkey AS inside FROM {region} r CROSS JOIN {nation} n",
    "join_star": """
        SELECT r.r_name, count(*) AS n_lines, round(sum(l.l_extendedprice), 2) AS price
        FROM {lineitem} l JOIN {orders} o ON l.l_orderkey = o.o_orderkey JOIN {customer} c ON o.o_custkey = c.c_custkey
        JOIN {nation} n ON c.c_nationkey = n.n_nationkey JOIN {region} r ON n.n_regionkey = r.r_regionkey
        WHERE l.l_shipdate >= o.o_orderdate GROUP BY r.r_name""",
    "subq_correlated": """
        SELECT o.o_orderkey, o.o_totalprice FROM {orders} o
        WHERE o.o_totalprice > (SELECT 1.5 * avg(i.o_totalprice) FROM {orders} i WHERE i.o_custkey = o.o_custkey)""",
    "subq_in": "SELECT p_partkey, p_name FROM {part} WHERE p_partkey IN (SELECT l_partkey FROM {lineitem} WHERE l_quantity >= 50)",
    "agg_hash": """
        SELECT l_returnflag, l_linestatus, round(sum(l_quantity), 2) AS sum_qty, round(sum(l_extendedprice), 2) AS sum_base_price,
               round(sum(l_extendedprice * (1 - l_discount)), 2) AS sum_disc_price, round(avg(l_discount), 6) AS avg_disc, count(*) AS count_order
        FROM {lineitem} WHERE l_shipdate <= timestamp '1998-09-02 00:00:00' GROUP BY l_returnflag, l_linestatus""",
    "agg_having": "SELECT o_custkey, count(*) AS n FROM {orders} GROUP BY o_custkey HAVING count(*) >= 12",
    "agg_distinct": """
        SELECT o_orderstatus, count(DISTINCT o_custkey) AS n_customers, count(DISTINCT o_orderpriority) AS n_priorities,
               CAST(sum(CASE WHEN o_totalprice > 200000 THEN 1 ELSE 0 END) AS BIGINT) AS n_large FROM {orders} GROUP BY o_orderstatus""",
    "agg_stats": """
        SELECT l_returnflag, round(stddev_samp(l_quantity), 6) AS sd, round(var_pop(l_extendedprice) / 1e6, 4) AS var_price,
               round(corr(l_quantity, l_extendedprice), 6) AS corr_qp, round(median(l_quantity), 6) AS med FROM {lineitem} GROUP BY l_returnflag""",
    "agg_cube": """
        SELECT l_returnflag, l_linestatus, grouping(l_returnflag) AS g_flag, grouping(l_linestatus) AS g_status, count(*) AS n
        FROM {lineitem} GROUP BY CUBE (l_returnflag, l_linestatus)""",
    "agg_rollup": "SELECT lang, source, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars FROM {documents} GROUP BY ROLLUP (lang, source)",
    "agg_gsets": """
        SELECT o_orderstatus, o_orderpriority, count(*) AS n FROM {orders}
        GROUP BY GROUPING SETS ((o_orderstatus), (o_orderpriority), ())""",
    "win_rank": """
        SELECT o_orderkey, rank() OVER w AS rk, dense_rank() OVER w AS drk, ntile(4) OVER w AS quartile,
               round(percent_rank() OVER w, 6) AS prk, round(cume_dist() OVER w, 6) AS cd
        FROM {orders} WINDOW w AS (PARTITION BY o_orderpriority, o_orderstatus ORDER BY o_totalprice, o_orderkey)""",
    "win_offset": """
        SELECT event_id, lag(event_type) OVER w AS prev_type, lead(event_type) OVER w AS next_type, first_value(event_id) OVER w AS first_id
        FROM {events} WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "win_rows": """
        SELECT event_id, round(avg(value) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN 3 PRECEDING AND 1 FOLLOWING), 6) AS moving_avg
        FROM {events}""",
    "win_range": """
        SELECT event_id, count(*) OVER (PARTITION BY user_id ORDER BY ts RANGE BETWEEN INTERVAL '1' DAY PRECEDING AND CURRENT ROW) AS n_day FROM {events}""",
    "topk_group": """
        SELECT o_custkey, o_orderkey, rk FROM (SELECT o_custkey, o_orderkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_totalprice DESC, o_orderkey) AS rk
        FROM {orders}) t WHERE rk <= 2""",
    "topk_global": "SELECT o_orderkey, o_totalprice FROM {orders} ORDER BY o_totalprice DESC, o_orderkey LIMIT 100",
    "set_union": "SELECT n_name AS name FROM {nation} UNION ALL SELECT r_name AS name FROM {region}",
    "set_union_distinct": "SELECT c_nationkey AS k FROM {customer} UNION SELECT s_nationkey AS k FROM {supplier}",
    "set_except_all": "SELECT l_suppkey AS k FROM {lineitem} EXCEPT ALL SELECT s_suppkey AS k FROM {supplier}",
    "set_except": "SELECT c_custkey AS k FROM {customer} EXCEPT SELECT o_custkey AS k FROM {orders} WHERE o_orderstatus = 'P'",
    "set_intersect": "SELECT o_custkey AS k FROM {orders} INTERSECT SELECT c_custkey AS k FROM {customer}",
    "fn_string": """
        SELECT p_partkey, upper(p_name) AS up, substring(p_name, 2, 5) AS sub, lpad(p_brand, 12, '*') AS padded, reverse(p_type) AS rev,
               length(p_name) AS len, replace(p_brand, 'Brand', 'B') AS rep, concat(p_brand, '/', p_type) AS cat FROM {part}""",
    "fn_math": "SELECT c_custkey, abs(c_acctbal) AS a, round(sqrt(abs(c_acctbal)), 6) AS s, CAST(floor(c_acctbal) AS BIGINT) AS f, CAST(sign(c_acctbal) AS INT) AS sg FROM {customer}",
    "fn_case": """
        SELECT p_partkey, CASE WHEN p_size < 10 THEN 'small' WHEN p_size < 30 THEN 'medium' ELSE 'large' END AS size_class,
               coalesce(nullif(p_brand, 'Brand#11'), 'none') AS brand FROM {part}""",
    "rec_cte": "WITH RECURSIVE t(n, f) AS (SELECT 1, CAST(1 AS BIGINT) UNION ALL SELECT n + 1, f * (n + 1) FROM t WHERE n < 15) SELECT n, f FROM t",
}


def join_semi(spark: SparkSession, sf_dir: str) -> DataFrame:
    busy = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    c = table(spark, sf_dir, "customer")
    return c.join(busy, c["c_custkey"] == busy["o_custkey"], "left_semi").select("c_custkey", "c_name")


def join_anti(spark: SparkSession, sf_dir: str) -> DataFrame:
    busy = table(spark, sf_dir, "orders").filter("o_orderstatus = 'P'")
    c = table(spark, sf_dir, "customer")
    return c.join(busy, c["c_custkey"] == busy["o_custkey"], "left_anti").select("c_custkey", "c_name")


def range_join(left: DataFrame, right: DataFrame, x: str, y: str, within: float) -> DataFrame:
    """Pairs with |x - y| <= within: an equi-join on bins of that width, each left row in three, so no nested loop."""
    a = left.withColumn("bin", F.explode(F.array(*[F.floor(F.col(x) / within) + k for k in (-1, 0, 1)])))
    b = right.withColumn("bin", F.floor(F.col(y) / within))
    return a.join(b, "bin").filter(F.abs(F.col(x) - F.col(y)) <= within).drop("bin")


def join_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_acctbal")
    c = table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return range_join(s, c, "s_acctbal", "c_acctbal", 25.0).groupBy("s_suppkey").agg(F.count(F.lit(1)).alias("n_near"))


def asof_join(left: DataFrame, right: DataFrame, by: str, ts: str, value: str, into: str) -> DataFrame:
    """Each left row with the last right value of its key at or before its time: one sort by key and time, no pairs."""
    both = left.withColumn("__side", F.lit(1)).withColumn("__v", F.lit(None).cast(right.schema[value].dataType)).unionByName(
        right.select(by, ts, F.col(value).alias("__v")).withColumn("__side", F.lit(0)), allowMissingColumns=True
    )
    w = Window.partitionBy(by).orderBy(ts, "__side", "__v").rowsBetween(Window.unboundedPreceding, 0)
    return both.withColumn(into, F.last("__v", ignorenulls=True).over(w)).filter("__side = 1").drop("__side", "__v")


def join_asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    signups = e.filter("event_type = 'signup'").groupBy("user_id", "ts").agg(F.max("event_id").alias("signup_id"))
    return asof_join(e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts"), signups, "user_id", "ts", "signup_id", "signup_id").select("event_id", "signup_id")


def agg_approx_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").groupBy("l_returnflag").agg(F.approx_count_distinct("l_partkey", 0.02).alias("approx_parts"), F.count_distinct("l_partkey").alias("parts"))


def agg_pivot(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = table(spark, sf_dir, "orders")
    return o.groupBy("o_orderpriority").pivot("o_orderstatus", ["F", "O", "P"]).agg(F.count(F.lit(1))).na.fill(0).withColumnsRenamed({"F": "n_f", "O": "n_o", "P": "n_p"})


def fn_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.year(d).alias("y"), F.month(d).alias("m"), F.dayofmonth(d).alias("dom"), F.quarter(d).alias("q"), F.dayofweek(d).alias("dow"),
        F.date_format(F.date_trunc("month", d), "yyyy-MM-dd").alias("month_start"), F.datediff(F.lit("1999-01-01").cast("date"), d.cast("date")).alias("days"),
    )


def fn_regex(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("text")
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.regexp_count(t, F.lit("[0-9]+")).cast("long").alias("n_numbers"), F.regexp_extract(t, "([A-Z][a-z]+)", 1).alias("first_title"), F.md5(F.regexp_replace(t, "[aeiou]", "*")).alias("masked")
    )


def fn_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select("event_id", F.get_json_object("props", "$.k").cast("long").alias("k"), F.to_json(F.struct("event_id", "event_type")).alias("as_json"))


def fn_array(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = F.col("embedding")
    return table(spark, sf_dir, "embeddings").select(
        "vec_id", F.size(F.filter(e, lambda x: x > 0)).cast("long").alias("n_positive"), F.round(F.aggregate(e, F.lit(0.0), lambda a, x: a + x.cast("double") * x.cast("double")), 5).alias("norm2"),
        F.size(F.slice(e, 1, 8)).cast("long").alias("n_head"), F.round(F.array_max(e).cast("double"), 5).alias("largest"),
    )


def fn_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = table(spark, sf_dir, "events").groupBy("user_id", "event_type").agg(F.count(F.lit(1)).alias("n")).groupBy("user_id").agg(F.map_from_entries(F.collect_list(F.struct("event_type", "n"))).alias("m"))
    often = F.map_filter("m", lambda k, v: v >= 5)
    return m.select("user_id", F.size("m").cast("long").alias("n_types"), F.size(often).cast("long").alias("n_often"), F.coalesce(F.try_element_at("m", F.lit("purchase")), F.lit(0)).alias("purchases"))


def win_tumble(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events")
    g = e.groupBy(F.window("ts", "1 day"), "event_type").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("value"), 4).alias("total"))
    return g.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "event_type", "n", "total")


def win_slide(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "events").groupBy(F.window("ts", "1 day", "12 hours")).agg(F.count(F.lit(1)).alias("n"))
    return g.select(F.date_format("window.start", "yyyy-MM-dd HH:mm").alias("start"), "n")


def win_session(spark: SparkSession, sf_dir: str) -> DataFrame:
    g = table(spark, sf_dir, "events").groupBy("user_id", F.session_window("ts", "6 hours")).agg(F.count(F.lit(1)).alias("n"))
    return g.select("user_id", F.date_format("session_window.start", "yyyy-MM-dd HH:mm:ss").alias("start"), "n")


def _sql(name: str):
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        text = SAME_SQL[name]
        return spark.sql(text, **{t: table(spark, sf_dir, t) for t in TABLES if "{" + t + "}" in text})

    return query


QUERIES = {name: _sql(name) for name in SAME_SQL} | {
    f.__name__: f
    for f in (join_semi, join_anti, join_range, join_asof, agg_approx_distinct, agg_pivot, fn_date, fn_regex, fn_json, fn_array, fn_map, win_tumble, win_slide, win_session)
}

ORACLE_SQL = {name: text.format(**{t: t for t in TABLES}) for name, text in SAME_SQL.items()} | {
    "join_semi": "SELECT c_custkey, c_name FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')",
    "join_anti": "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderstatus = 'P')",
    "join_range": "SELECT s_suppkey, count(*) AS n_near FROM supplier JOIN customer ON abs(s_acctbal - c_acctbal) <= 25 GROUP BY s_suppkey",
    "join_asof": """
        WITH s AS (SELECT user_id, ts, max(event_id) AS signup_id FROM events WHERE event_type = 'signup' GROUP BY user_id, ts)
        SELECT e.event_id, s.signup_id FROM (SELECT * FROM events WHERE event_type = 'purchase') e
        ASOF LEFT JOIN s ON e.user_id = s.user_id AND e.ts >= s.ts""",
    "agg_pivot": """
        SELECT o_orderpriority, count_if(o_orderstatus = 'F')::BIGINT AS n_f, count_if(o_orderstatus = 'O')::BIGINT AS n_o, count_if(o_orderstatus = 'P')::BIGINT AS n_p
        FROM orders GROUP BY o_orderpriority""",
    "fn_date": """
        SELECT o_orderkey, year(o_orderdate)::INT AS y, month(o_orderdate)::INT AS m, day(o_orderdate)::INT AS dom, quarter(o_orderdate)::INT AS q,
               (dayofweek(o_orderdate) + 1)::INT AS dow, strftime(date_trunc('month', o_orderdate), '%Y-%m-%d') AS month_start,
               datediff('day', o_orderdate::DATE, DATE '1999-01-01')::INT AS days FROM orders""",
    "fn_regex": """
        SELECT doc_id, len(regexp_extract_all(text, '[0-9]+'))::BIGINT AS n_numbers, regexp_extract(text, '([A-Z][a-z]+)', 1) AS first_title,
               md5(regexp_replace(text, '[aeiou]', '*', 'g')) AS masked FROM documents""",
    "fn_json": """
        SELECT event_id, json_extract_string(props, '$.k')::BIGINT AS k, '{"event_id":' || event_id || ',"event_type":"' || event_type || '"}' AS as_json FROM events""",
    "fn_array": """
        SELECT vec_id, len(list_filter(embedding, lambda x: x > 0))::BIGINT AS n_positive,
               round(list_sum(list_transform(embedding, lambda x: x::DOUBLE * x::DOUBLE)), 5) AS norm2, len(embedding[1:8])::BIGINT AS n_head,
               round(list_max(embedding)::DOUBLE, 5) AS largest FROM embeddings""",
    "fn_map": """
        WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY user_id, event_type)
        SELECT user_id, count(*) AS n_types, count_if(n >= 5)::BIGINT AS n_often, coalesce(max(n) FILTER (event_type = 'purchase'), 0) AS purchases FROM c GROUP BY user_id""",
    "win_tumble": """
        SELECT strftime(time_bucket(INTERVAL 1 DAY, ts), '%Y-%m-%d %H:%M') AS start, event_type, count(*) AS n, round(sum(value), 4) AS total FROM events GROUP BY 1, 2""",
    "win_slide": """
        SELECT strftime(s, '%Y-%m-%d %H:%M') AS start, count(*) AS n
        FROM (SELECT unnest([time_bucket(INTERVAL 12 HOUR, ts), time_bucket(INTERVAL 12 HOUR, ts) - INTERVAL 12 HOUR]) AS s FROM events) GROUP BY s""",
    "win_session": """
        WITH g AS (SELECT *, CASE WHEN ts < lag(ts) OVER (PARTITION BY user_id ORDER BY ts) + INTERVAL 6 HOUR THEN 0 ELSE 1 END AS new FROM events),
        s AS (SELECT *, sum(new) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS sid FROM g)
        SELECT user_id, strftime(min(ts), '%Y-%m-%d %H:%M:%S') AS start, count(*) AS n FROM s GROUP BY user_id, sid""",
}
