"""Line de-duplication by site-relative frequency, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import P, checked_broadcast, key_of, settle


def _mark(line: Column) -> Column:
    """128 bits of a line: two hashes with different seeds."""
    return F.struct(F.xxhash64(line).alias("a"), F.xxhash64(F.lit(1), line).alias("b"))


def boilerplate_lines(docs: DataFrame, ratio: float, min_pages: int, text_col: str, host_col: str) -> DataFrame:
    """One row per host with boilerplate: key, its marks as an array. Settled; at most (lines per page / ratio) marks a host."""
    lines = F.array_distinct(F.transform(F.filter(F.split(F.col(text_col), "\n"), lambda x: F.trim(x) != ""), _mark))
    pages = docs.select(key_of(F.col(host_col)).alias("key"), lines.alias("marks"))
    totals = docs.groupBy(key_of(F.col(host_col)).alias("key")).agg(F.count(F.lit(1)).alias("total"))
    counts = pages.select("key", F.explode("marks").alias("m")).groupBy("key", "m").agg(F.count(F.lit(1)).alias("pages")).filter(F.col("pages") >= min_pages)
    often = counts.join(totals, "key").filter(F.col("pages") > F.col("total") * ratio)
    return settle(often.groupBy("key").agg(F.collect_set("m").alias("marks")), "lines")


def _without(lines: Column, hit: Column) -> Column:
    """lines whose mark is not in hit, blank ones always kept.

    Marks are dealt into some sqrt(n) parts, so that a line is compared with one part only, however many marks there are.
    """
    n = F.greatest(F.ceil(F.sqrt(F.size(hit))).cast("long"), F.lit(1).cast("long"))

    def kept(parts: Column) -> Column:
        def one(line: Column) -> Column:
            m = _mark(line)
            return (F.trim(line) == "") | ~F.array_contains(F.element_at(parts, (F.pmod(m["a"], F.size(parts)) + 1).cast("int")), m)

        return F.filter(lines, one)

    parts = F.transform(F.sequence(F.lit(0).cast("long"), n - 1), lambda k: F.filter(hit, lambda m: F.pmod(m["a"], n) == k))
    return F.element_at(F.transform(F.array(parts), kept), 1)


def drop_boilerplate(
    docs: DataFrame, ratio: float = 0.1, min_pages: int = 3, broadcast_hosts: int = 2_000, text_col: str = "text", host_col: str = "source"
) -> DataFrame:
    """docs with text_col freed of the lines that more than `ratio` of their host's pages hold, and at least min_pages pages.

    Adds n_lines and n_removed (long). A page counts once for a line however often it holds it; every occurrence of a
    boilerplate line goes. Lines are the pieces between line feeds and are compared exactly; blank lines always stay. The
    floor min_pages is part of the contract: on a host of one or two pages every line is on many of its pages, by number alone,
    and with a floor of 1 such pages would lose all they have.

    Counting shuffles 128-bit marks of each page's distinct lines, summed before the shuffle, never text. Pages meet their
    host's few marks in a broadcast join while at most broadcast_hosts hosts have boilerplate, in a shuffled one beyond that.

    Null text stays null with 0 lines; empty text has 0 lines; null hosts form a host; all columns and repeated rows stay;
    an empty table gives no rows.
    """
    marks = boilerplate_lines(docs, ratio, min_pages, text_col, host_col).withColumnsRenamed({"key": P + "key", "marks": P + "marks"})
    text = F.col(text_col)
    lines = F.split(text, "\n")
    hit = F.array_intersect(F.transform(F.filter(lines, lambda x: F.trim(x) != ""), _mark), F.col(P + "marks"))
    wide = docs.withColumn(P + "key", key_of(F.col(host_col))).join(checked_broadcast(marks, broadcast_hosts), P + "key", "left").withColumn(P + "hit", hit)
    some = F.coalesce(F.size(P + "hit"), F.lit(0)) > 0
    kept = _without(lines, F.col(P + "hit"))
    n_lines = F.when(text.isNull() | (text == ""), F.lit(0)).otherwise(F.size(lines)).cast("long")
    n_removed = F.when(some, F.size(lines) - F.size(kept)).otherwise(F.lit(0)).cast("long")
    wide = wide.withColumns({P + "n": n_lines, P + "r": n_removed, P + "t": F.when(some, F.array_join(kept, "\n")).otherwise(text)})
    own = [F.col(P + "t").alias(text_col) if c == text_col else F.col(c) for c in docs.columns if c not in ("n_lines", "n_removed")]
    return wide.select(*own, F.col(P + "n").alias("n_lines"), F.col(P + "r").alias("n_removed"))
