"""Connected components by randomised contraction, on settled edge tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import mark, sweep
from .common import settle


def components(edges: DataFrame, counts: list[int] | None = None) -> DataFrame:
    """edges (u, v: long, u <> v) -> (node, root): the smallest node of each node's component.

    Every round ranks the nodes anew by a hash of round and node, points each to the first of itself and its neighbours, and
    moves the edges to what their ends point to. A node stays only if it is first among some neighbour's, which no order of the
    ids can arrange for more than a part of them, so the nodes of any graph, a long path in the order of its ids included, fall
    by a constant factor a round. Only one minimum a node is gathered, combined before the shuffle, so a node with very many
    edges is no burden. Tables of past rounds are deleted. With `counts`, the edges of every round are appended to it.
    """
    spark = edges.sparkSession
    start, roots, turn = mark(spark), None, 0
    left = settle(edges.filter("u <> v").select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct(), "edges")
    n = left.count()
    while n:
        if counts is not None:
            counts.append(n)
        rank = lambda c, turn=turn: F.struct(F.xxhash64(F.lit(turn), c).alias("h"), c.alias("n"))
        ends = left.select(F.explode(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))).alias("e"))
        near = ends.groupBy(F.col("e.u").alias("node")).agg(F.min(rank(F.col("e.v"))).alias("r"))
        to = settle(near.select("node", F.least("r", rank(F.col("node")))["n"].alias("to")), "pointers")
        roots = to.withColumnRenamed("to", "root") if roots is None else settle(
            roots.join(to.select(F.col("node").alias("root"), "to"), "root", "left").select("node", F.coalesce("to", "root").alias("root")), "roots"
        )
        moved = left.join(to.select(F.col("node").alias("u"), F.col("to").alias("a")), "u").join(to.select(F.col("node").alias("v"), F.col("to").alias("b")), "v")
        left = settle(moved.filter("a <> b").select(F.least("a", "b").alias("u"), F.greatest("a", "b").alias("v")).distinct(), "edges")
        n, turn = left.count(), turn + 1
        sweep(spark, start, keep=left.select("u").union(roots.select("root")))
    if roots is None:
        return left.select(F.col("u").alias("node"), F.col("v").alias("root"))
    least = settle(roots.groupBy("root").agg(F.min("node").alias("least")), "least")
    return roots.join(least, "root").select("node", F.col("least").alias("root"))
