"""Exact top-k inner-product search by pivot-table elimination."""

from __future__ import annotations

from collections.abc import Iterator
from functools import reduce

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.shared import shared_path
from .common import settle, small_batches

#: Blocks of queries that one job answers, and rows that a task compares at once.
WAVE, ROWS = 16, 8192


def _matrix(column: pd.Series) -> np.ndarray:
    return np.array(column.tolist(), dtype=np.int64).reshape(len(column), len(column.iloc[0]))


def _products(rows: np.ndarray, query: np.ndarray) -> np.ndarray:
    """Exact inner products of integers: in doubles if no sum can pass 2**53, else in Python's integers, held to 64 bits."""
    most = float(np.abs(rows.astype(np.float64)).max(initial=0)) * float(np.abs(query.astype(np.float64)).max(initial=0)) * max(1, rows.shape[1])
    if most < 2**53:
        return (rows.astype(np.float64) @ query.astype(np.float64)).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(row, query)) for row in rows]
    return np.array([min(max(x, -(2**63)), 2**63 - 1) for x in exact], dtype=np.int64)


def pick_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """n rows of the sample, each farthest from those before it."""
    x = sample.astype(np.float64)
    chosen = [int(np.argmax((x * x).sum(1)))]
    gap = ((x - x[chosen[0]]) ** 2).sum(1)
    while len(chosen) < min(n, len(x)) and gap.max() > 0:
        chosen.append(int(np.argmax(gap)))
        gap = np.minimum(gap, ((x - x[chosen[-1]]) ** 2).sum(1))
    return sample[chosen]


def _far(rows: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    x, p = rows.astype(np.float64), pivots.astype(np.float64)
    return np.sqrt(np.maximum(((x[:, None, :] - p[None, :, :]) ** 2).sum(2), 0))


def scan_block(
    rids: np.ndarray, ids: np.ndarray, rows: np.ndarray, norms: np.ndarray, far: np.ndarray, query: np.ndarray, own: int, query_far: np.ndarray, k: int, floor: float,
    best: tuple[np.ndarray, np.ndarray], step: int = 256,
) -> tuple[np.ndarray, np.ndarray]:
    """(ids, scores) of the k best of `best` and these rows, of which row `own` is the query's; scores below `floor` do not matter.

    |query - row| is at least the largest |d(query, p) - d(row, p)| over the pivots p, so the inner product is at most
    (|query|^2 + |row|^2 - that^2) / 2. Rows are scored in the order of this bound until it falls below the k-th score.
    """
    both = norms + float((query.astype(np.float64) ** 2).sum())
    bound = (both - np.abs(far - query_far).max(1) ** 2) / 2
    bound += 1e-9 * both + 1e-6  # rounding
    at = np.flatnonzero((bound >= max(floor, best[1][-1] if len(best[1]) == k else -np.inf)) & (rids != own))
    at = at[np.argsort(-bound[at], kind="stable")]
    for begin in range(0, len(at), step):
        part = at[begin : begin + step]
        if len(best[1]) == k and bound[part[0]] < best[1][-1]:
            break
        all_ids, scores = np.concatenate([best[0], ids[part]]), np.concatenate([best[1], _products(rows[part], query)])
        order = np.lexsort((all_ids, -np.maximum(scores, -(2**63) + 1)))[:k]
        best = all_ids[order], scores[order]
    return best


def floors(queries: list[tuple[int, np.ndarray, np.ndarray]], sample: dict[int, np.ndarray], k: int) -> list[float]:
    """For each query the (k + 1)-th best score among sampled rows (one of them may be the query's own): its k-th score is no less."""
    out = [-np.inf] * len(queries)
    for d in {len(v) for _, v, _ in queries} & {d for d, rows in sample.items() if len(rows) > k}:
        at = [i for i, q in enumerate(queries) if len(q[1]) == d]
        x, y = np.array([queries[i][1] for i in at], dtype=np.float64).reshape(len(at), d), sample[d].astype(np.float64)
        if np.abs(x).max(initial=0) * np.abs(y).max(initial=0) * max(1, d) < 2**53:
            for i, best in zip(at, np.partition(x @ y.T, len(y) - k - 1, axis=1)[:, len(y) - k - 1]):
                out[i] = float(best)
    return out


def exact_top_k(
    vectors: DataFrame, is_query: Column, k: int = 5, n_pivots: int = 24, pivot_sample: int = 2048, query_block: int = 2048, scale: int = 256,
    id_col: str = "vec_id", vector_col: str = "embedding",
) -> DataFrame:
    """The k rows with the largest integer inner product for every query row: query_id, rank (from 1), vec_id, score; ties to the smaller id.

    Components become floor(scale * x). Distances of all rows to the pivots are computed once and stored beside the vectors.
    Pivots come from a bounded sample (pivot_sample rows by hash, farthest first); they decide the speed, never the result.
    Queries meet all rows in blocks of query_block: a block, of bounded size, travels with the tasks, the vectors stay where
    they are, and each task returns k rows a query. Every query starts with a floor under its k-th score, from the sample, so
    that no task begins without a threshold. Rows are compared with queries of the same dimension.

    Null vectors, vectors with null, NaN or infinite components, and rows with a null id take no part; empty vectors score 0
    with each other. A query's own row alone is no candidate: rows that repeat its id are, and each of them that is a query
    has answers of its own under the same id. Repeated rows tie. An empty table gives no rows; other columns are left out;
    scores beyond 64 bits are held at the limits.
    """
    spark = vectors.sparkSession
    small_batches(spark)
    v = F.col(vector_col)
    whole = F.forall(v, lambda x: F.coalesce(x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")), F.lit(False)))
    clean = vectors.filter(F.col(id_col).isNotNull() & v.isNotNull()).filter(whole).select(
        F.col(id_col).cast("long").alias("id"), F.transform(v, lambda x: F.floor(F.lit(float(scale)) * x.cast("double")).cast("long")).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")
    )
    some = clean.select("v").orderBy(F.xxhash64("id"), "id", "v").limit(pivot_sample).collect()
    by_size = {d: [r[0] for r in some if len(r[0]) == d] for d in {len(r[0]) for r in some}}
    sample = {d: np.array(own, dtype=np.int64).reshape(len(own), d) for d, own in by_size.items()}
    pivots = {d: pick_pivots(own, n_pivots) for d, own in sample.items()}

    def to_pivots(rows: np.ndarray) -> np.ndarray:
        p = pivots.get(rows.shape[1])
        return np.zeros((len(rows), 1)) if p is None else _far(rows, p)

    def by_dim(batches: Iterator[pd.DataFrame], n: int) -> Iterator[pd.DataFrame]:
        """Batches gathered to some n rows, one dimension at a time."""
        held: list[pd.DataFrame] = []
        for pdf in batches:
            held.append(pdf)
            if sum(len(x) for x in held) >= n:
                yield from _parts(held)
                held = []
        if held:
            yield from _parts(held)

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for part in by_dim(batches, 1):
            for begin in range(0, len(part), 1024):
                few = part.iloc[begin : begin + 1024]
                yield few.assign(far=list(to_pivots(_matrix(few["v"]))))

    made = clean.mapInPandas(measure, "id long, v array<bigint>, q boolean, far array<double>")
    table = settle(made.withColumn("rid", F.monotonically_increasing_id()), "pivot-table")
    n_blocks = max(1, -(-table.filter("q").count() // query_block))
    parts, path = [], shared_path(spark, "topk")
    for block in range(n_blocks):
        mine = table.filter("q").filter(F.pmod(F.xxhash64("rid"), F.lit(n_blocks)) == block).select("rid", "id", "v", "far").collect()
        asked = [(r["rid"], r["id"], np.array(r["v"], dtype=np.int64), np.array(r["far"])) for r in sorted(mine)]
        least = floors([(q[0], q[2], q[3]) for q in asked], sample, k)

        def search(batches: Iterator[pd.DataFrame], asked=asked, least=least) -> Iterator[pd.DataFrame]:
            none = (np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64))
            best = [none] * len(asked)
            for part in by_dim(batches, ROWS):
                rows, ids, rids, far = _matrix(part["v"]), part["id"].to_numpy(np.int64), part["rid"].to_numpy(np.int64), np.array(part["far"].tolist())
                norms = (rows.astype(np.float64) ** 2).sum(1)
                for i, (own, _, query, query_far) in enumerate(asked):
                    if len(query) == rows.shape[1]:
                        best[i] = scan_block(rids, ids, rows, norms, far, query, own, query_far, k, least[i], best[i])
            for (own, query_id, _, _), (ids, scores) in zip(asked, best):
                if len(ids):
                    yield pd.DataFrame({"own": own, "query_id": query_id, "vec_id": ids, "score": scores})

        parts.append(table.select("rid", "id", "v", "far").mapInPandas(search, "own long, query_id long, vec_id long, score long"))
        if len(parts) == WAVE and block + 1 < n_blocks:  # plans stay small however many blocks there are
            reduce(DataFrame.unionAll, parts).write.mode("append").parquet(path)
            parts = []
    if n_blocks > WAVE:
        parts.append(spark.read.schema("own long, query_id long, vec_id long, score long").parquet(path))
    rank = F.row_number().over(Window.partitionBy("own").orderBy(F.col("score").desc(), "vec_id"))
    found = reduce(DataFrame.unionAll, parts).withColumn("rank", rank).filter(F.col("rank") <= k)
    return found.select("query_id", "rank", "vec_id", "score")


def _parts(held: list[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    both = pd.concat(held, ignore_index=True)
    for _, part in both.groupby(both["v"].map(len), sort=True):
        yield part
