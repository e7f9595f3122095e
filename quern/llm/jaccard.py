"""N-gram Jaccard self-join by a MinHash LSH forest with exact verification."""

from __future__ import annotations

from collections.abc import Iterator
from fractions import Fraction

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import P, checked_broadcast, settle, small_batches
from .components import components
from .words import mix, shingles, words


def forest_depth(trees: int, max_depth: int, similarity: float, recall: float) -> int:
    """Shorten the prefix that must match, from max_depth on, until a pair at `similarity` meets in one of the trees with probability `recall`."""
    depth = max_depth
    while depth > 1 and 1 - (1 - similarity**depth) ** trees < recall:
        depth -= 1
    return depth


def trees_for(depth: int, similarity: float, recall: float) -> int:
    """How many trees a prefix of `depth` needs for the recall."""
    trees = 1
    while similarity < 1 and 1 - (1 - similarity**depth) ** trees < recall:
        trees += 1
    return trees


def _hash_functions(n: int, seed: int) -> tuple[np.ndarray, np.ndarray]:
    """n random functions x -> top bits of a * x + b, from a fixed sequence."""
    x = mix(np.arange(1, 2 * n + 1, dtype=np.uint64) + np.uint64(seed * 0x9E3779B97F4A7C15 % 2**64))
    return x[:n] | np.uint64(1), x[n:]


def forest_labels(sets: np.ndarray, a: np.ndarray, b: np.ndarray, trees: int) -> np.ndarray:
    """One prefix hash for each tree of a set of shingle hashes: trees * depth minima, those of a tree folded into 64 bits."""
    least = np.full(len(a), np.iinfo(np.uint64).max, dtype=np.uint64)
    for i in range(0, len(sets), 512):
        least = np.minimum(least, (sets[i : i + 512, None] * a[None, :] + b[None, :]).min(0))
    rows = (least >> np.uint64(24)).reshape(trees, -1)
    out = np.arange(1, trees + 1, dtype=np.uint64)
    for k in range(rows.shape[1]):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + rows[:, k])
    return out


def linked(sets: list[np.ndarray], side: np.ndarray, similarity: Fraction) -> np.ndarray:
    """Matrix of the pairs whose Jaccard similarity is at least `similarity`; with two sides, only of pairs across."""
    m, sizes = len(sets), np.array([len(s) for s in sets], dtype=np.int64)
    _, place, seen = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    row = np.repeat(np.arange(m), sizes)
    shared = seen[place] > 1  # what one set alone holds is in no intersection
    column = (np.cumsum(seen > 1) - 1)[place[shared]]
    bits = np.zeros((m, max(1, -(-int((seen > 1).sum()) // 64))), dtype=np.uint64)
    np.bitwise_or.at(bits, (row[shared], column >> 6), np.uint64(1) << (column & 63).astype(np.uint64))
    out = np.zeros((m, m), dtype=bool)
    across = side.min() != side.max()
    for i in range(m - 1):
        rest = np.arange(i + 1, m)
        if across:
            rest = rest[side[i + 1 :] != side[i]]
        rest = rest[(sizes[rest] * similarity.denominator >= sizes[i] * similarity.numerator) & (sizes[i] * similarity.denominator >= sizes[rest] * similarity.numerator)]
        if len(rest):
            common = np.bitwise_count(bits[rest] & bits[i]).sum(1, dtype=np.int64)
            out[i, rest] = common * similarity.denominator >= (sizes[i] + sizes[rest] - common) * similarity.numerator
    return out | out.T


def _longs(each: list[np.ndarray]) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum([len(x) for x in each])]), pa.int32()), pa.array(np.concatenate([*each, _NONE]), pa.int64()))


def _prints(own: np.ndarray) -> tuple[int, int]:
    """Two sums that stand for a set of shingle hashes."""
    return int(mix(own + np.uint64(1)).sum(dtype=np.uint64)), int(mix(own ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64))


def _nodes(labels: DataFrame) -> DataFrame:
    """(k, n, prefix, met): classes by the trie nodes that they share with others, and how many share it; settled. labels has k, n, labels."""
    prefixes = labels.select("k", "n", F.explode("labels").alias("prefix"))
    met = prefixes.groupBy("prefix").agg(F.count(F.lit(1)).alias("met")).filter("met > 1")
    return settle(prefixes.join(met, "prefix"), "nodes")


def _leaf_pairs(nodes: DataFrame, leaf: int, threshold: Fraction) -> DataFrame:
    """(a, b), a < b: pairs of classes that share a node of at most `leaf` classes and whose sizes allow the similarity."""
    own = nodes.filter(F.col("met") <= leaf).groupBy("prefix").agg(F.sort_array(F.collect_list(F.struct("k", "n"))).alias("m"))
    small, large = (lambda x, y: F.least(x["n"], y["n"])), (lambda x, y: F.greatest(x["n"], y["n"]))

    def of(x, i):
        rest = F.filter(F.slice("m", i + 2, leaf), lambda y: small(x, y) * threshold.denominator >= large(x, y) * threshold.numerator)
        return F.transform(rest, lambda y: F.struct(x["k"].alias("a"), y["k"].alias("b")))

    return own.select(F.explode(F.flatten(F.transform("m", of))).alias("p")).select("p.a", "p.b").distinct()


def _verified(pairs: DataFrame, sets: DataFrame, threshold: Fraction) -> DataFrame:
    """The pairs (a, b) whose sets (k, shingles; a set may be there twice) are similar enough.

    The set of a is sent once for all its pairs, ahead of those of its partners; a task holds two sets at a time.
    """
    sent = pairs.select(F.col("a").alias("key"), F.col("b").alias("k")).unionByName(pairs.select(F.col("a").alias("key"), F.col("a").alias("k")).distinct())
    rows = sent.join(sets, "k").repartition("key").sortWithinPartitions("key", "k")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, own, last = None, np.zeros(0, dtype=np.uint64), None
        for batch in batches:
            column = batch.column("shingles")
            cuts, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
            a, b = [], []
            for i, (x, k) in enumerate(zip(batch.column("key").to_pylist(), batch.column("k").to_pylist())):
                here = flat[cuts[i] : cuts[i + 1]]
                if x == k:
                    key, own, last = x, here.copy(), k
                elif x == key and k != last:
                    last = k
                    at = np.minimum(np.searchsorted(own, here), len(own) - 1)
                    common = int((own[at] == here).sum())
                    if common * threshold.denominator >= (len(own) + len(here) - common) * threshold.numerator:
                        a.append(x)
                        b.append(k)
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return settle(rows.select("key", "k", "shingles").mapInArrow(verify, "a long, b long"), "pairs")


def _family_links(families: DataFrame, classes: DataFrame, sets: DataFrame, threshold: Fraction, block_shingles: int, block_rows: int) -> DataFrame:
    """(k, links, near): for each class its links inside its family, and an edge of a spanning forest; families has k, family.

    All pairs of a family are compared, in blocks of neighbouring set sizes: every block meets every block of its own and the
    next bin in a task of its own. Counts and edges leave a task, never pairs.
    """
    similarity = float(threshold)
    # Sizes of a linked pair differ by 1 / similarity at most, so they lie in the same or in neighbouring bins.
    size_bin = F.floor(F.log("n") / float(np.log(1 / similarity)) + 1e-9) if similarity < 1 else F.col("n")
    members = settle(families.join(classes.select("k", "copies", "n"), "k").withColumn("bin", size_bin), "members")
    blocks = F.greatest(F.ceil(F.sum("n") / block_shingles), F.ceil(F.count(F.lit(1)) / block_rows))
    bins = settle(members.groupBy("family", "bin").agg(blocks.alias("blocks")), "bins")
    here = members.join(bins, ["family", "bin"])
    here = here.withColumn("part", F.pmod(F.xxhash64("k"), F.col("blocks")))
    above = bins.select("family", (F.col("bin") - 1).alias("bin"), F.col("blocks").alias("above"))
    below = bins.select("family", (F.col("bin") + 1).alias("bin"), F.col("blocks").alias("below"))
    here = here.join(above, ["family", "bin"], "left").join(below, ["family", "bin"], "left")
    own = F.struct("bin", "part")

    def with_bin(bin_col, count):
        other = F.transform(F.sequence(F.lit(0), F.greatest(count, F.lit(1)).cast("int") - 1), lambda k: F.struct(bin_col.alias("bin"), k.cast("long").alias("part")))
        return F.when(count > 0, F.transform(other, lambda o: F.struct(F.least(own, o).alias("lo"), F.greatest(own, o).alias("hi"))))

    none = F.array().cast("array<struct<lo:struct<bin:bigint,part:bigint>,hi:struct<bin:bigint,part:bigint>>>")
    tasks = F.concat(with_bin(F.col("bin"), F.col("blocks")), F.coalesce(with_bin(F.col("bin") + 1, F.col("above")), none), F.coalesce(with_bin(F.col("bin") - 1, F.col("below")), none))
    placed = here.select("k", "copies", "family", own.alias("own"), F.explode(tasks).alias("task"))

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.drop_duplicates("k").sort_values("k").reset_index(drop=True)
        side = np.array([(o["bin"], o["part"]) == (h["bin"], h["part"]) for o, h in zip(pdf["own"], pdf["hi"])], dtype=int)
        alone = pdf["lo"].iloc[0] == pdf["hi"].iloc[0]
        if len(pdf) < 2 or not alone and side.min() == side.max():
            return pd.DataFrame({"k": [], "links": [], "near": []}).astype("int64")
        pairs = linked([np.asarray(s, dtype=np.int64) for s in pdf["shingles"]], side, threshold)
        links, label = pairs @ pdf["copies"].to_numpy(np.int64), np.arange(len(pdf))
        while True:
            least = np.minimum(label, np.where(pairs, label[None, :], len(pdf)).min(1))
            least = least[least]
            if (least == label).all():
                break
            label = least
        some = pairs.any(1)
        ids = pdf["k"].to_numpy(np.int64)
        return pd.DataFrame({"k": ids[some], "links": links[some].astype("int64"), "near": ids[label][some]})

    ready = placed.join(sets, "k").select("k", "copies", "family", "own", "task.lo", "task.hi", "shingles")
    return settle(ready.groupBy("family", "lo", "hi").applyInPandas(verify, "k long, links long, near long"), "links")


def jaccard_groups(
    docs: DataFrame, similarity: float = 0.8, n: int = 5, trees: int = 32, max_depth: int = 12, recall: float = 0.9999, seed: int = 17, leaf: int = 64,
    block_shingles: int = 64_000, block_rows: int = 256, broadcast_rows: int = 200_000, id_col: str = "doc_id", text_col: str = "text",
) -> DataFrame:
    """All pairs of documents whose sets of n-word shingles have a Jaccard similarity of at least `similarity`, as groups and counts.

    One row per row of docs: id_col, class_id (smallest id of its group of directly or indirectly linked documents), text_id
    (smallest id of the documents with the same shingles), n_links (other documents it is linked to, long).

    Documents with equal sets are one class, so copies cost nothing further. A tree of the forest is a trie over signatures of
    max_depth minima, in which classes that share a prefix meet in a node.

    1. The prefix is shortened as far as the target recall asks: to the depth at which a pair at the threshold shares a node
       of some tree with probability `recall`. Nodes of at most `leaf` classes give their pairs as candidates, and each
       candidate pair is verified once, exactly, on the shingles themselves.
    2. Where a node holds more, its classes keep the longer prefix of max_depth, in as many trees as that depth needs for the
       same recall. A pair that met in a full node alone meets again there, if it is a link; unlike pages made from one
       template hardly do.
    3. Classes that share a full node even there are a dense family, all pairs of which are verified in blocks.

    So every pair is verified on one path, and none is dropped for a node's size. Only candidate ids of small nodes, counts
    and spanning edges are written, never all pairs of a group.

    Words are those of `words`; a text of fewer than n words has one shingle. Shingles are held as 64-bit hashes, classes as
    128 bits. Texts of any length count whole. Texts without words (null, empty, only signs) are linked to nothing and are
    their own class. Rows with a null id have null class and text ids and 0 links and take no part. Rows that repeat an id
    count as documents of their own, whether their texts are equal or not. An empty table gives no rows; other columns are
    left out.
    """
    small_batches(docs.sparkSession)
    depth, threshold = forest_depth(trees, max_depth, similarity, recall), Fraction(str(similarity))
    a, b = _hash_functions(trees * depth, seed)
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))

    def sign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, cuts = shingles(*words(batch.column("t")), n)
            known, size, prints, labels = {}, [], [], []
            for i in range(len(cuts) - 1):
                own = np.unique(hashes[cuts[i] : cuts[i + 1]])
                two = _prints(own)
                size.append(len(own))
                prints.append(two)
                if two not in known and len(own):
                    known[two] = forest_labels(own, a, b, trees).astype(np.int64)
                labels.append(known.get(two, _NONE))
            p = np.array(prints, dtype=np.uint64).reshape(-1, 2).astype(np.int64)
            yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(p[:, 0]), pa.array(p[:, 1]), pa.array(size, pa.int64()), _longs(labels)], ["id", "p1", "p2", "n", "labels"])

    signed = settle(source.mapInArrow(sign, "id long, p1 long, p2 long, n long, labels array<bigint>"), "signatures")
    classes = signed.filter("id is not null and n > 0").groupBy("p1", "p2").agg(F.min("id").alias("text_id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n"), F.first("labels").alias("labels"))
    classes = settle(classes.withColumn("k", F.monotonically_increasing_id()), "classes")
    nodes = _nodes(classes)

    # The sets of all classes that share a node, by the text of one document of each; an id may be on rows of several texts.
    members = settle(nodes.select("k").distinct().join(classes.select("k", "text_id", "p1", "p2"), "k"), "members")
    texts = source.join(checked_broadcast(members, broadcast_rows), F.col("id") == F.col("text_id")).select("k", "p1", "p2", "t")

    def own_sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            hashes, cuts = shingles(*words(batch.column("t")), n)
            each, ids = [], []
            for i, (k, p1, p2) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("k", "p1", "p2")))):
                own = np.unique(hashes[cuts[i] : cuts[i + 1]])
                if _prints(own) == (p1 % 2**64, p2 % 2**64):
                    ids.append(k)
                    each.append(own.view(np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), _longs(each)], ["k", "shingles"])

    sets = settle(texts.mapInArrow(own_sets, "k long, shingles array<bigint>"), "sets")
    candidates = _leaf_pairs(nodes, leaf, threshold)
    full = settle(nodes.filter(F.col("met") > leaf).select("k", "n").distinct(), "full")
    found = None
    if not full.isEmpty():
        more = trees_for(max_depth, similarity, recall)
        deep_a, deep_b = _hash_functions(more * max_depth, seed + 1)

        def sign_deep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column("shingles")
                cuts, flat = column.offsets.to_numpy(), column.values.to_numpy().view(np.uint64)
                labels = [forest_labels(flat[i:j], deep_a, deep_b, more).astype(np.int64) for i, j in zip(cuts[:-1], cuts[1:])]
                yield pa.RecordBatch.from_arrays([batch.column("k"), batch.column("n"), _longs(labels)], ["k", "n", "labels"])

        deep = full.join(sets, "k").select("k", "n", "shingles").mapInArrow(sign_deep, "k long, n long, labels array<bigint>")
        deep = _nodes(settle(deep, "deep").dropDuplicates(["k"]))
        crowd = deep.filter(F.col("met") > leaf)
        first = crowd.groupBy("prefix").agg(F.min("k").alias("first"))
        star = crowd.join(first, "prefix").filter("k <> first").select(F.col("first").alias("u"), F.col("k").alias("v")).distinct()
        families = settle(components(star).withColumnsRenamed({"node": "k", "root": "family"}), "families")
        found = _family_links(families, classes, sets, threshold, block_shingles, block_rows)
        candidates = candidates.union(_leaf_pairs(deep, leaf, threshold)).distinct()
        of = lambda x: families.withColumnsRenamed({"k": x, "family": f"f{x}"})
        candidates = candidates.join(of("a"), "a", "left").join(of("b"), "b", "left").filter("fa is null or fb is null or fa <> fb").select("a", "b")
    pairs = _verified(candidates, sets, threshold)

    copies = classes.select("k", "copies")
    one = pairs.join(copies.withColumnRenamed("k", "b"), "b").select(F.col("a").alias("k"), F.col("copies").alias("links"))
    other = pairs.join(copies.withColumnRenamed("k", "a"), "a").select(F.col("b").alias("k"), F.col("copies").alias("links"))
    links, edges = one.union(other), pairs.select(F.col("a").alias("u"), F.col("b").alias("v"))
    if found is not None:
        links, edges = links.union(found.select("k", "links")), edges.union(found.select(F.col("near").alias("u"), F.col("k").alias("v")))
    counts = links.groupBy("k").agg(F.sum("links").alias("links"))
    groups = components(edges).withColumnsRenamed({"node": "k"}).join(classes.select("k", "text_id"), "k")
    named = groups.join(groups.groupBy("root").agg(F.min("text_id").alias("class_id")), "root").select("k", "class_id")
    each = classes.select("p1", "p2", "k", "text_id", "copies").join(settle(named.join(counts, "k"), "linked"), "k", "left")
    out = signed.select("id", "p1", "p2", "n").join(each, ["p1", "p2"], "left")
    real = F.col("id").isNotNull() & (F.col("n") > 0)
    return out.select(
        F.col("id").alias(id_col), F.when(real, F.coalesce("class_id", "text_id")).otherwise(F.col("id")).alias("class_id"), F.when(real, F.col("text_id")).otherwise(F.col("id")).alias("text_id"),
        F.when(real, F.col("copies") - 1 + F.coalesce("links", F.lit(0))).otherwise(F.lit(0)).cast("long").alias("n_links"),
    )


_NONE = np.zeros(0, dtype=np.int64)


def keep_one(docs: DataFrame, broadcast_rows: int = 1_000_000, id_col: str = "doc_id", **options) -> DataFrame:
    """docs with one document of each group of `jaccard_groups`, that with the smallest id; rows that repeat that id all stay."""
    groups = jaccard_groups(docs, id_col=id_col, **options)
    gone = settle(groups.filter(F.col("class_id") != F.col(id_col)).select(F.col(id_col).alias(P + "id")).distinct(), "copies")
    return docs.join(checked_broadcast(gone, broadcast_rows), docs[id_col] == gone[P + "id"], "left_anti")
