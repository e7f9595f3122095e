"""De-duplication of an assembled set: exact copies, MinHash signatures, banding, verified pairs, one row a cluster."""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.strings import or_empty, words
from ..sources.shared import settled


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """One row for each distinct text: its smallest id and n_copies. Only 256-bit hashes are shuffled."""
    return docs.groupBy(F.sha2(F.coalesce(F.col(text), F.lit("")), 256).alias("text_hash")).agg(F.min(id_col).alias(id_col), F.count(F.lit(1)).alias("n_copies"))


def word_set(text: Column) -> Column:
    return F.array_distinct(words(F.lower(text)))


def _folded(text: Column) -> Column:
    """The text in lower case as bytes, which bytes.split() parts as words() does."""
    return F.lower(or_empty(text)).cast("binary")


def small_batches(spark: SparkSession) -> None:
    """Bound what an Arrow batch holds, as texts may be long, by the same values as the corpus operators."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 512)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", "8m")


def _digests(most: int = 1 << 17) -> Callable[[set[bytes]], np.ndarray]:
    """The sha256 of each word of a set as a row of 8 numbers; up to `most` words are kept, as texts share most of theirs."""
    at, rows = {}, np.empty((most, 8), dtype=np.uint32)

    def of(own: set[bytes]) -> np.ndarray:
        nonlocal rows
        if len(at) + len(own) > len(rows):
            at.clear()
            rows = np.empty((max(most, len(own)), 8), dtype=np.uint32)
        new = [w for w in own if w not in at]
        if new:
            rows[len(at) : len(at) + len(new)] = np.frombuffer(b"".join(hashlib.sha256(w).digest() for w in new), dtype=">u4").reshape(-1, 8)
            at.update(zip(new, range(len(at), len(at) + len(new))))
        return rows[np.fromiter(map(at.__getitem__, own), np.int64, len(own))]

    return of


def signature(text: Column, seeds: int = 8) -> Column:
    """Array of MinHash minima over the text's distinct words; null without words.

    One sha256 a word, of which each seed takes 8 digits: any engine gets the same, and a word is hashed once for all seeds.
    """

    def minima(texts: Iterator[pd.Series]) -> Iterator[pd.Series]:
        digests = _digests()
        for batch in texts:
            sets = (set(t.split()) for t in batch)
            yield pd.Series([[f"{x:08x}" for x in digests(s).min(0)[:seeds]] if s else None for s in sets], dtype=object)

    minima.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.Series]}
    return F.pandas_udf(minima, "array<string>")(_folded(text))


def pairs_within(rows: DataFrame, key: str, id_col: str, carried: tuple[str, ...] = (), block_rows: int = 4096) -> DataFrame:
    """(a, b, and each carried column as x_a and x_b), a < b: all pairs of rows with the same key; rows is read several times.

    Rows of keys of up to block_rows rows are shuffled once, for both sides. A key of more is cut into blocks of about that
    many, and every block meets every block in a task key of its own; there are at most a block_rows-th as many such keys as rows.
    """
    heavy = settled(rows.groupBy(key).agg(F.count(F.lit(1)).alias("met")).filter(F.col("met") > block_rows), "heavy")
    side = lambda x, s, *more: x.select(key, F.col(id_col).alias(s), *[F.col(c).alias(f"{c}_{s}") for c in carried], *more)
    light = rows.select(key, id_col, *carried).join(F.broadcast(heavy), key, "left_anti").repartition(key)
    each = rows.join(F.broadcast(heavy), key).withColumn("blocks", F.ceil(F.col("met") / block_rows).cast("int")).withColumn("own", F.pmod(F.xxhash64(id_col), F.col("blocks")).cast("int"))
    every = F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))
    within = side(light, "a").join(side(light, "b"), key).filter("a < b")
    across = side(each, "a", F.col("own").alias("p"), every.alias("q")).join(side(each, "b", every.alias("p"), F.col("own").alias("q")), [key, "p", "q"])
    return within.unionByName(across.filter("a < b").drop("p", "q"))


def candidates(signed: DataFrame, bands: int = 4, rows: int = 2, id_col: str = "doc_id", sig: str = "sig", block_rows: int = 4096) -> DataFrame:
    """(a, b), a < b: all pairs of rows that share all of some band, by 64-bit hashes of the bands.

    A bucket of n rows holds n * (n - 1) / 2 pairs, compared in blocks; a pair leaves the first band that it shares only, so
    pairs are not shuffled, but for those of ids that several rows have. Where only similar texts matter, near_classes compares
    each distinct word set once.
    """
    own = [F.xxhash64(F.lit(i), F.array_join(F.slice(sig, i * rows + 1, rows), "|")).alias(f"h{i}") for i in range(bands)]
    known = settled(signed.filter(F.col(sig).isNotNull() & F.col(id_col).isNotNull()).select(id_col, *own), "bands")
    often = settled(known.groupBy(id_col).agg(F.count(F.lit(1)).alias("many")).filter("many > 1"), "repeated")
    if often.isEmpty():
        return _banded(known, bands, id_col, block_rows)
    met = _banded(known.join(often, id_col, "left").fillna(0, ["many"]), bands, id_col, block_rows, ("many",))
    once = (F.col("many_a") == 0) & (F.col("many_b") == 0)
    return met.filter(once).select("a", "b").unionByName(met.filter(~once).select("a", "b").distinct())


def _banded(known: DataFrame, bands: int, id_col: str, block_rows: int, carried: tuple[str, ...] = (), keep: Column | None = None) -> DataFrame:
    """(a, b, carried) of the settled rows (id_col, h0 to the last band's hash, carried), each pair of rows once; keep is a condition on x_a and x_b."""
    hashes = [f"h{i}" for i in range(bands)]
    keyed = known.select(id_col, *hashes, *carried, F.explode(F.array(*hashes)).alias("band"))
    met = pairs_within(keyed, "band", id_col, (*hashes, *carried), block_rows)
    first = F.coalesce(*[F.when(F.col(f"{h}_a") == F.col(f"{h}_b"), F.col(f"{h}_a")) for h in hashes])
    met = met.filter((F.col("band") == first) & (F.lit(True) if keep is None else keep))
    return met.select("a", "b", *[f"{c}_{s}" for c in carried for s in "ab"])


def verified(pairs: DataFrame, docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, jaccard) of the pairs whose word sets are at least that similar; sets are made for documents in pairs alone."""
    pairs = settled(pairs, "pairs")
    paired = pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct()
    sets = settled(docs.select(F.col(id_col).alias("k"), F.col(text).alias("t")).join(paired, "k", "left_semi").select("k", word_set(F.col("t")).alias("w")), "sets")
    return _similar(pairs, sets, least)


def _similar(pairs: DataFrame, sets: DataFrame, least: float) -> DataFrame:
    both = pairs.join(sets.withColumnsRenamed({"k": "a", "w": "wa"}), "a").join(sets.withColumnsRenamed({"k": "b", "w": "wb"}), "b")
    common = F.size(F.array_intersect("wa", "wb"))
    out = both.withColumn("jaccard", common / (F.size("wa") + F.size("wb") - common))
    return out.filter(F.col("jaccard") >= least).select("a", "b", "jaccard")


#: Longs of a word set's marks, and of the further marks of sets of more than _SMALL words.
_MARKS, _FURTHER, _SMALL = 8, 32, 512


def _parities(places: np.ndarray, longs: int) -> list[int]:
    odd = np.bincount(places & (64 * longs - 1), minlength=64 * longs) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64).tolist()


def _prints(text: Column) -> Column:
    """Struct of a text's distinct words: their sha256 (print), number (n), MinHash minima in pairs (sig), and marks; n is 0 without words.

    Marks are the parities of the words by 512 places, and by 2048 for large sets: sets whose marks differ in d places differ
    in d words at least.
    """

    def made(texts: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        digests = _digests()
        for batch in texts:
            rows = []
            for t in batch:
                own = set(t.split())
                if not own:
                    rows.append((None, 0, None, None))
                    continue
                d = digests(own)
                least = d.min(0).astype(np.int64)
                marks = _parities(d[:, 0], _MARKS) + (_parities(d[:, 1], _FURTHER) if len(own) > _SMALL else [])
                rows.append((hashlib.sha256(b" ".join(sorted(own))).digest(), len(own), ((least[0::2] << 32) | least[1::2]).tolist(), marks))
            yield pd.DataFrame(rows, columns=["print", "n", "sig", "marks"])

    made.__annotations__ = {"texts": Iterator[pd.Series], "return": Iterator[pd.DataFrame]}
    return F.pandas_udf(made, "print binary, n int, sig array<long>, marks array<long>")(_folded(text))


def near_classes(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text: str = "text") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Classes of equal word sets, and the verified pairs of classes: members (k, id), classes (k, first, copies), pairs (a, b, jaccard of k).

    Copies collapse before banding, so each distinct word set is compared once. Pairs whose sizes or marks tell that they differ
    in more words than `least` allows, which loses nothing, are passed over before sets are fetched: what is shuffled of texts
    follows the near pairs, not the pairs that share a band by chance. Rows without words or with a null id take no part.
    """
    small_batches(docs.sparkSession)
    signed = docs.filter(F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), _prints(F.col(text)).alias("s"))
    hashes = [F.xxhash64(F.lit(i), F.col("s.sig")[i]).alias(f"h{i}") for i in range(4)]
    marks, further = [f"m{k}" for k in range(_MARKS)], [f"g{k}" for k in range(_FURTHER)]
    places = [F.coalesce(F.get("s.marks", F.lit(k)), F.lit(0).cast("long")).alias(c) for k, c in enumerate(marks + further)]
    signed = settled(signed.filter("s.n > 0").select("id", "s.print", "s.n", *hashes, *places), "signed")
    wide = ["n", "h0", "h1", "h2", "h3", *marks, *further]
    classes = signed.groupBy("print").agg(F.min("id").alias("first"), F.count(F.lit(1)).alias("copies"), *[F.first(c).alias(c) for c in wide])
    classes = settled(classes.withColumn("k", F.monotonically_increasing_id()), "classes")
    members = settled(signed.select("print", "id").join(classes.select("print", "k"), "print").select("k", "id").distinct(), "members")
    differ = lambda names: sum((F.bit_count(F.col(f"{m}_a").bitwiseXOR(F.col(f"{m}_b"))) for m in names), F.lit(0)) * (1 + least)
    may = (F.col("n_a") + F.col("n_b")) * (1 - least) + 1e-6
    keep = (F.least("n_a", "n_b") >= F.greatest("n_a", "n_b") * least - 1e-6) & (differ(marks) <= may) & ((F.least("n_a", "n_b") <= _SMALL) | (differ(further) <= may))
    pairs = settled(_banded(classes, 4, "k", 4096, ("n", *marks, *further), keep).select("a", "b"), "pairs")
    paired = settled(classes.select("k", "first", "print").join(pairs.select(F.explode(F.array("a", "b")).alias("k")).distinct(), "k", "left_semi"), "paired")
    texts = docs.select(F.col(id_col).alias("first"), F.col(text).alias("t")).join(paired, "first").select("k", "print", word_set(F.col("t")).alias("w"))
    print_of = F.unhex(F.sha2(F.array_join(F.array_sort("w"), " "), 256))
    sets = settled(texts.filter(F.col("print") == print_of).select("k", "w").dropDuplicates(["k"]), "sets")  # an id may be on rows of several texts
    return members, classes.select("k", "first", "copies"), _similar(pairs, sets, least)


def near_pairs(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, jaccard), a < b: all pairs of rows that share a band and whose word sets are at least that similar, copies included."""
    members, classes, pairs = near_classes(docs, least, id_col, text)
    equal = pairs_within(members.join(classes.filter("copies > 1"), "k", "left_semi"), "k", "id").select("a", "b", F.lit(1.0).alias("jaccard"))
    one, other = members.withColumnsRenamed({"k": "a", "id": "x"}), members.withColumnsRenamed({"k": "b", "id": "y"})
    across = pairs.join(one, "a").join(other, "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "jaccard")
    return equal.unionByName(across)


def near_firsts(docs: DataFrame, least: float = 0.8, id_col: str = "doc_id", text: str = "text") -> DataFrame:
    """(a, b, jaccard), a < b: each row with the first of its equal word sets, and all near pairs of such first rows.

    No link between different word sets is lost, and copies give one row each instead of all their pairs.
    """
    members, classes, pairs = near_classes(docs, least, id_col, text)
    equal = members.join(classes.filter("copies > 1").select("k", "first"), "k").filter("id <> first").select(F.col("first").alias("a"), F.col("id").alias("b"), F.lit(1.0).alias("jaccard"))
    firsts = classes.select("k", "first")
    one, other = firsts.withColumnsRenamed({"k": "a", "first": "x"}), firsts.withColumnsRenamed({"k": "b", "first": "y"})
    across = pairs.join(one, "a").join(other, "b").filter("x <> y").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "jaccard")
    return equal.unionByName(across)
