"""Language identification by Bayesian fusion of text, declared language, address suffix and host."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import key_of, settle, small_batches
from .words import text_bytes

DIM = 1 << 16
_SLICE = 1 << 20


@dataclass
class TextModel:
    """log P(trigram of bytes | language), one row of hashed trigrams for each language."""

    languages: list[str]
    logs: np.ndarray


def _trigrams(data: np.ndarray) -> np.ndarray:
    x = data.astype(np.uint32)
    return ((x[:-2] * np.uint32(0x9E3779B1) + x[1:-1] * np.uint32(0x85EBCA77) + x[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(16)).astype(np.int64)


def text_scores(column: pa.Array, logs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sums of log P(trigram | language) for each text and language, and each text's number of trigrams.

    Texts are summed each for itself, in pieces that start with the text, so that a sum does not depend on its neighbours.
    """
    data, offsets = text_bytes(column)
    sums = np.zeros((len(offsets) - 1, len(logs)))
    n = np.maximum(np.diff(offsets) - 2, 0)
    i = 0
    while i < len(n):
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + _SLICE, side="right")) - 1)
        if j > i + 1:  # several short texts at once
            some = np.flatnonzero(n[i:j]) + i
            if len(some):
                grams = np.append(_trigrams(data[offsets[i] : offsets[j]]), 0)
                at = np.column_stack([offsets[some], offsets[some] + n[some]]).ravel() - offsets[i]
                for k in range(len(logs)):
                    sums[some, k] = np.add.reduceat(logs[k][grams], at)[::2]
        else:
            for a in range(0, int(n[i]), _SLICE):
                grams = _trigrams(data[offsets[i] + a : offsets[i] + min(a + _SLICE, int(n[i])) + 2])
                for k in range(len(logs)):
                    sums[i, k] += np.add.reduceat(logs[k][grams], [0])[0]
        i = j
    return sums, n


def train_text(docs: DataFrame, max_rows: int = 4_000, smoothing: float = 0.5, id_col: str = "doc_id", text_col: str = "text", lang_col: str = "lang") -> TextModel:
    """Trigram counts by language over at most max_rows labelled documents, the first by a hash of the id; whole texts.

    Tasks add up their counts, then one row a language is gathered: its size does not grow with the data.
    """
    small_batches(docs.sparkSession)
    few = docs.filter(F.col(lang_col).isNotNull() & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(lang_col).alias("lang")).orderBy(F.xxhash64("id"), "id", "lang").limit(max_rows)
    rows = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).join(F.broadcast(few), "id").select("lang", "t")

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang in batch.column("lang").unique().to_pylist():
                own = pa.compute.filter(batch.column("t"), pa.compute.equal(batch.column("lang"), lang))
                data, offsets = text_bytes(own)
                for a, b in zip(offsets[:-1], offsets[1:]):
                    if b - a > 2:
                        sums[lang] = sums.get(lang, 0) + np.bincount(_trigrams(data[a:b]), minlength=DIM)
        for lang, c in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang]), pa.array([c.astype("<i8").tobytes()], pa.binary())], ["lang", "counts"])

    def add(pdf: pd.DataFrame) -> pd.DataFrame:
        return pd.DataFrame({"lang": pdf["lang"].iloc[:1], "counts": [sum(np.frombuffer(c, dtype="<i8") for c in pdf["counts"]).tobytes()]})

    found = rows.mapInArrow(count, "lang string, counts binary").groupBy("lang").applyInPandas(add, "lang string, counts binary").collect()
    found = sorted((r[0], np.frombuffer(r[1], dtype="<i8") + smoothing) for r in found)
    return TextModel([lang for lang, _ in found], np.array([np.log(c / c.sum()) for _, c in found]).reshape(len(found), DIM))


def _plus(a: Column, b: Column) -> Column:
    return F.zip_with(a, b, lambda x, y: x + y)


def _logs(a: Column) -> Column:
    return F.transform(a, lambda x: F.log(x))


def _softmax(a: Column) -> Column:
    e = F.transform(a, lambda x: F.exp(x - F.array_max(a)))
    return F.transform(e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda s, y: s + y))


def fuse(
    items: DataFrame, model: TextModel, ids: list[str], host_strength: float = 5.0, domain_strength: float = 20.0, declared_smoothing: float = 1.0,
    most_evidence: float = 40.0,
) -> DataFrame:
    """The posterior of each language for items (ids, text, declared, suffix, host, domain): ids, lang, confidence, text_lang.

    - Text: trigram likelihoods. Neighbouring trigrams share bytes, so a text counts as a third of its trigrams, and its total
      as most_evidence trigrams at most: a long text cannot be surer than the model is right.
    - Host: texts alone give every item a soft count for each language. Summed over all items (q), a domain (shrunk to q with
      domain_strength) and a host (shrunk to its domain with host_strength), without the item itself, they are its prior.
    - Declared language and address suffix: P(value | language) from the same soft counts over all items.

    Aggregates are sums of one array a group, combined before the shuffle, so a host with a third of all items is no burden;
    items meet their group's row on ids and numbers alone, never with their texts.

    A text of fewer than 3 bytes (null and empty ones among them) has no text evidence, adds to no soft count, and has a null
    text_lang; a null declared language, suffix or host is no evidence of that kind. With no evidence at all the overall
    distribution is the posterior. Whole texts count, of whatever length, and a text's scores do not depend on how items are
    dealt out. Ties go to the first language by name. A model without languages gives null lang and confidence. Repeated rows
    and null ids are ordinary, other columns are left out; an empty table gives no rows.
    """
    langs = model.languages
    if not langs:
        none = F.lit(None)
        return items.select(*ids, none.cast("string").alias("lang"), none.cast("double").alias("confidence"), none.cast("string").alias("text_lang"))
    small_batches(items.sparkSession)
    logs = items.sparkSession.sparkContext.broadcast(model.logs)

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            sums, n = text_scores(b.column("text"), logs.value)
            sums *= (np.minimum(n / 3, most_evidence) / np.maximum(n, 1))[:, None]
            sums -= sums.max(1, initial=-np.inf, keepdims=True)
            scores = pa.ListArray.from_arrays(pa.array(np.arange(0, sums.size + 1, len(langs)), pa.int32()), pa.array(sums.ravel()))
            rest = [c for c in b.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([scores, pa.array(n > 0), *[b.column(c) for c in rest]], ["scores", "spoken", *rest])

    rest = [f for f in items.schema.fields if f.name in (*ids, "declared", "suffix", "host", "domain")]
    schema = "text string, " + ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rest)
    shaped = items.select("text", *[f.name for f in rest])
    scored = shaped.mapInArrow(score, schema.replace("text string", "scores array<double>, spoken boolean", 1))
    zero = F.array(*[F.lit(0.0)] * len(langs))
    rows = settle(scored.withColumn("soft", F.when(F.col("spoken"), _softmax(F.col("scores"))).otherwise(zero)), "language")

    def summed(by: str) -> DataFrame:
        sums = F.array(*[F.sum(F.col("soft")[i]) for i in range(len(langs))])
        return rows.filter(F.col(by).isNotNull()).groupBy(by).agg(sums.alias(f"{by}_sums"))

    every = rows.agg(F.array(*[F.coalesce(F.sum(F.col("soft")[i]), F.lit(0.0)) for i in range(len(langs))])).first()[0]
    q = F.array(*[F.lit(float((x + 1) / (sum(every) + len(langs)))) for x in every])
    hosts = settle(rows.filter("host is not null").groupBy("host", "domain").agg(F.array(*[F.sum(F.col("soft")[i]) for i in range(len(langs))]).alias("host_sums")).join(summed("domain"), "domain", "left"), "hosts")

    def likelihood(by: str) -> DataFrame:
        t = summed(by)
        d = t.agg(F.count(F.lit(1)).alias("d"), *[F.sum(F.col(f"{by}_sums")[i]).alias(f"t{i}") for i in range(len(langs))]).first()
        totals = F.array(*[F.lit(float((d[f"t{i}"] or 0) + declared_smoothing * d["d"])) for i in range(len(langs))])
        return t.select(by, F.zip_with(f"{by}_sums", totals, lambda x, n: F.log((x + declared_smoothing) / n)).alias(f"{by}_log"))

    hosts = hosts.withColumn("hk", F.concat_ws("|", key_of(F.col("host")), key_of(F.col("domain")))).drop("host", "domain")
    wide = rows.withColumn("hk", F.concat_ws("|", key_of(F.col("host")), key_of(F.col("domain")))).join(hosts, "hk", "left").join(likelihood("declared"), "declared", "left").join(likelihood("suffix"), "suffix", "left")

    def without_own(sums: str) -> Column:
        return F.zip_with(F.col(sums), F.col("soft"), lambda x, own: F.greatest(x - own, F.lit(0.0)))

    def shrunk(own: Column, to: Column, strength: float) -> Column:
        n = F.aggregate(own, F.lit(0.0), lambda s, x: s + x)
        return F.zip_with(own, to, lambda x, p: (x + strength * p) / (n + strength))

    wide = wide.withColumn("prior", F.coalesce(shrunk(without_own("domain_sums"), q, domain_strength), q))
    wide = wide.withColumn("prior", F.coalesce(shrunk(without_own("host_sums"), F.col("prior"), host_strength), F.col("prior")))
    log_post = _plus(_plus(F.col("scores"), _logs(F.col("prior"))), _plus(F.coalesce("declared_log", zero), F.coalesce("suffix_log", zero)))
    wide = wide.withColumn("lp", log_post).withColumn("post", _softmax(F.col("lp")))
    names = F.array(*[F.lit(x) for x in langs])

    def best(a: str) -> Column:
        return F.element_at(names, F.array_position(F.col(a), F.array_max(a)).cast("int"))

    return wide.select(*ids, best("post").alias("lang"), F.array_max("post").alias("confidence"), F.when(F.col("spoken"), best("scores")).alias("text_lang"))


def page_evidence(pages: DataFrame) -> DataFrame:
    """page_id, text, declared, suffix, host and domain of raw pages (page_id, url, html).

    The declared language is the lang attribute of the html element, else a content-language meta element, wherever they stand
    outside comments, scripts and styles. Text is what is outside tags, scripts and styles. The suffix is the host's last
    label, the domain its last two.
    """
    html = F.col("html")
    bare = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->", " ")
    attribute = F.regexp_extract(bare, r"(?is)<html\b[^>]*?\blang\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    meta = F.regexp_extract(bare, r"(?is)<meta\b[^>]*?content-language[^>]*?content\s*=\s*[\"']?([a-z]{2,3})\b", 1)
    text = F.regexp_replace(html, r"(?is)<(script|style)\b[^>]*>.*?</\1\s*>|<!--.*?-->|<[^>]*>", " ")
    host = F.nullif(F.lower(F.regexp_extract("url", r"(?i)^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)", 1)), F.lit(""))
    suffix = F.nullif(F.regexp_extract(host, r"\.([a-z]{2,24})$", 1), F.lit(""))
    domain = F.nullif(F.regexp_extract(host, r"([^.]+\.[^.]+)$", 1), F.lit(""))
    declared = F.coalesce(F.nullif(F.lower(attribute), F.lit("")), F.nullif(F.lower(meta), F.lit("")))
    return pages.select("page_id", text.alias("text"), declared.alias("declared"), suffix.alias("suffix"), host.alias("host"), domain.alias("domain"))
