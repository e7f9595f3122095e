"""Secret scans: fixed patterns plus a randomness test battery under false-discovery control."""

from __future__ import annotations

import math
import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import settle, small_batches

# The patterns of the base scan, the least length that counts, and the order of kinds.
ASSIGN = r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
KINDS = ("assign", "access", "hex", "random")
LEAST = {"assign": 6, "access": 20, "hex": 24}

#: Encodings in the order in which they are tried: name, pattern, alphabet, excess of the index of coincidence in ordinary tokens.
ENCODINGS = (
    ("hex", r"(?:[0-9a-f]+|[0-9A-F]+)\Z", "0123456789abcdef", 0.6),
    ("base32", r"[A-Z2-7]+=*\Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567", 1.1),
    ("base36", r"[a-z0-9]+\Z", "0123456789abcdefghijklmnopqrstuvwxyz", 1.3),
    ("base62", r"[A-Za-z0-9]+\Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789", 2.8),
    ("base64url", r"[A-Za-z0-9_-]+=*\Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789-_", 2.9),
    ("base64", r"[A-Za-z0-9+/]+=*\Z", "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/", 2.9),
)
#: Ordinary tokens change between lower case, upper case, digits and signs at most at this rate, and sequences are this correlated.
CHANGE_RATE, CORRELATION = 0.25, 0.85
#: Length bands of the false-discovery control, and steps of -log10 p on its grid.
BANDS, GRID, TOP = (20, 24, 32, 48, 80, 160), 10, 300


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, order of kind, end) of every base match, by start, then kind."""
    spans = []
    if ":" in text or "=" in text:
        spans += [(m.start(), 0, m.end()) for m in _ASSIGN.finditer(text) if len(m[2]) >= LEAST["assign"]]
    if "AKIA" in text:
        spans += [(m.start(), 1, m.end()) for m in _ACCESS.finditer(text) if m.end() - m.start() >= LEAST["access"]]
    # A run of the class is maximal, so asking for 24 or more is the same as dropping shorter runs.
    spans += [(m.start(), 2, m.end()) for m in _LONG_HEX.finditer(text)]
    return sorted(spans)


_ASSIGN = re.compile(ASSIGN, re.IGNORECASE | re.ASCII)
_ACCESS = re.compile(ACCESS)
_LONG_HEX = re.compile(HEX[:-1] + "{%d,}" % LEAST["hex"])
_RUN = re.compile(r"[A-Za-z0-9+/_-]{%d,}={0,2}" % BANDS[0])
_ENCODINGS = [(name, re.compile(pattern), {c: i for i, c in enumerate(alphabet)}, excess) for name, pattern, alphabet, excess in ENCODINGS]


def _at_least(runs: int, trials: int, rate: float) -> float:
    """P(a binomial count is at least `runs`): one sum in logarithms, whatever the number of trials."""
    i = np.arange(1, trials + 1)
    logs = trials * math.log1p(-rate) + np.concatenate([[0.0], np.cumsum(np.log((trials - i + 1) / i) + math.log(rate / (1 - rate)))])
    tail = logs[runs:]
    most = tail.max()
    return min(1.0, math.exp(most + math.log(float(np.exp(tail - most).sum())))) if most > -700 else 0.0


def _below(z: float) -> float:
    return 0.5 * math.erfc(-z / math.sqrt(2))


def battery(token: str) -> tuple[str, float] | None:
    """Inferred encoding and p of the token under "ordinary or structured token"; None for tokens of one class of characters.

    Each test is turned round into a test of equivalence, so that a small p speaks for randomness: chi-squared of the alphabet
    below what ordinary tokens of this length reach, more runs of character classes than ordinary tokens have (these two
    combined by Fisher's method: not words), and a lag-1 serial correlation nearer to 0 than sequences have. A token must be
    neither words nor a sequence, so the larger of the two p-values counts.
    """
    body = token.rstrip("=")
    if body.isdigit() or body.isalpha() and (body.islower() or body.isupper()):
        return None
    name, alphabet, excess = next((name, alphabet, excess) for name, pattern, alphabet, excess in [*_ENCODINGS, ("base64", _ANY, _BOTH, 2.9)] if pattern.match(token))
    codes = np.array([alphabet[c] for c in (body.lower() if name == "hex" else body)], dtype=np.int64)
    n, k = len(codes), len(alphabet)
    chi = float((np.bincount(codes, minlength=k) ** 2).sum()) * k / n - n
    p_chi = _below((chi - (k - 1 + n * excess)) / math.sqrt(2 * (k - 1 + 2 * n * excess)))
    classes = np.array([0 if c.islower() else 1 if c.isupper() else 2 if c.isdigit() else 3 for c in body])
    runs = int((classes[1:] != classes[:-1]).sum())
    p_runs = _at_least(runs, n - 1, CHANGE_RATE)
    a, b = codes[:-1] - codes[:-1].mean(), codes[1:] - codes[1:].mean()
    spread = math.sqrt(float((a * a).sum() * (b * b).sum()))
    r = abs(float((a * b).sum()) / spread) if spread else 1.0
    p_serial = _below((math.atanh(min(r, 0.999)) - math.atanh(CORRELATION)) * math.sqrt(n - 3))  # Fisher's transformation
    x = -math.log(max(p_chi, 1e-300)) - math.log(max(p_runs, 1e-300))
    return name, min(1.0, max(p_serial, math.exp(-x) * (1 + x)))


_ANY = re.compile("")
_BOTH = {c: i for i, c in enumerate(ENCODINGS[-1][2] + "-_")}


def candidates(text: str, base: list[tuple[int, int, int]]) -> list[tuple[int, int, str, int]]:
    """(start, end, stratum, grid step of -log10 p) of each token that overlaps no base span."""
    out = []
    for m in _RUN.finditer(text):
        start, end = m.span()
        if any(s < end and start < e for s, _, e in base):
            continue
        if found := battery(m[0]):
            band = max(b for b in BANDS if b <= end - start)
            out.append((start, end, f"{found[0]}:{band}", min(TOP, int(-math.log10(max(found[1], 1e-40)) * GRID))))
    return out


def find_secrets(docs: DataFrame, fdr: float = 0.01, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Spans of secrets in whole texts: columns id_col, spans array<struct<start, kind, end>> by start, then kind (order in KINDS).

    Random-looking tokens are claimed by the Benjamini-Hochberg rule at rate `fdr`, for each encoding and length band alone,
    over the tokens of all documents. p-values lie on a grid (rounded up, and none below 10 ** -30, its last step), so the rule
    needs only counts per step: at most 6 * 6 * 301 rows, whatever the input. The null model is fixed constants (ENCODINGS,
    CHANGE_RATE, CORRELATION). Texts are scanned once; only spans are kept and nothing of a document is shuffled.

    Null text counts as empty; empty text has no spans; repeated rows are scanned each for itself; null ids pass through; an
    empty table gives no rows; other columns are left out.
    """
    small_batches(docs.sparkSession)

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            base = [base_spans(t or "") for t in pdf["t"]]
            more = [candidates(t or "", b) for t, b in zip(pdf["t"], base)]
            yield pd.DataFrame({
                "id": pdf["id"],
                "base": [[{"start": s, "kind": k, "end": e} for s, k, e in b] for b in base],
                "more": [[{"start": s, "end": e, "stratum": x, "step": g} for s, e, x, g in c] for c in more],
            })

    kind = dict(docs.select(id_col).dtypes)[id_col]
    schema = f"id {kind}, base array<struct<start int, kind int, end int>>, more array<struct<start int, end int, stratum string, step int>>"
    found = settle(docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("t")).mapInPandas(scan, schema), "secrets")
    steps = found.select(F.explode("more").alias("m")).groupBy("m.stratum", "m.step").agg(F.count(F.lit(1)).alias("c"))
    least = Window.partitionBy("stratum").orderBy(F.col("step").desc()).rowsBetween(Window.unboundedPreceding, 0)
    steps = steps.withColumn("claimed", F.sum("c").over(least)).withColumn("all", F.sum("c").over(Window.partitionBy("stratum")))
    passing = steps.filter(F.pow(F.lit(10.0), -F.col("step") / GRID) * F.col("all") <= F.lit(fdr) * F.col("claimed"))
    # One row: at most 36 strata.
    rule = passing.groupBy("stratum").agg(F.min("step").alias("step")).agg(F.map_from_entries(F.collect_list(F.struct("stratum", "step"))).alias("rule"))
    limits = rule.first()[0] if rule is not None else {}
    bars = F.create_map(*[F.lit(x) for pair in sorted(limits.items()) for x in pair]) if limits else F.lit(None).cast("map<string,int>")
    claimed = F.filter("more", lambda m: F.coalesce(m["step"] >= F.element_at(bars, m["stratum"]), F.lit(False)))
    extra = F.transform(claimed, lambda m: F.struct(m["start"].alias("start"), F.lit(3).alias("kind"), m["end"].alias("end")))
    return found.select(F.col("id").alias(id_col), F.array_sort(F.concat("base", extra)).alias("spans"))


def spans_digest(found: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """Counts and strings of the spans of `find_secrets`; n_random, which the contract does not name, comes last."""
    names = F.array(*[F.lit(k) for k in KINDS])

    def joined(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", F.element_at(names, s["kind"] + 1), s["start"], s["end"])), ",")

    base = F.filter("spans", lambda s: s["kind"] < 3)
    kinds = F.transform("spans", lambda s: s["kind"])
    n = [(F.size(kinds) - F.size(F.array_remove(kinds, i))).cast("long").alias(f"n_{k}") for i, k in enumerate(KINDS)]
    return found.select(id_col, *n[:3], F.sha2(joined(base), 256).alias("base_sha256"), joined(F.col("spans")).alias("spans"), n[3])


__all__ = ["KINDS", "base_spans", "battery", "candidates", "find_secrets", "spans_digest"]
