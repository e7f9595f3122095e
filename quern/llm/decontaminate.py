"""Benchmark decontamination: CGK embedding of item-sized windows, bit-sampling LSH, exact edit verification."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StructField, StructType

from .common import small_batches
from .words import mix, shingles, word_spans, words

LEAK = StructType([StructField(x, LongType()) for x in ("item_id", "edits", "start_char", "end_char", "start_word", "n_words")])
_PAD = np.uint64(0)


@dataclass
class ItemClass:
    """Items of one length in words. A window that holds one of them within `edits` edits has at least `least` of their q-grams."""

    length: int
    edits: int
    q: int
    least: int
    ids: list[int] = field(default_factory=list)
    words: list[np.ndarray] = field(default_factory=list)
    grams: np.ndarray = field(default_factory=lambda: np.zeros(0, dtype=np.uint64))
    bits: int = 1
    repetitions: int = 1
    #: For each repetition: sorted bucket keys of the items, and which item each belongs to.
    tables: list[tuple[np.ndarray, np.ndarray]] = field(default_factory=list)


def item_class(length: int, max_edits: float) -> ItemClass:
    """By the q-gram lemma, k edits destroy at most k * q of n - q + 1 q-grams; q is the largest of 3, 2, 1 that leaves some."""
    edits = int(max_edits * length)
    q = next(q for q in (3, 2, 1) if length - q + 1 - edits * q >= 1 or q == 1)
    return ItemClass(length, edits, q, max(1, length - q + 1 - edits * q))


def _steps(length: int, bits: int, repetition: int, seed: int) -> tuple[np.ndarray, set[int]]:
    """Of a repetition: a multiplier for each of 3 * length steps of the walk, and the steps that are sampled."""
    base = np.uint64((seed * 1_000_003 + repetition) % 2**32 << 20)
    odd = mix(base + np.arange(1, 3 * length + 1, dtype=np.uint64)) | np.uint64(1)
    draw = np.random.default_rng([seed, repetition, length])
    # A walk advances at every second step, so it is at the end after some 2 * length of them.
    return odd, {int(x) for x in draw.choice(2 * length, size=min(bits, 2 * length), replace=False)}


def cgk_keys(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, length: int, bits: int, repetition: int, seed: int) -> np.ndarray:
    """Bucket keys of the windows data[start : end] of up to `length` words.

    The walk writes the word under its pointer and advances by a random bit of (step, word); past the end it writes padding.
    Strings a few edits apart fall into step again and differ in few places of what is written. The key is made of sampled places.
    """
    odd, sampled = _steps(length, bits, repetition, seed)
    at, key = starts.copy(), np.full(len(starts), repetition + 1, dtype=np.uint64)
    for j in range(max(sampled) + 1):
        inside = at < ends
        word = np.where(inside, data[np.minimum(at, len(data) - 1)], _PAD)
        if j in sampled:
            key = mix(key * np.uint64(0x9E3779B97F4A7C15) + word)
        at = at + (inside & ((word * odd[j] >> np.uint64(63)) > 0))
    return key


def repetitions_for(c: ItemClass, bits: int, recall: float, seed: int, trials: int = 300, many: int = 64) -> tuple[int, int]:
    """(places sampled, repetitions) after which strings c.edits random edits apart have met in a bucket with frequency `recall`, by trial.

    Walks over long strings with many edits are seldom in step; if `bits` places need more than `many` repetitions, fewer are sampled.
    """
    if not c.edits:
        return bits, 1
    draw = np.random.default_rng([seed, c.length])
    base, near = [], []
    for _ in range(trials):
        x = list(draw.integers(1, 2**63, size=c.length))
        base.append(np.array(x, dtype=np.uint64))
        for _ in range(c.edits):
            kind, i = int(draw.integers(3)), int(draw.integers(max(1, len(x))))
            x[i : i + (kind != 0)] = [] if kind == 1 else [int(draw.integers(1, 2**63))]
        near.append(np.array(x, dtype=np.uint64))
    both = [np.concatenate(v) for v in (base, near)]
    spans = [np.concatenate([[0], np.cumsum([len(x) for x in v])]) for v in (base, near)]
    met, r = np.zeros(trials, dtype=bool), 0
    while met.mean() < recall:
        if r == many and bits > 1:
            return repetitions_for(c, bits - 1, recall, seed, trials, many)
        keys = [cgk_keys(v, s[:-1], np.minimum(s[1:], s[:-1] + c.length), c.length, bits, r, seed) for v, s in zip(both, spans)]
        met |= keys[0] == keys[1]
        r += 1
    return bits, r


def prepare(items: list[tuple[int, str]], max_edits: float, bits: int, recall: float, seed: int) -> list[ItemClass]:
    hashes, cuts = words(pa.array([t for _, t in items], pa.string()))
    classes: dict[int, ItemClass] = {}
    for i, (item_id, _) in enumerate(items):
        own = hashes[cuts[i] : cuts[i + 1]]
        if len(own):
            c = classes.setdefault(len(own), item_class(len(own), max_edits))
            c.ids.append(item_id)
            c.words.append(own)
    for c in classes.values():
        lens = np.arange(len(c.ids) + 1) * c.length
        flat = np.concatenate(c.words)
        c.grams = np.unique(shingles(flat, lens, c.q)[0])
        c.bits, c.repetitions = repetitions_for(c, bits, recall, seed)
        for r in range(c.repetitions):
            keys = cgk_keys(flat, lens[:-1], lens[1:], c.length, c.bits, r, seed)
            order = np.argsort(keys, kind="stable")
            c.tables.append((keys[order], order))
    return sorted(classes.values(), key=lambda c: c.length)


def best_match(item: np.ndarray, text: np.ndarray) -> tuple[int, int, int]:
    """(edits, start, end) of the part of text nearest to item by edit distance on words; of equals, the first end, then the shortest."""

    def ends(a: np.ndarray, b: np.ndarray, free: bool) -> np.ndarray:
        steps = np.arange(len(b) + 1)
        row = np.zeros(len(b) + 1, dtype=np.int64) if free else steps.copy()
        for i, x in enumerate(a):
            new = np.empty_like(row)
            new[0] = i + 1
            new[1:] = np.minimum(row[1:] + 1, row[:-1] + (b != x))
            row = np.minimum.accumulate(new - steps) + steps
        return row

    last = ends(item, text, True)
    end = int(np.argmin(last))
    back = ends(item[::-1], text[:end][::-1], False)
    return int(last[end]), end - int(np.argmin(back)), end


def among(values: np.ndarray, few: np.ndarray) -> np.ndarray:
    """np.isin for many hashes and few to look for: a table of their top 20 bits first."""
    table = np.zeros(1 << 20, dtype=bool)
    table[few >> np.uint64(44)] = True
    out = table[values >> np.uint64(44)]
    at = np.flatnonzero(out)
    out[at] = np.isin(values[at], few)
    return out


def find_leaks(hashes: np.ndarray, cuts: np.ndarray, classes: list[ItemClass], seed: int) -> list[tuple[int, int, int, int, int]]:
    """(text, item id, edits, first word, words) of the best place of every item in every text that holds it."""
    if not len(hashes):
        return []
    out = []
    grams = {q: shingles(hashes, cuts, q) if q > 1 else (hashes, cuts) for q in {c.q for c in classes}}
    hits = {q: among(g, np.concatenate([c.grams for c in classes if c.q == q])) for q, (g, _) in grams.items()}
    i = 0
    while i < len(classes):
        j = i + 1
        while j < len(classes) and classes[j].q == classes[i].q and classes[j].length <= classes[i].length * 1.2 + 1:
            j += 1
        band, q = classes[i:j], classes[i].q
        i = j
        g, g_cuts = grams[q]
        # Texts that may hold an item of the band: somewhere enough q-grams of its items within the longest window.
        hit = hits[q].copy()
        hit[hit] = np.isin(g[hit], np.concatenate([c.grams for c in band]))
        sums = np.concatenate([[0], np.cumsum(hit)])
        at = np.flatnonzero(hit)
        doc = np.searchsorted(g_cuts, at, side="right") - 1
        enough = sums[np.minimum(at + band[-1].length - q + 1, g_cuts[doc + 1])] - sums[at] >= min(c.least for c in band)
        for d in np.unique(doc[enough]):
            a, b = int(cuts[d]), int(cuts[d + 1])
            ga, gb = int(g_cuts[d]), int(g_cuts[d + 1])
            spots = np.flatnonzero(hit[ga:gb])
            for c in band:
                mine = np.zeros(gb - ga + 1, dtype=np.int64)
                mine[spots + 1] = np.isin(g[ga + spots], c.grams)
                mine = np.cumsum(mine)
                starts = np.arange(b - a)
                lo, hi = np.minimum(starts, gb - ga), np.minimum(starts + c.length - q + 1, gb - ga)
                starts = np.flatnonzero(mine[hi] - mine[lo] >= c.least)
                if len(starts):
                    out += [(int(d), *x) for x in _search(hashes[a:b], starts, c, seed)]
    return out


def _search(text: np.ndarray, starts: np.ndarray, c: ItemClass, seed: int) -> list[tuple[int, int, int, int]]:
    ends, pairs = np.minimum(starts + c.length, len(text)), set()
    for r, (keys, owner) in enumerate(c.tables):
        own = cgk_keys(text, starts, ends, c.length, c.bits, r, seed)
        lo, hi = np.searchsorted(keys, own, side="left"), np.searchsorted(keys, own, side="right")
        for w in np.flatnonzero(hi > lo):
            pairs.update((int(owner[k]), int(starts[w])) for k in range(lo[w], hi[w]))
    found: dict[int, tuple[int, int, int]] = {}
    reach: dict[int, int] = {}
    for item, start in sorted(pairs):
        if start < reach.get(item, 0):
            continue  # inside what was just verified
        a, b = max(0, start - c.edits), min(len(text), start + 2 * c.length + 2 * c.edits)
        reach[item] = start + c.length
        edits, first, end = best_match(c.words[item], text[a:b])
        if edits <= c.edits and end > first:
            found[item] = min(found.get(item, (edits, a + first, end - first)), (edits, a + first, end - first))
    return [(c.ids[item], *x) for item, x in found.items()]


def mark_leaks(
    docs: DataFrame, items: DataFrame, max_edits: float = 0.2, recall: float = 0.99, bits: int = 2, seed: int = 11, item_block: int = 5_000,
    text_col: str = "text", item_id: str = "item_id", item_text: str = "text",
) -> DataFrame:
    """docs with `leaks`, the benchmark items that the text holds within max_edits (share of the item's words), each at its best place.

    leaks is array<struct<item_id, edits, start_char, end_char, start_word, n_words>>, sorted; code points, end exclusive.

    Windows of an item's length start at every word. Windows that provably hold no item (too few of the items' q-grams) are
    passed over; the others are embedded by the CGK walk, hashed by sampled places, and looked up among the items of their
    length, with other random bits each time, as often as trials on random edits need for the target recall at the largest
    number of edits. Items met are verified by exact edit distance on words around the window.

    Items travel with the tasks in blocks of item_block, so their number is not bound; texts stay where they are.

    Null text counts as empty; empty texts and items without words match nothing; items that repeat a text are all reported;
    null item ids are left out; all columns and repeated rows stay (a column `leaks` is replaced); empty tables give no leaks.
    """
    small_batches(docs.sparkSession)
    clean = items.filter(F.col(item_id).isNotNull() & F.col(item_text).isNotNull()).select(F.col(item_id).cast("long").alias("id"), F.col(item_text).alias("t"))
    n_blocks = max(1, -(-clean.count() // item_block))
    out = docs.drop("leaks").withColumn("leaks", F.array().cast(ArrayType(LEAK)))
    for block in range(n_blocks):
        rows = clean.filter(F.pmod(F.xxhash64("id", "t"), F.lit(n_blocks)) == block).collect()
        classes = prepare(sorted((r[0], r[1]) for r in rows), max_edits, bits, recall, seed)
        shared = docs.sparkSession.sparkContext.broadcast(classes)

        def mark(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                column = batch.column(text_col)
                leaks: list[list[dict]] = batch.column("leaks").to_pylist()
                if shared.value:
                    spans: dict[int, list[tuple[int, int]]] = {}
                    for d, item, edits, first, n in find_leaks(*words(column), shared.value, seed):
                        if d not in spans:
                            spans[d] = word_spans(column[d].as_py())
                        leaks[d].append({"item_id": item, "edits": edits, "start_char": spans[d][first][0], "end_char": spans[d][first + n - 1][1], "start_word": first, "n_words": n})
                i = batch.schema.get_field_index("leaks")
                marked = pa.array([sorted(x, key=lambda e: tuple(e.values())) for x in leaks], pa.list_(pa.struct([(f.name, pa.int64()) for f in LEAK])))
                yield pa.RecordBatch.from_arrays([marked if k == i else c for k, c in enumerate(batch.columns)], batch.schema.names)

        out = out.mapInArrow(mark, out.schema)
    return out
