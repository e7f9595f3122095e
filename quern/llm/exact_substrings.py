"""Suffix-array de-duplication: bytes covered by strings that also start in a document with a smaller id are removed."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.shared import mark, shared_path, sweep
from .common import settle, small_batches
from .suffixes import permuted_common_prefixes, suffix_array
from .words import mix, text_bytes

#: Bytes of the grams whose least hash anchors a window, a multiple of 8. Shorter ones occur by chance in more documents, whose
#: windows then are sorted in vain; longer ones leave less room to choose from, so that windows share fewer anchors.
GRAM = 24
_SLICE = 1 << 16
_A, _B = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)


def _eights(data: np.ndarray) -> np.ndarray:
    """The 8 bytes from each place on, as an integer."""
    x = data.astype(np.uint64)
    for k in (1, 2, 4):
        x = x[:-k] | x[k:] << np.uint64(8 * k)
    return x


def segments(data: np.ndarray, offsets: np.ndarray, length: int) -> dict[str, np.ndarray]:
    """Windows of `length` bytes inside the texts, joined into segments: runs of windows with the same anchor.

    A window's anchor is its GRAM-byte gram with the least hash, the leftmost of equals, so equal windows have equal anchors
    wherever they lie. Returns for each segment its text, first window, number of windows, anchor hash and content hash.
    """
    parts: list[tuple[np.ndarray, ...]] = []
    n, span = len(data), length - GRAM + 1
    # Past the end of its text no window starts.
    room = np.repeat(offsets[1:], np.diff(offsets)) - np.arange(n) >= length
    for a in range(0, n - length + 1, _SLICE):
        b = min(a + _SLICE, n - length + 1)
        p = np.flatnonzero(room[a:b])
        if not len(p):
            continue
        eight = _eights(np.concatenate([data[a : b + length - 1], np.zeros(8, dtype=np.uint8)]))
        n_grams = b - a + span - 1
        grams = eight[:n_grams] * _A
        for k in range(8, GRAM, 8):
            grams = mix(grams + eight[k : k + n_grams] * _B) * _A
        grams = mix(grams)
        key = (grams >> np.uint64(32)) << np.uint64(32) | np.arange(len(grams), dtype=np.uint64)
        width = 1
        while width * 2 <= span:
            key = np.minimum(key[:-width], key[width:])
            width *= 2
        if width < span:
            key = np.minimum(key[: len(key) - (span - width)], key[span - width :])
        anchor = (key[p] & np.uint64(0xFFFFFFFF)).astype(np.int64)
        first = np.flatnonzero(np.concatenate([[True], (p[1:] != p[:-1] + 1) | (anchor[1:] != anchor[:-1])]))
        count = np.diff(np.concatenate([first, [len(p)]]))
        start, end = p[first], p[first] + count + length - 1
        content = mix((end - start).astype(np.uint64) * _B)
        for k in range(0, 2 * length, 8):
            content = mix(content * _A + eight[np.minimum(start + k, end - 8)])
        parts.append((start + a, count, grams[anchor[first]], content))
    if not parts:
        none = np.zeros(0, dtype=np.int64)
        return {"text": none, "start": none, "count": none, "anchor": none.astype(np.uint64), "content": none.astype(np.uint64)}
    start, count, anchor, content = (np.concatenate(x) for x in zip(*parts))
    return {"text": np.searchsorted(offsets, start, side="right") - 1, "start": start, "count": count, "anchor": anchor, "content": content}


def _runs(flags: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.concatenate([flags[:1] | True, flags[1:]])) if len(flags) else np.zeros(0, dtype=np.int64)


def _ends(first: np.ndarray, n: int) -> np.ndarray:
    """Where the runs that begin at `first` end."""
    return np.concatenate([first[1:], [n]]) if len(first) else first


def _slices(starts: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """start, start + 1, ... for each pair, one after the other."""
    ends = np.cumsum(counts)
    return np.repeat(starts - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)


def anchors_of_chunk(data: np.ndarray, offsets: np.ndarray, ids: np.ndarray, length: int, shards: int, size: int) -> tuple[dict[str, np.ndarray], np.ndarray, np.ndarray, np.ndarray]:
    """Segments of a chunk; its distinct anchors (top `size` bytes) by shard, then value; each one's shard; and whether two ids hold it."""
    seg = segments(data, offsets, length)
    seg["short"] = seg["anchor"] >> np.uint64(64 - 8 * size)
    seg["shard"] = (mix(seg["short"]) % np.uint64(shards)).astype(np.int64)
    order = np.lexsort((ids[seg["text"]], seg["short"], seg["shard"]))
    short, own = seg["short"][order], ids[seg["text"]][order]
    first = _runs(np.concatenate([[True], short[1:] != short[:-1]])[: len(short)])
    last = np.concatenate([first[1:], [len(short)]]) - 1 if len(first) else first
    return seg, short[first], seg["shard"][order][first], own[first] != own[last] if len(first) else np.zeros(0, dtype=bool)


def _pack(values: np.ndarray, size: int) -> bytes:
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :size].tobytes()


def _unpack(blob: bytes, size: int) -> np.ndarray:
    raw = np.frombuffer(blob, dtype=np.uint8).reshape(-1, size)
    out = np.zeros((len(raw), 8), dtype=np.uint8)
    out[:, :size] = raw
    return out.view("<u8").ravel()


def repeated_anchors(pdf: pd.DataFrame, size: int) -> pd.DataFrame:
    """Of one shard: for each chunk, which of its anchors a second id holds, in this chunk or any other."""
    own = [_unpack(a, size) for a in pdf["anchors"]]
    twice = [np.unpackbits(np.frombuffer(t, dtype=np.uint8), count=len(a)).astype(bool) for t, a in zip(pdf["twice"], own)]
    _, place, seen = np.unique(np.concatenate(own), return_inverse=True, return_counts=True)
    often = seen > 1
    often[place[np.concatenate(twice)]] = True
    answers = np.split(often[place], np.cumsum([len(a) for a in own])[:-1])
    return pd.DataFrame({"chunk": pdf["chunk"].to_numpy(), "shard": pdf["shard"].to_numpy(), "often": [np.packbits(x).tobytes() for x in answers]})


def distinct_segments(seg: dict[str, np.ndarray], ids: np.ndarray, often: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Of the segments flagged `often`: their indices by shard, then content; where each distinct one begins; its smallest id."""
    at = np.flatnonzero(often)
    order = at[np.lexsort((ids[seg["text"][at]], seg["content"][at], seg["shard"][at]))]
    content = seg["content"][order]
    first = _runs(np.concatenate([[True], content[1:] != content[:-1]])[: len(content)])
    return order, first, ids[seg["text"][order[first]]]


def smallest_ids(content: np.ndarray, anchors: np.ndarray, data: np.ndarray, counts: np.ndarray, ids: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For segments (content hash, anchor, bytes one after the other, windows, smallest id): the smallest id of any segment that holds each window.

    Returns each segment's place among the distinct ones, and for those runs of windows with the same answer: (runs before
    each), first windows, ids. Where all segments of an anchor have one content, its windows occur nowhere else.
    """
    lens = counts + length - 1
    begins = np.cumsum(lens) - lens
    _, first, place = np.unique(content, return_index=True, return_inverse=True)
    least = np.full(len(first), np.iinfo(np.int64).max)
    np.minimum.at(least, place, ids)
    _, of, variants = np.unique(anchors[first], return_inverse=True, return_counts=True)
    mixed = np.flatnonzero(variants[of] > 1)
    n_runs = np.ones(len(first), dtype=np.int64)
    if len(mixed):
        own = first[mixed]
        joined = data[_slices(begins[own], lens[own])]
        before, windows, best = sorted_windows(joined, counts[own], least[mixed], length)
        n_runs[mixed] = np.diff(before)
    all_before = np.concatenate([[0], np.cumsum(n_runs)])
    all_windows, all_best = np.zeros(all_before[-1], dtype=np.int64), np.repeat(least, n_runs)
    if len(mixed):
        at = _slices(all_before[mixed], n_runs[mixed])
        all_windows[at], all_best[at] = windows, best
    return place, all_before, all_windows, all_best


def sorted_windows(data: np.ndarray, n_windows: np.ndarray, least: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs (before each segment, first windows, ids) of distinct segments: the smallest id of the segments that hold each window.

    The segments are joined to one string, separated, whose suffix array brings equal windows together: neighbours share
    `length` bytes by the permuted common prefixes.
    """
    size = n_windows + length - 1
    starts = np.cumsum(size + 1) - size - 1
    s = np.zeros(int(size.sum()) + len(size) + 1, dtype=np.int32)
    s[_slices(starts, size)] = data.astype(np.int32) + 2
    s[starts + size] = 1
    windows = _slices(starts, n_windows)
    is_window = np.zeros(len(s), dtype=bool)
    is_window[windows] = True
    order = suffix_array(s, 258)
    order = order[is_window[order]]
    shared = permuted_common_prefixes(s, order, length)
    group = np.flatnonzero(np.concatenate([[True], shared < length]))
    owner = np.repeat(np.arange(len(size)), n_windows)
    at = np.zeros(len(s), dtype=np.int64)
    at[windows] = np.arange(len(windows))
    best = np.minimum.reduceat(least[owner[at[order]]], group)
    answer = np.zeros(len(windows), dtype=np.int64)
    answer[at[order]] = np.repeat(best, np.diff(np.concatenate([group, [len(order)]])))
    window_begins = np.cumsum(n_windows) - n_windows
    new = np.concatenate([[True], answer[1:] != answer[:-1]])
    new[window_begins] = True
    runs = np.flatnonzero(new)
    return np.concatenate([np.searchsorted(runs, window_begins), [len(runs)]]), runs - window_begins[owner[runs]], answer[runs]


def answers_of_shard(pdf: pd.DataFrame, length: int) -> pd.DataFrame:
    cuts = np.cumsum([len(c) // 8 for c in pdf["content"]])[:-1]
    content, anchors, counts, ids = (np.frombuffer(b"".join(pdf[c]), dtype=t) for c, t in (("content", "<u8"), ("anchors", "<u8"), ("counts", "<i8"), ("ids", "<i8")))
    place, before, windows, best = smallest_ids(content, anchors, np.frombuffer(b"".join(pdf["bytes"]), dtype=np.uint8), counts, ids, length)
    out = []
    for own in np.split(place, cuts):
        n = before[own + 1] - before[own]
        at = _slices(before[own], n)
        out.append((n.astype("<u2").tobytes(), windows[at].astype("<u2").tobytes(), best[at].astype("<i8").tobytes()))
    n, w, b = zip(*out)
    return pd.DataFrame({"chunk": pdf["chunk"].to_numpy(), "shard": pdf["shard"].to_numpy(), "n_runs": n, "windows": w, "best": b})


def remove_repeats(
    docs: DataFrame, length: int = 50, chunk_bytes: int = 1 << 20, shard_bytes: int = 3 << 20, bucket_bytes: int = 32 << 20, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """One row per document: id_col, n_bytes, n_removed, spans array<struct<start, end>> (bytes, end exclusive), kept_sha256.

    Texts are UTF-8 bytes. Every byte goes that a `length`-byte string covers which also starts in a document with a smaller
    id, in the texts as given; matches never cross documents.

    1. Texts are packed into chunks, a table bucketed by chunk, so that they never cross the network again. Buckets grow in
       number with the input, bucket_bytes each, up to the 100,000 that Spark allows.
    2. Windows that share an anchor form segments. Each shard of anchor hashes tells each chunk, in bits, which of its
       anchors occur under another id; only segments of such anchors can repeat.
    3. The distinct ones of those segments go to their anchor's shard. There a suffix array (induced sorting) and permuted
       common prefixes find, for every window, the smallest id that holds it. Equal windows have equal anchors, so no shard
       needs another. An anchor whose segments all have one content needs no sorting.
    4. Each chunk gets its answers as runs and cuts its texts.

    A chunk sends a string once, however many of its documents hold it, so a passage of a third of all documents weighs as
    much in its shard as there are chunks. Shards grow in number with the input, not in size. The result is written, and the
    tables that led to it are deleted.

    A length below GRAM is an error. Null text counts as empty; texts shorter than `length` keep all; rows with the same id never remove from each other; rows
    with a null id keep all and remove nothing; repeated rows are reported each; an empty table gives no rows; other columns
    are left out. Hashes of 64 bits stand for the distinct segments of a shard.
    """
    if length < GRAM:
        raise ValueError(f"length: {length} is less than an anchor's {GRAM} bytes")
    spark = docs.sparkSession
    small_batches(spark)
    result = "id long, n_bytes long, n_removed long, spans array<struct<start:int,end:int>>, kept_sha256 string"
    source = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).alias("t"))

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, parts, total, k = [], [], 0, 0

        def chunk() -> pa.RecordBatch:
            nonlocal ids, parts, total, k
            number = int.from_bytes(hashlib.blake2b(f"{base}:{k}".encode(), digest_size=8).digest(), "little", signed=True)
            row = [pa.array([number]), pa.array([ids], pa.list_(pa.int64())), pa.array([[len(x) for x in parts]], pa.list_(pa.int32())), pa.array([b"".join(parts)], pa.binary())]
            ids, parts, total, k = [], [], 0, k + 1
            return pa.RecordBatch.from_arrays(row, ["chunk", "ids", "sizes", "data"])

        base = uuid.uuid4().hex
        for batch in batches:
            data, offsets = text_bytes(batch.column("t"), lower=False)
            for i, own in enumerate(batch.column("id").to_pylist()):
                text = data[offsets[i] : offsets[i + 1]].tobytes()
                if total and total + len(text) > chunk_bytes:
                    yield chunk()
                ids.append(own)
                parts.append(text)
                total += len(text)
        if ids:
            yield chunk()

    start = mark(spark)
    total = docs.agg(F.sum(F.octet_length(text_col))).first()[0] or 0
    buckets = min(100_000, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-total // bucket_bytes), 1))
    path = shared_path(spark, "chunks")
    table = f"quern_chunks_{uuid.uuid4().hex}"
    source.filter("id is not null").mapInArrow(pack, "chunk long, ids array<bigint>, sizes array<int>, data binary").write.bucketBy(buckets, "chunk").option("path", path).saveAsTable(table)
    chunks = spark.table(table)
    shards = max(1, -(-total // shard_bytes))
    size = min(8, 2 + (max(total, 1).bit_length() + 7) // 8)  # so many bytes that chance hardly makes two anchors equal

    def opened(row_ids, sizes, data) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        return np.frombuffer(data.as_py(), dtype=np.uint8), np.concatenate([[0], np.cumsum(np.array(sizes.as_py(), dtype=np.int64))]), np.array(row_ids.as_py(), dtype=np.int64)

    def send_anchors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, *row in zip(*(batch.column(c) for c in ("chunk", "ids", "sizes", "data"))):
                data, offsets, ids = opened(*row)
                _, anchors, shard, twice = anchors_of_chunk(data, offsets, ids, length, shards, size)
                first = _runs(np.concatenate([[True], shard[1:] != shard[:-1]])[: len(shard)])
                blobs = [(_pack(anchors[i:j], size), np.packbits(twice[i:j]).tobytes()) for i, j in zip(first, _ends(first, len(shard)))]
                yield pa.RecordBatch.from_arrays([pa.array([number.as_py()] * len(first), pa.int64()), pa.array(shard[first], pa.int64()), pa.array([b[0] for b in blobs], pa.binary()), pa.array([b[1] for b in blobs], pa.binary())], ["chunk", "shard", "anchors", "twice"])

    sent = chunks.mapInArrow(send_anchors, "chunk long, shard long, anchors binary, twice binary")
    often = settle(sent.groupBy("shard").applyInPandas(lambda pdf: repeated_anchors(pdf, size), "chunk long, shard long, often binary"), "anchors")
    often = often.groupBy("chunk").agg(F.collect_list(F.struct("shard", "often")).alias("often")).hint("shuffle_hash")

    def reopened(batch: pa.RecordBatch) -> Iterator[tuple]:
        for number, row_ids, sizes, blob, flags in zip(*(batch.column(c) for c in ("chunk", "ids", "sizes", "data", "often"))):
            data, offsets, ids = opened(row_ids, sizes, blob)
            seg, anchors, shard, _ = anchors_of_chunk(data, offsets, ids, length, shards, size)
            known = np.zeros(len(anchors), dtype=bool)
            for f in flags.as_py() or []:
                a, b = np.searchsorted(shard, [f["shard"], f["shard"] + 1])
                known[a:b] = np.unpackbits(np.frombuffer(f["often"], dtype=np.uint8), count=b - a)
            order = np.argsort(anchors, kind="stable")
            flagged = known[order][np.searchsorted(anchors[order], seg["short"])] if len(anchors) else np.zeros(0, dtype=bool)
            yield number.as_py(), data, offsets, ids, seg, *distinct_segments(seg, ids, flagged)

    def send_segments(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for number, data, _, _, seg, order, first, least in reopened(batch):
                mine = order[first]
                lens = seg["count"][mine] + length - 1
                shard = seg["shard"][mine]
                begin = _runs(np.concatenate([[True], shard[1:] != shard[:-1]])[: len(shard)])
                spans = list(zip(begin, _ends(begin, len(shard))))
                bounds = np.concatenate([[0], np.cumsum(lens)])
                joined = data[_slices(seg["start"][mine], lens)].tobytes()
                words = [x.tobytes() for x in (seg["content"][mine].astype("<u8"), seg["anchor"][mine].astype("<u8"), seg["count"][mine].astype("<i8"), least.astype("<i8"))]
                columns = [pa.array([w[8 * i : 8 * j] for i, j in spans], pa.binary()) for w in words]
                columns.append(pa.array([joined[bounds[i] : bounds[j]] for i, j in spans], pa.binary()))
                yield pa.RecordBatch.from_arrays([pa.array([number] * len(begin), pa.int64()), pa.array(shard[begin], pa.int64()), *columns], ["chunk", "shard", "content", "anchors", "counts", "ids", "bytes"])

    flagged = chunks.join(often, "chunk", "left")
    sent = flagged.mapInArrow(send_segments, "chunk long, shard long, content binary, anchors binary, counts binary, ids binary, bytes binary")
    answers = settle(sent.groupBy("shard").applyInPandas(lambda pdf: answers_of_shard(pdf, length), "chunk long, shard long, n_runs binary, windows binary, best binary"), "answers")
    answers = answers.groupBy("chunk").agg(F.sort_array(F.collect_list(F.struct("shard", "n_runs", "windows", "best"))).alias("answers")).hint("shuffle_hash")

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for (_, data, offsets, ids, seg, order, first, _), got in zip(reopened(batch), batch.column("answers")):
                cover = np.zeros(len(data) + 1, dtype=np.int32)
                rows = got.as_py() or []
                n_runs, windows = (np.frombuffer(b"".join(r[c] for r in rows), dtype="<u2").astype(np.int64) for c in ("n_runs", "windows"))
                best = np.frombuffer(b"".join(r["best"] for r in rows), dtype="<i8")
                if len(order):
                    of = np.repeat(np.arange(len(first)), np.diff(np.concatenate([first, [len(order)]])))
                    before = np.cumsum(n_runs) - n_runs
                    at = _slices(before[of], n_runs[of])
                    s = np.repeat(order, n_runs[of])
                    stop = np.concatenate([windows[1:], [0]])
                    last = np.cumsum(n_runs) - 1
                    stop[last] = seg["count"][order[first]]
                    gone = best[at] < ids[seg["text"][s]]
                    begin, end = (seg["start"][s] + windows[at])[gone], (seg["start"][s] + stop[at] + length - 1)[gone]
                    np.add.at(cover, begin, 1)
                    np.add.at(cover, end, -1)
                removed = np.cumsum(cover[:-1]) > 0
                rise = removed.copy()
                rise[1:] &= ~removed[:-1]
                fall = removed.copy()
                fall[:-1] &= ~removed[1:]
                inner = offsets[:-1][np.diff(offsets) > 0]
                rise[inner] |= removed[inner]
                fall[inner[1:] - 1] |= removed[inner[1:] - 1]
                begins, ends = np.flatnonzero(rise), np.flatnonzero(fall) + 1
                cuts = np.searchsorted(begins, offsets)
                spans, shas = [], []
                for i in range(len(ids)):
                    a, b = offsets[i], offsets[i + 1]
                    own = slice(cuts[i], cuts[i + 1])
                    spans.append([{"start": int(x - a), "end": int(y - a)} for x, y in zip(begins[own], ends[own])])
                    shas.append(hashlib.sha256(data[a:b][~removed[a:b]] if spans[-1] else data[a:b]).hexdigest())
                total = np.concatenate([[0], np.cumsum(removed)])
                yield pd.DataFrame({"id": ids, "n_bytes": np.diff(offsets), "n_removed": total[offsets[1:]] - total[offsets[:-1]], "spans": spans, "kept_sha256": shas})

    def cut_arrow(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        schema = pa.schema([("id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("spans", pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))), ("kept_sha256", pa.string())])
        for pdf in cut(batches):
            yield pa.RecordBatch.from_pandas(pdf, schema=schema, preserve_index=False)

    known = flagged.join(answers, "chunk", "left").mapInArrow(cut_arrow, result)
    text = F.coalesce("t", F.lit(""))
    unnamed = source.filter("id is null").select("id", F.octet_length(text).cast("long").alias("n_bytes"), F.lit(0).cast("long").alias("n_removed"), F.array().cast("array<struct<start:int,end:int>>").alias("spans"), F.sha2(text, 256).alias("kept_sha256"))
    out = settle(known.unionByName(unnamed).withColumnRenamed("id", id_col), "unrepeated")
    spark.sql(f"DROP TABLE {table}")
    sweep(spark, start, keep=out)
    return out
