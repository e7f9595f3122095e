"""Vectorised words of Arrow text columns: lower case, hashed to 64 bits, and their shingles.

A word is a maximal run of letters, digits and marks of any script, after lower-casing; in scripts that are written without
spaces every character is a word.
"""

from __future__ import annotations

import unicodedata

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# Blocks of the scripts that are written without spaces (Thai and Lao, Myanmar, Khmer, kana, Han and its extensions, half-width kana).
SPACELESS = ((0x0E00, 0x0EFF), (0x1000, 0x109F), (0x1780, 0x17FF), (0x3040, 0x30FF), (0x31F0, 0x31FF), (0x3400, 0x4DBF), (0x4E00, 0x9FFF), (0xF900, 0xFAFF), (0xFF66, 0xFF9F), (0x20000, 0x323AF))
_P = 0x9E3779B97F4A7C15
_INVERSE = pow(_P, -1, 2**64)
_SLICE = 1 << 20


class _Kept(dict):
    """Tables that a process makes once; they do not travel with the functions that use them."""

    def __reduce__(self):
        return _Kept, ()


_powers, _tables = _Kept(), _Kept()


def kinds() -> np.ndarray:
    """Of every code point: 0 between words, 1 in a word, 2 a word by itself."""
    if "kinds" in _tables:
        return _tables["kinds"]
    out = np.zeros(0x110000, dtype=np.uint8)
    out[: 0x323B0] = [unicodedata.category(chr(c))[0] in "LNM" for c in range(0x323B0)]
    for a, b in SPACELESS:
        out[a : b + 1] *= 2
    _tables["kinds"] = out
    return out


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64 bits that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers_to(n: int) -> tuple[np.ndarray, np.ndarray]:
    size = max(_SLICE, n)
    if size not in _powers:
        both = []
        for base in (_P, _INVERSE):
            x = np.full(size + 1, base, dtype=np.uint64)
            x[0] = 1
            both.append(np.cumprod(x))
        if size > _SLICE:
            return both[0], both[1]
        _powers[size] = (both[0], both[1])
    return _powers[size]


def text_bytes(column: pa.Array | pa.ChunkedArray, lower: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts, one after the other, and n + 1 offsets; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = pc.fill_null(column.cast(pa.large_string()), "")
    column = pc.utf8_lower(column) if lower else column
    offsets = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    if not len(column) or offsets[-1] == offsets[0]:
        return np.zeros(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    return np.frombuffer(column.buffers()[2], dtype=np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def words(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, in order, and n + 1 offsets that tell the texts apart."""
    data, offsets = text_bytes(column)
    return words_of_bytes(data, offsets)


def _runs(kind: np.ndarray, alone: np.ndarray, cuts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of words, from each place's kind, the places at which a word of one character starts, and the texts' bounds."""
    edge = np.zeros(len(kind) + 1, dtype=bool)
    edge[1:-1] = kind[1:] != kind[:-1]
    edge[0] = edge[-1] = True
    edge[cuts] = True
    edge[alone] = True
    at = np.flatnonzero(edge)
    starts, ends = at[:-1], at[1:]
    inside = kind[starts] > 0
    return starts[inside], ends[inside]


def byte_kinds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The kind of the character that each byte of UTF-8 text belongs to, and where characters of kind 2 start."""
    table = kinds()
    kind = table[np.where(data < 0x80, data, 0)]
    lead = np.flatnonzero(data >= 0xC0)
    if not len(lead):
        return kind, lead
    first = data[lead].astype(np.int64)
    more = 1 + (first >= 0xE0) + (first >= 0xF0)
    point = np.where(more == 1, first & 0x1F, np.where(more == 2, first & 0x0F, first & 0x07))
    for k in (1, 2, 3):
        has = more >= k
        point[has] = point[has] << 6 | (data[lead[has] + k] & 0x3F)
    own = table[np.minimum(point, 0x10FFFF)]
    for k in (0, 1, 2, 3):
        has = more >= k
        kind[lead[has] + k] = own[has]
    return kind, lead[own == 2]


def word_spans(text: str) -> list[tuple[int, int]]:
    """(start, end) in code points of the words of a text."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype="<u4")
    kind = kinds()[points]
    starts, ends = _runs(kind, np.flatnonzero(kind == 2), np.zeros(0, dtype=np.int64)) if len(points) else (points, points)
    return list(zip(starts.tolist(), ends.tolist()))


def words_of_bytes(data: np.ndarray, offsets: np.ndarray, head: int | None = None) -> tuple[np.ndarray, np.ndarray]:
    """As `words`, from the bytes of lower-case texts; with head, hashes of each word's first bytes."""
    if not len(data):
        return np.zeros(0, dtype=np.uint64), np.zeros(len(offsets), dtype=np.int64)
    starts, ends = _runs(*byte_kinds(data), offsets)
    ends = ends if head is None else np.minimum(ends, starts + head)
    out = np.empty(len(starts), dtype=np.uint64)
    i = 0
    while i < len(starts):
        j = max(i + 1, int(np.searchsorted(ends, starts[i] + _SLICE, side="right")))
        a, b = int(starts[i]), int(ends[j - 1])
        power, inverse = _powers_to(b - a)
        sums = np.zeros(b - a + 1, dtype=np.uint64)
        np.cumsum(data[a:b].astype(np.uint64) * power[: b - a], out=sums[1:])
        s, e = starts[i:j] - a, ends[i:j] - a
        out[i:j] = mix((sums[e] - sums[s]) * inverse[s] + (e - s).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
        i = j
    return out, np.searchsorted(starts, offsets)


def shingles(hashes: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of n consecutive words, in order, and offsets; a text of 1 to n - 1 words has one shingle of all its words."""
    counts = np.diff(offsets)
    each = np.where(counts >= n, counts - n + 1, np.minimum(counts, 1))
    out_offsets = np.concatenate([[0], np.cumsum(each)])
    at = np.repeat(offsets[:-1] - out_offsets[:-1], each) + np.arange(out_offsets[-1])
    last = np.repeat(offsets[1:], each)
    sums = np.zeros(len(at), dtype=np.uint64)
    padded = np.concatenate([hashes, np.zeros(n, dtype=np.uint64)])
    for k in range(n):
        sums += np.where(at + k < last, padded[at + k], np.uint64(0)) * np.uint64(pow(_P, 2 * k + 3, 2**64))
    return mix(sums), out_offsets
