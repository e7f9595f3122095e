"""Suffix arrays by induced sorting and permuted common prefixes, vectorised over buckets."""

from __future__ import annotations

import numpy as np


#: So many names are sorted bucket by bucket as they are.
FEW = 1024


def classify(s: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which suffixes are smaller than their successor (S-type), and the leftmost of each run of them (LMS)."""
    n = len(s)
    differs = np.flatnonzero(np.concatenate([s[1:] != s[:-1], [True]]))
    nxt = differs[np.searchsorted(differs, np.arange(n))]  # last place of each run of equal symbols
    small = np.ones(n, dtype=bool)
    inner = nxt < n - 1
    small[inner] = s[nxt[inner]] < s[nxt[inner] + 1]
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    return small, lms


def induce(s: np.ndarray, small: np.ndarray, lms: np.ndarray, sigma: int) -> np.ndarray:
    """All suffixes in the order that the given order of the LMS suffixes induces.

    Left to right, each suffix puts its L-type predecessor at the head of that one's bucket; then right to left for S-types at
    the tails. A bucket is done at once, in waves: what the bucket puts into itself is its next wave.
    """
    n, s = len(s), s.astype(np.uint16 if sigma <= 1 << 16 else np.int64)
    counts = np.bincount(s, minlength=sigma)
    ends = np.cumsum(counts)
    starts = ends - counts
    n_large = np.bincount(s[~small], minlength=sigma)
    sa = np.full(n, -1, dtype=np.int32)
    steps = np.arange(n)

    def put(before: np.ndarray, free: np.ndarray, step: int) -> None:
        """Places `before`, in their order, from the free ends of their symbols' buckets on, upward or downward."""
        symbols = s[before]
        order = np.argsort(symbols, kind="stable")  # radix sort: symbols are of 16 bits
        many = np.bincount(symbols, minlength=sigma)
        first = many.cumsum()
        first -= many
        if step > 0:
            sa[(free - first)[symbols[order]] + steps[: len(order)]] = before[order]
            free += many
        else:
            sa[(free + first - 1)[symbols[order]] - steps[: len(order)]] = before[order]
            free -= many

    seeds = np.bincount(s[lms], minlength=sigma)
    put(lms, ends - seeds, 1)

    used = np.flatnonzero(counts)
    heads = starts.copy()
    for c in used:
        done, large_end = starts[c], starts[c] + n_large[c]
        while True:
            wave = sa[done : heads[c]] if done < large_end else sa[ends[c] - seeds[c] : ends[c]]
            last = done >= large_end
            done = heads[c] if not last else done
            before = wave[wave > 0] - 1
            before = before[~small[before]]
            if len(before):
                put(before, heads, 1)
            if last:
                break
            if done == heads[c]:
                done = large_end
    for c in used:  # the seeds have done their part
        sa[starts[c] + n_large[c] : ends[c]] = -1
    sa[0] = n - 1  # the end has no successor that would put it
    tails = ends.copy()
    for c in used[::-1]:
        done, large_end = ends[c], starts[c] + n_large[c]
        while True:
            last = done <= large_end
            wave = (sa[starts[c] : large_end] if last else sa[tails[c] : done])[::-1]
            done = tails[c] if not last else done
            before = wave[wave > 0] - 1
            before = before[small[before]]
            if len(before):
                put(before, tails, -1)
            if last:
                break
            if done == tails[c]:
                done = large_end
    return sa


def _pieces(s: np.ndarray, lms: np.ndarray) -> np.ndarray:
    """A hash of each LMS substring: from one LMS place to the next, both included."""
    power, inverse = (np.full(len(s) + 1, base, dtype=np.uint64) for base in (0x9E3779B97F4A7C15, pow(0x9E3779B97F4A7C15, -1, 2**64)))
    power[0] = inverse[0] = 1
    power, inverse = np.cumprod(power), np.cumprod(inverse)
    sums = np.concatenate([np.zeros(1, dtype=np.uint64), np.cumsum((s + 1).astype(np.uint64) * power[:-1])])
    ends = np.concatenate([lms[1:] + 1, [len(s)]])
    x = (sums[ends] - sums[lms]) * inverse[lms]
    x = (x ^ x >> np.uint64(29)) * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (ends - lms).astype(np.uint64) * np.uint64(0x94D049BB133111EB)


def suffix_array(s: np.ndarray, sigma: int) -> np.ndarray:
    """Suffix array of s, whose symbols are below sigma; its last symbol is its smallest and occurs once.

    LMS substrings are sorted by induction from the text order and named by rank. Where names repeat, the string of names is
    sorted in the same way, by recursion, and its order induces that of all suffixes. Names are half of the symbols at most, in
    texts a third. As the induction goes bucket by bucket, many names are written in two digits of some sqrt(names) values,
    unless that would not make the string shorter. The recursion ends when no name repeats.
    """
    small, lms = classify(s)
    if not len(lms):
        return np.arange(len(s))[::-1].copy()
    first = induce(s, small, lms, sigma)
    is_lms = np.zeros(len(s), dtype=bool)
    is_lms[lms] = True
    sorted_lms = first[is_lms[first]]
    place = np.zeros(len(s), dtype=np.int64)
    place[lms] = np.arange(len(lms))
    piece = _pieces(s, lms)[place[sorted_lms]]
    names = np.zeros(len(lms), dtype=np.int64)
    names[place[sorted_lms]] = np.concatenate([[0], np.cumsum(piece[1:] != piece[:-1])])
    several = int(names.max()) + 1
    if several == len(names):
        return induce(s, small, lms[np.argsort(names)], sigma)
    if several <= FEW or 2 * len(names) > 0.8 * len(s):
        order = suffix_array(np.append(names + 1, 0), several + 1)[1:]
    else:
        base = int(np.ceil(np.sqrt(several)))
        digits = np.zeros(2 * len(names) + 1, dtype=np.int32)
        digits[:-1:2], digits[1::2] = names // base + 1, names % base + 1
        order = suffix_array(digits, base + 2)
        order = order[(order % 2 == 0) & (order < 2 * len(names))] // 2
    return induce(s, small, lms[order], sigma)


def permuted_common_prefixes(data: np.ndarray, order: np.ndarray, most: int) -> np.ndarray:
    """For each place in `order` but the first, how many symbols (most at most) it shares with the place before it in order.

    Computed in text order, so that memory is read forward, then carried back to the order. data must reach `most` beyond any place.
    """
    phi = np.full(len(data), -1, dtype=np.int64)
    phi[order[1:]] = order[:-1]
    at = np.flatnonzero(phi >= 0)
    before, length = phi[at], np.zeros(len(at), dtype=np.int64)
    live = np.arange(len(at))
    for k in range(most):
        live = live[data[at[live] + k] == data[before[live] + k]]
        if not len(live):
            break
        length[live] = k + 1
    out = np.zeros(len(data), dtype=np.int64)
    out[at] = length
    return out[order[1:]]
