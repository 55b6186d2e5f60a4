"""Words of UTF-8 text as 64-bit hashes, made with numpy from whole Arrow buffers; shingles and MinHash values over them."""

from __future__ import annotations

import numpy as np

SLICE = 1 << 19  # bytes of text handled at once, so that the arrays stay in the cache
_RNG = np.random.default_rng(20240607)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15 | 1
_INVERSE = pow(_BASE, -1, 2**64)
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_M1, _M2, _S = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB), (np.uint64(30), np.uint64(27), np.uint64(31))

SPACE = np.zeros(256, bool)  # white space of the word pattern [^\x20\x09-\x0D]+
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def mix(x: np.ndarray) -> np.ndarray:
    """Bijection of 64-bit values that spreads every input bit."""
    x = (x ^ (x >> _S[0])) * _M1
    x = (x ^ (x >> _S[1])) * _M2
    return x ^ (x >> _S[2])


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        n = max(n, 2 * SLICE)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(n, base, np.uint64)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=np.uint64)
    return _powers[0][:n], _powers[1][:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """
    Hash of each byte span (ascending, apart): a polynomial in an odd base, taken from running sums, then mixed with the
    length. It doesn't depend on the span's place, so a long text is taken in parts, and costs no more memory than a slice.
    """
    if len(data) > 2 * SLICE and len(starts) > 1:
        out, i = np.empty(len(starts), np.uint64), 0
        while i < len(starts):
            j = max(i + 1, int(np.searchsorted(ends, starts[i] + SLICE, "right")))
            a, b = starts[i], ends[j - 1]
            out[i:j] = span_hashes(data[a:b], starts[i:j] - a, ends[i:j] - a)
            i = j
        return out
    up, down = powers(len(data) + 1)
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum(_BYTE[data] * up[: len(data)], out=sums[1:])
    return mix((sums[ends] - sums[starts]) * down[starts] + (ends - starts).astype(np.uint64))


def spans(data: np.ndarray, bounds: np.ndarray, space: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the maximal runs of non-space bytes; no run crosses a row bound."""
    inside = ~space[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.empty(len(data), bool)
    before[:1] = False
    before[1:] = inside[:-1]
    after = np.empty(len(data), bool)
    after[-1:] = False
    after[:-1] = inside[1:]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return starts, ends


def words(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the words, their start bytes, and for each row the place of its first word (one more at the end)."""
    starts, ends = spans(data, bounds)
    return span_hashes(data, starts, ends), starts, np.searchsorted(starts, bounds, "left")


_WEIGHTS = [np.uint64(int(w)) for w in _RNG.integers(1, 2**63, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)]


def shingles(hashes: np.ndarray, firsts: np.ndarray, n: int = 5, short_rows: bool = True) -> tuple[np.ndarray, np.ndarray]:
    """
    Hashes of the n-word shingles of each row and the bounds of the rows. A row of fewer words, but at least one, has one
    shingle of all its words unless ``short_rows`` is false; a row without words has none.
    """
    counts = np.diff(firsts)
    if not short_rows:
        counts = np.where(counts < n, 0, counts)
    whole = np.maximum(counts - n + 1, 0)
    if len(hashes) >= n:
        all_ = np.zeros(len(hashes) - n + 1, np.uint64)
        for j in range(n):
            all_ += hashes[j : len(hashes) - n + 1 + j] * _WEIGHTS[j]
        all_ = mix(all_)
    else:
        all_ = np.zeros(0, np.uint64)
    short = np.flatnonzero((counts > 0) & (counts < n))
    bounds = np.concatenate(([0], np.cumsum(np.where((counts > 0) & (counts < n), 1, whole))))
    rows = np.repeat(np.arange(len(counts)), whole)
    at = firsts[:-1][rows] + np.arange(len(rows)) - np.repeat(np.cumsum(whole) - whole, whole)
    if not len(short):
        return all_[at], bounds
    out = np.empty(bounds[-1], np.uint64)
    out[bounds[:-1][rows] + np.arange(len(rows)) - np.repeat(np.cumsum(whole) - whole, whole)] = all_[at]
    for row in short:
        own = hashes[firsts[row] : firsts[row + 1]]
        out[bounds[row]] = mix(np.sum(own * np.array(_WEIGHTS[5 : 5 + len(own)], np.uint64), keepdims=True))[0]
    return out, bounds


def minhash_constants(k: int) -> tuple[np.ndarray, np.ndarray]:
    rng = np.random.default_rng(77)
    return (rng.integers(0, 2**31, k, dtype=np.uint32) * np.uint32(2) + np.uint32(1)), rng.integers(0, 2**32, k, dtype=np.uint32)


def minhash(values: np.ndarray, bounds: np.ndarray, k: int) -> np.ndarray:
    """k MinHash values (32 bits) of each row that has shingles, rows without are left at the largest value."""
    out = np.full((len(bounds) - 1, k), 0xFFFFFFFF, np.uint32)
    full = np.flatnonzero(np.diff(bounds) > 0)
    if not len(full):
        return out
    low, high = values.astype(np.uint32), (values >> np.uint64(32)).astype(np.uint32)
    turned, at = np.empty_like(low), bounds[:-1][full]
    for j, (a, b) in enumerate(zip(*minhash_constants(k), strict=True)):
        np.multiply(low if j % 2 else high, a, out=turned)
        np.add(turned, b, out=turned)
        np.bitwise_xor(turned, high if j % 2 else low, out=turned)
        np.multiply(turned, a, out=turned)
        out[full, j] = np.minimum.reduceat(turned, at)
    return out


def distinct(values: np.ndarray) -> np.ndarray:
    """Sorted distinct values; numpy's own unique() is far slower on random 64-bit values."""
    values = np.sort(values)
    return values[np.concatenate(([True], values[1:] != values[:-1]))] if len(values) else values
