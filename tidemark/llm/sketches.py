"""Fast similarity sketches of sets of 64-bit hashes: rounds of hashed bins until every coordinate is filled."""

from __future__ import annotations

import numpy as np

from tidemark.llm import words

PLACE_BITS = 48  # of an entry: the round above, the value inside the round below


def round_seeds(t: int) -> np.ndarray:
    return np.random.default_rng(1212).integers(1, 2**63, 2 * t, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def sketches(values: np.ndarray, bounds: np.ndarray, t: int) -> np.ndarray:
    """
    t entries for each row of distinct hashes (rows without any keep the largest value). t is a power of two.

    In round i each element is hashed to a bin and a value, and a bin keeps the least (i, value) that came to it; in the
    first t rounds any bin may be hit, in the last t rounds round t + j hits bin j only, so every bin is filled after 2 t
    rounds. A row stops after the round that fills its last bin, for a set of t ln t elements or more usually the first. Two
    sets agree in a coordinate with the chance of their Jaccard similarity, and the share of such coordinates is
    concentrated about as for t independent MinHash values, for a fraction of the hashing.
    """
    rows = len(bounds) - 1
    out = np.full(rows * t, np.iinfo(np.uint64).max, np.uint64)
    active = np.flatnonzero(np.diff(bounds) > 0)
    own, owner = values, np.repeat(np.arange(rows), np.diff(bounds))
    bits = np.uint64(64 - int(t).bit_length() + 1)
    for i, seed in enumerate(round_seeds(t)):
        hashed = words.mix((own ^ seed) * seed)
        entry = (np.uint64(i) << np.uint64(PLACE_BITS)) | (hashed & np.uint64((1 << PLACE_BITS) - 1))
        bin_ = (hashed >> bits).astype(np.int64) if i < t else i - t
        np.minimum.at(out, owner * t + bin_, entry)
        full = (out.reshape(rows, t)[active] != np.iinfo(np.uint64).max).all(axis=1)
        if full.any():
            active = active[~full]
            if not len(active):
                break
            waiting = np.zeros(rows, bool)
            waiting[active] = True
            keep = waiting[owner]
            own, owner = own[keep], owner[keep]
    return out.reshape(rows, t)


def band_keys(sketch: np.ndarray, rows: int) -> np.ndarray:
    """A hash of each ``rows`` neighbouring entries and of their band's number."""
    parts = sketch.reshape(len(sketch), sketch.shape[1] // rows, rows)
    keys = np.broadcast_to(np.arange(parts.shape[1], dtype=np.uint64) + np.uint64(1), parts.shape[:2])
    for j in range(rows):
        keys = words.mix(keys * np.uint64(0x9E3779B97F4A7C15) ^ parts[:, :, j])
    return keys


def short(sketch: np.ndarray) -> np.ndarray:
    """One byte an entry: equal entries have equal bytes, others with chance 1/256."""
    return (words.mix(sketch) >> np.uint64(56)).astype(np.uint8)
