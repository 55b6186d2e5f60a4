"""The filters of the line join on groups that leave nothing, and on pairs across blocks."""

import numpy as np

from tidemark.llm import line_dedup


def pairs(g, n, side=None, apart=False):
    g, n = np.array(g, np.int64), np.array(n, np.int64)
    side = np.zeros(len(g), np.int64) if side is None else np.array(side)
    a, b = line_dedup.filtered(g, n, np.zeros(len(g), np.int64), np.ones(len(g), np.uint64), side, np.full(len(g), apart), 0.8)
    return list(zip(a.tolist(), b.tolist(), strict=True))


def test_filters():
    assert pairs([], []) == []
    assert pairs([1, 1], [5, 50]) == []
    assert pairs([1, 2, 2, 2, 3], [6, 6, 7, 20, 6]) == [(1, 2)]
    assert pairs([4, 4, 4], [9, 9, 10], [0, 0, 1], apart=True) == [(0, 2), (1, 2)]
