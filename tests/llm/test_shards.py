import zlib

import numpy as np
import pytest

from tidemark.llm import sharding

from .conftest import frame


def least_largest(sizes, shards):
    ends = np.concatenate(([0], np.cumsum(sizes)))
    best = [0] + [10**12] * len(sizes)
    for _ in range(shards):
        best = [min(max(best[i], ends[j] - ends[i]) for i in range(j + 1)) for j in range(len(sizes) + 1)]
    return best[-1]


def test_cuts_are_minimax():
    rng = np.random.default_rng(1)
    for _ in range(300):
        sizes = rng.integers(1, 90, rng.integers(1, 25)) + (rng.random() < 0.3) * (rng.random(1)[0] < 0.5) * 200
        shards, ends = int(rng.integers(1, 7)), np.cumsum(sizes)
        capacity = sharding.smallest_capacity(ends, max(int(sizes.max()), -(-int(ends[-1]) // shards)), int(ends[-1]), shards)
        cuts = sharding.even_cuts(ends, capacity, shards)
        assert np.diff(np.concatenate(([0], cuts))).max() == capacity == least_largest(sizes, shards)


@pytest.mark.parametrize("points", [2, 7, 1000])
def test_refined_bounds_give_the_same(llm, points):
    rng = np.random.default_rng(points)
    sizes = np.concatenate((rng.integers(8, 300, 400), [3000], rng.integers(8, 40, 300))).astype(int)
    before = np.cumsum(sizes) - sizes
    groups = llm.createDataFrame([(int(s), int(b)) for s, b in zip(sizes, before, strict=True)], "size bigint, before_size bigint")
    cuts = sharding.minimax_cuts(groups, 9, points)
    assert np.diff(np.concatenate(([0], cuts))).max() == least_largest(sizes, 9)


def test_shards(odd_docs, odd_rows, no_docs):
    rows = sharding.shard(odd_docs, 4).collect()
    assert sorted((str(r["doc_id"]), r["size"], r["text_crc32"]) for r in rows) == sorted((str(d), len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for d, t, *_ in odd_rows)
    for s in {r["shard"] for r in rows}:
        assert 0 <= s < 4 and sorted(r["slot"] for r in rows if r["shard"] == s) == list(range(sum(r["shard"] == s for r in rows)))
    assert len({r["shard"] for r in rows if r["doc_id"] in (4, 5)}) == 1 and {r["law"] for r in rows} == {"bytes"}
    assert sharding.shard(no_docs).count() == 0


def test_hot_text(llm):
    docs = frame(llm, [(i, "same text" if i % 3 else f"text {i}", "en", "a", 0) for i in range(300)])
    rows = sharding.shard(docs, 6).collect()
    assert len({r["shard"] for r in rows if r["doc_id"] % 3}) == 1 and len(rows) == 300
