"""Near-duplicate components against brute force, and the sketches they rest on."""

import random
from collections import Counter, defaultdict

import numpy as np
import pytest

from tidemark.llm import near_dedup, sketches

from . import brute
from .conftest import frame, sentence
from .test_copies import variants


def lower(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def plain(rows):
    """(doc_id, n_shingles, component_id, kept) for (doc_id, text) rows."""
    sets = []
    for _, text in rows:
        words = brute.WORD.findall(lower(text))
        sets.append({tuple(words[i : i + 4]) for i in range(len(words) - 3)} if len(words) >= 4 else {tuple(words)} if words else set())
    parent, holders = list(range(len(rows))), defaultdict(list)

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, own in enumerate(sets):
        for j, k in Counter(j for s in own for j in holders[s]).items():
            if 100 * k >= 80 * (len(own) + len(sets[j]) - k):
                parent[find(i)] = find(j)
        for s in own:
            holders[s].append(i)
    order = lambda d: (d is not None, d or 0)
    smallest = {}
    for i, (d, _) in enumerate(rows):
        smallest[find(i)] = min(smallest.get(find(i), d), d, key=order)
    return sorted((str(d), len(s), str(smallest[find(i)]), d == smallest[find(i)]) for i, ((d, _), s) in enumerate(zip(rows, sets, strict=True)))


def found(spark, rows):
    made = near_dedup.components(frame(spark, [(d, t, "en", "a", 0) for d, t in rows])).collect()
    return sorted((str(r["doc_id"]), r["n_shingles"], str(r["component_id"]), r["kept"]) for r in made)


def chain(rng, n=90):
    """Texts of which each is like its neighbours only, and a crowd of copies with one change each."""
    words = sentence(rng, 120).split()
    out = []
    for i in range(n):
        words = list(words)
        words[(7 * i) % 120] = f"c{i}"
        out.append(" ".join(words))
    base = sentence(rng, 60).split()
    for i in range(n):
        own = list(base)
        for _ in range(rng.randrange(1, 3)):
            own[rng.randrange(60)] = f"x{rng.randrange(10**6)}"
        out.append(" ".join(own))
    rng.shuffle(out)
    return out


@pytest.mark.parametrize(("block", "star"), [(400, 4096), (7, 5)])
def test_components(llm, monkeypatch, block, star):
    monkeypatch.setattr(near_dedup, "BLOCK_ROWS", block)
    monkeypatch.setattr(near_dedup, "STAR_ROWS", star)
    rng = random.Random(block)
    texts = variants() + chain(rng) + [t.upper() for t in variants()[:5]]
    rows = list(enumerate(texts)) if block == 400 else [(rng.randrange(-50, 300), t) for t in texts]
    assert found(llm, rows) == plain(rows)


def test_odd_rows(llm, odd_rows, no_docs):
    rows = [(d, t) for d, t, *_ in odd_rows]
    assert found(llm, rows) == plain(rows)
    empty = near_dedup.components(no_docs)
    assert empty.columns == ["doc_id", "n_shingles", "component_id", "kept"] and empty.count() == 0


def test_short_texts(llm):
    rows = [(i, t) for i, t in enumerate(["a", "A", "a b", "b a", "a b c", "a b c d", "a b c d e", "a b c d e f", "a b c d e f g", "a b c d e f g h", "", " ", None, "a\nB  c"])]
    assert found(llm, rows) == plain(rows)


def test_sketches():
    rng = np.random.default_rng(3)
    sizes = [0, 1, 2, 5, 100, 3000]
    values = rng.integers(0, 2**63, sum(sizes), dtype=np.uint64)
    made = sketches.sketches(values, np.cumsum([0, *sizes]), 128)
    assert (made[0] == np.iinfo(np.uint64).max).all() and (made[1:] != np.iinfo(np.uint64).max).all()
    assert (made[4] >> np.uint64(sketches.PLACE_BITS) < 40).all() and (made[5] >> np.uint64(sketches.PLACE_BITS) == 0).all()
    # A row's sketch doesn't depend on the rows beside it or the order of its elements.
    alone = sketches.sketches(values[8:108][::-1].copy(), np.array([0, 100]), 128)
    assert (alone[0] == made[4]).all()
    for n, k in ((6, 5), (50, 44), (900, 800)):  # sets of n with k elements in common
        shares = []
        for _ in range(150):
            u = rng.integers(0, 2**63, 2 * n - k, dtype=np.uint64)
            two = sketches.sketches(np.concatenate((u[:n], u[n - k :])), np.array([0, n, 2 * n]), 128)
            shares.append((two[0] == two[1]).mean())
        assert abs(np.mean(shares) - k / (2 * n - k)) < 0.015 and np.std(shares) < 0.045
