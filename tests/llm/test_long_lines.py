import random

import numpy as np
import pytest

from tidemark.llm import common, line_dedup

from . import brute
from .conftest import frame, sentence


def test_unrelated_long_lines_are_no_candidates(llm, monkeypatch):
    """Bitmaps of long lines don't fill up: lines that share rare words by chance are not fetched and compared."""
    rng, counts, written = random.Random(3), {}, common.written

    def counted(df, label):
        out = written(df, label)
        counts[label] = out.count()
        return out

    texts = [sentence(rng, 150) for _ in range(80)]
    texts.append(texts[5].replace(texts[5].split()[40], "changed"))
    monkeypatch.setattr(common, "written", counted)
    rows = [(i, t, "en", "s", 0) for i, t in enumerate(texts)]
    found = {r["doc_id"]: (r["n_lines"], list(r["removed"])) for r in line_dedup.removed_lines(frame(llm, rows)).collect()}
    assert found == dict(enumerate(brute.removed_lines(list(enumerate(texts)))))
    assert found[80] == (1, [0])
    assert counts["dedup-placed"] <= 4 and counts["dedup-probes"] <= 2


@pytest.mark.parametrize("n", [3, 47, 48, 49, 64, 200])
def test_bitmaps_differ_in_no_more_bits_than_sets_in_tokens(n):
    rng = np.random.default_rng(n)
    for gone, new in ((0, 0), (1, 0), (0, 1), (2, 2), (n // 5, n // 5)):
        base = rng.integers(0, 1 << 48, n + new, dtype=np.uint64)
        sets = [np.sort(base[:n]), np.sort(base[gone:])]
        tokens, begins = np.concatenate(sets), np.array([0, n, 2 * n + new - gone])
        coarse, fine = line_dedup.bitmaps(tokens, begins)
        differ = line_dedup.differing(coarse, fine, np.diff(begins), np.array([0]), np.array([1]))
        assert differ[0] <= gone + new
