"""Line dedup, n-gram join and decontamination against brute force."""

import random

import numpy as np
import pyarrow as pa
import pytest

from tidemark.llm import decontaminate, groups, line_dedup, ngram_join

from . import brute
from .conftest import frame, sentence


def variants(seed=9, n=40):
    """Groups of texts at many similarities around the threshold, long and short, and hot copies."""
    rng, out = random.Random(seed), []
    for _ in range(n):
        words = sentence(rng, rng.choice([8, 30, 90, 200])).split()
        for _ in range(rng.choice([1, 2, 5])):
            own = list(words)
            for _ in range(rng.randrange(0, 4)):
                own[rng.randrange(len(own))] = f"v{rng.randrange(999)}"
            out.append(" ".join(own))
    return out + [out[0]] * 30


def key(r):
    return (r[0] is not None, r[0] or 0)


def check_join(spark, rows):
    found = ngram_join.similar(frame(spark, rows)).collect()
    want = brute.near_copies([(d, t) for d, t, *_ in rows])
    assert sorted((str(r["doc_id"]), r["n_links"], str(r["class_id"])) for r in found) == sorted((str(d), n, str(c)) for (d, *_), (n, c) in zip(rows, want, strict=True))
    return found


@pytest.mark.parametrize("block", [5, ngram_join.BLOCK_ROWS])
def test_join(llm, monkeypatch, block):
    monkeypatch.setattr(ngram_join, "BLOCK_ROWS", block)
    found = check_join(llm, [(i, t, "en", "a", 0) for i, t in enumerate(variants())])
    assert sum(r["keep"] for r in found) == len({r["class_id"] for r in found})


def test_join_odd(llm, odd_rows, no_docs):
    check_join(llm, odd_rows)
    assert ngram_join.similar(no_docs).count() == 0
    kept = ngram_join.one_of_each(frame(llm, odd_rows))
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(r["doc_id"]) for r in kept.collect() if r["doc_id"] in (4, 5, 6, 7, 8)) == ["4", "6", "7"]


def test_join_documents(llm, documents):
    check_join(llm, [(d, t, "en", "a", 0) for d, t in documents[1].items()])


def test_posterior():
    least = ngram_join.least_matches(0.8, 1e-6, 32, 128)
    rng = np.random.default_rng(0)
    lost = sum((np.cumsum((rng.random((4000, 128)) < 0.8).astype(int), axis=1)[:, 31::32] < least[1:]).any(axis=1))
    assert lost == 0 and (np.diff(least) > 0).all()
    assert ((rng.random((4000, 64)) < 0.3).sum(axis=1) < least[2]).mean() > 0.95  # dissimilar pairs go early


def test_overlaps():
    rng = np.random.default_rng(2)
    sets = [np.unique(rng.integers(0, 60, rng.integers(0, 40))).astype(np.uint64) for _ in range(50)]
    a, b = np.triu_indices(50, 1)
    want = [len(np.intersect1d(sets[i], sets[j])) for i, j in zip(a, b, strict=True)]
    assert groups.overlaps(sets, a, b).tolist() == want
    assert groups.overlaps(sets, a[:7], b[:7]).tolist() == want[:7]


def test_whole_groups():
    keys = [1, 1, 2, 3, 3, 3, 3, 4, 5, 5]
    batches = [pa.RecordBatch.from_pydict({"g": pa.array(keys[i : i + 2])}) for i in range(0, 10, 2)]
    for rows in (1, 3, 100):
        tables = list(groups.whole_groups(iter(batches), "g", rows))
        assert [k for t in tables for k in t.column("g").to_pylist()] == keys
        assert all(len({i for i, t in enumerate(tables) if k in t.column("g").to_pylist()}) == 1 for k in keys)


def test_components(llm):
    rng = random.Random(6)
    links = [(rng.randrange(80), rng.randrange(80)) for _ in range(50)] + [(i, i + 1) for i in range(100, 140)] + [(200, i) for i in range(201, 260)]
    roots = list(range(300))
    for _ in range(300):
        for a, b in links:
            roots[a] = roots[b] = min(roots[a], roots[b])
    got = {r["node"]: r["root"] for r in groups.connected(llm.createDataFrame(links, "a bigint, b bigint"), "test").collect()}
    assert got == {i: r for i, r in enumerate(roots) if r != i}


def check_lines(spark, rows):
    distinct = sorted({(d, t) for d, t, *_ in rows}, key=key)
    found = line_dedup.removed_lines(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    want = brute.removed_lines(distinct)
    # Rows of one doc_id are ordered by a hash; these tests have none with different texts that share lines.
    assert sorted({(str(r["doc_id"]), r["n_lines"], str(r["removed"])) for r in found}) == sorted({(str(d), n, str(g)) for (d, _), (n, g) in zip(distinct, want, strict=True)})


@pytest.mark.parametrize("block", [4, line_dedup.BLOCK])
def test_lines(llm, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    rng, lines = random.Random(1), variants(3)
    lines += [" ".join(rng.sample("the of and to in a is it".split(), rng.randrange(3, 8))) for _ in range(150)]
    rng.shuffle(lines)
    check_lines(llm, [(i, "\n".join(lines[i * 5 : i * 5 + 5] + ["", "short"]), "en", "a", 0) for i in range(len(lines) // 5)])


def test_lines_odd(llm, odd_rows, no_docs):
    check_lines(llm, odd_rows)
    assert line_dedup.removed_lines(no_docs).count() == 0
    left = {r["doc_id"]: r for r in line_dedup.without_copied_lines(frame(llm, odd_rows)).collect()}
    assert 5 not in left and 4 in left and left[-3]["text"].count("w") == 12 and left[7]["text"] == "one two"


def test_lines_documents(llm, documents):
    check_lines(llm, [(d, t, "en", "a", 0) for d, t in documents[1].items()])


def test_decontamination(llm, odd_rows, no_docs):
    rng = random.Random(2)
    items = [(i, sentence(rng, n, 10**6)) for i, n in enumerate([5, 6, 9, 12, 20, 33, 64, 65, 130, 300])]
    items += [(50, None), (51, ""), (52, "four words are few"), (None, sentence(rng, 25, 10**6)), (0, items[0][1])]
    docs = [(i, None if i == 3 else sentence(rng, 40, 10**6), "en", "a", 0) for i in range(20)]
    for k, (_, text) in enumerate(items):
        words = (text or "").split()
        if len(words) >= 5:
            cut = max(5, round(0.9 * len(words)))
            docs.append((100 + k, f"{sentence(rng, 6000, 10**6)} {text.upper()}, {sentence(rng, 3000, 10**6)}", "en", "a", 0))
            docs.append((200 + k, f"{sentence(rng, 500, 10**6)} {' '.join(words[:cut])} {sentence(rng, 70, 10**6)}", "en", "a", 0))
            docs.append((300 + k, f"{' '.join(words[: len(words) // 2])} {sentence(rng, 700, 10**6)}", "en", "a", 0))
    docs.append(docs[-1])
    table = llm.createDataFrame(items, "item_id bigint, text string").selectExpr("*", "1 as n", "2 as item", "3 as value")
    found = decontaminate.contaminated(frame(llm, docs), table)
    got = [(r["doc_id"], r["item_id"]) for r in found.collect()]
    assert len(got) == len(set(got)) and set(got) == brute.contained([(d, t) for d, t, *_ in docs], set(items))
    assert decontaminate.contaminated(no_docs, table).count() == 0
    assert decontaminate.contaminated(frame(llm, odd_rows), table.limit(0)).count() == 0
    left = {r["doc_id"] for r in decontaminate.without_contaminated(frame(llm, docs), table).collect()}
    assert left == {d for d, *_ in docs} - {d for d, _ in got}
