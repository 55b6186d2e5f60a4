"""The pipeline's stages, each held against brute force on its own input."""

import corpus_pipeline
import pytest
from tidemark.llm import common, queries

from . import brute
from .conftest import SF

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_names():
    assert {f"op{n}_" for n in range(1, 14)} == {q.split("_")[0] + "_" for q in queries.QUERIES}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "lines", "near copies", "decontamination", "packing"]


@pytest.fixture(scope="module")
def stages(llm):
    docs, out = llm.read.parquet(f"{SF}/documents.parquet"), []
    for name, stage in corpus_pipeline.STAGES:
        out.append((name, docs, result := common.written(stage(llm, docs, SF), "test-stage")))
        docs = result
    return out


def test_columns(stages):
    assert all(result.columns == COLUMNS for _, _, result in stages[:-1])


def texts(frame):
    return {r["doc_id"]: r["text"] for r in frame.collect()}


def test_quality(stages):
    before, after = texts(stages[0][1]), texts(stages[0][2])
    assert set(after) <= {d for d, t in before.items() if not brute.quality(t)[5]}
    assert set(after) == {d for d, t in before.items() if not brute.quality(t)[5]}  # no host of this size has boilerplate


def test_lines(stages):
    before, after = texts(stages[1][1]), texts(stages[1][2])
    order = sorted(before)
    for d, (_, gone) in zip(order, brute.removed_lines([(d, before[d]) for d in order]), strict=True):
        lines = before[d].split("\n")
        left = [x for i, x in enumerate(lines) if i not in gone]
        if gone and not any(brute.WORD.findall(x) for x in left):
            assert d not in after
        else:
            assert after[d] == "\n".join(left)


def test_near_copies(stages):
    before, after = texts(stages[2][1]), texts(stages[2][2])
    order = sorted(before)
    assert set(after) == {d for d, (_, c) in zip(order, brute.near_copies([(d, before[d]) for d in order]), strict=True) if c == d}


def test_decontamination(llm, stages):
    before, after = texts(stages[3][1]), texts(stages[3][2])
    items = [(r["item_id"], r["text"]) for r in llm.read.parquet(f"{SF}/benchmark.parquet").collect()]
    assert set(before) - set(after) == {d for d, _ in brute.contained(before.items(), items)}


def test_packing(stages):
    docs, rows = texts(stages[4][1]), stages[4][2].collect()
    assert {r["doc_id"] for r in rows} == set(docs)
    assert all(sum(r["length"] for r in rows if r["doc_id"] == d) == next(r["doc_tokens"] for r in rows if r["doc_id"] == d) for d in list(docs)[:20])
