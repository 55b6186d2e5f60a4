"""Line dedup without a floor: lines of any number of words, against brute force."""

import random

import pytest

from tidemark.llm import line_dedup, queries

from . import brute
from .conftest import SF, frame, sentence


def rows_of(texts):
    return [(i, t, "en", "a", 0) for i, t in enumerate(texts)]


def short_texts():
    """Lines of 1 to 8 distinct words from few words, many equal or near, and long lines made of few words."""
    rng = random.Random(11)
    words = "the of and to in a is it read more".split()
    lines = [" ".join(rng.choices(words, k=rng.randrange(1, 9))) for _ in range(300)]
    lines += [" ".join(["ha"] * 60), "ha", " ".join(["la la ho"] * 30), sentence(rng, 20), "a b c d", "a b c d e", "a b c", "a b c x"]
    rng.shuffle(lines)
    return ["\n".join([*lines[i : i + 4], "", "Read more"]) for i in range(0, len(lines), 4)]


@pytest.mark.parametrize("block", [4, line_dedup.BLOCK])
def test_every_line(llm, monkeypatch, block):
    monkeypatch.setattr(line_dedup, "BLOCK", block)
    texts = short_texts()
    found = {r["doc_id"]: (r["n_lines"], list(r["removed"])) for r in line_dedup.removed_lines(frame(llm, rows_of(texts)), min_words=line_dedup.EVERY_LINE).collect()}
    assert found == dict(enumerate(brute.removed_lines(list(enumerate(texts)), least=1)))


def test_query_judges_every_line(llm, documents):
    texts = documents[1]
    found = {r["doc_id"]: (r["n_lines"], list(r["removed"])) for r in queries.QUERIES["op2_line_dedup"](llm, SF).collect()}
    order = sorted(texts)
    want = dict(zip(order, brute.removed_lines([(d, texts[d]) for d in order], least=1), strict=True))
    assert found == want
    assert want != dict(zip(order, brute.removed_lines([(d, texts[d]) for d in order], least=5), strict=True))  # short copies are there


def test_pipeline_judges_every_line(llm):
    texts = ["Read more\none two three", "ONE\nRead more\nfour five", "Read more"]
    left = {r["doc_id"]: r["text"] for r in line_dedup.without_copied_lines(frame(llm, rows_of(texts))).collect()}
    assert left == {0: texts[0], 1: "ONE\nfour five"}
