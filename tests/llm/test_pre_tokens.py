"""Pre-tokens against the library's own, in texts with and without white space."""

import numpy as np
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.llm import common, encode, token_counts

BYTE_BPE, WORD_BPE = encode.tokenizer_path("byte_bpe_50k.json"), encode.tokenizer_path("word_bpe_49k.json")
CHINESE = "数据处理需要大量的文本，但是文本里常常没有空格。我们把它分成小块！"


def split(splitter, texts):
    data, bounds = common.text_buffer(pa.array(texts, pa.string()))
    out = []
    for numbers, rows in splitter.encode(data, bounds):
        out += [[splitter.names[i] for i in numbers[a:b]] for a, b in zip(rows[:-1], rows[1:], strict=True)]
    return out


def library(text):
    """Pre-tokens of a text without special strings."""
    return [text[a:b] for _, (a, b) in TOKENIZER.pre_tokenizer.pre_tokenize_str(text)]


TOKENIZER = encode.load(BYTE_BPE)
splitters = [encode.PreTokens(BYTE_BPE), encode.PreTokens(BYTE_BPE, 3)]
symbols = st.sampled_from(" \t\n\r\x0b\x0c\x1c\x1f\x85  　'strevmld,.!_0193²abZéßǅ数据。👍́‍")


@settings(max_examples=300, deadline=None)
@given(st.lists(st.text(symbols | st.characters(exclude_categories=("Cs",)), max_size=40), max_size=5))
def test_pre_tokens_equal_library(texts):
    for splitter in splitters:
        assert split(splitter, texts) == [library(t) for t in texts]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text(symbols, max_size=12), min_size=1, max_size=6))
def test_tokens_of_pre_tokens_add_up(parts):
    text = "<|endoftext|>".join(parts)
    tokenizer = TOKENIZER
    count = lambda x: len(tokenizer.encode(x, add_special_tokens=False).ids)
    names = split(splitters[0], [text])[0]
    assert "".join(names) == text and sum(map(count, names)) == count(text)


def test_other_tokenizers_keep_pieces_whole():
    assert split(encode.PreTokens(WORD_BPE), ["One, two-three  x", "", "数据，x y"]) == [["One,", " two-three", "  x"], [], ["数据，x", " y"]]


def test_texts_without_spaces_share_pre_tokens(llm):
    parts = [p for p in CHINESE.replace("，", "。").replace("！", "。").split("。") if p]
    rng = np.random.default_rng(3)
    texts = ["。".join(rng.choice(parts, 60)) + "。" for _ in range(200)]
    docs = llm.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    tokenizer = TOKENIZER
    want = {i: len(tokenizer.encode(t, add_special_tokens=False).ids) for i, t in enumerate(texts)}
    for common_pieces in (0, token_counts.COMMON):
        assert {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, BYTE_BPE, common_pieces).collect()} == want
    assert len({n for names in split(encode.PreTokens(BYTE_BPE), texts) for n in names}) == len(parts) + 1


def test_ten_megabytes_without_spaces(llm):
    text = (CHINESE + "aGVsbG8sIHdvcmxk/Zm9v+YmFy=0x1f9;{}") * 75_000
    assert len(text.encode()) > 10_000_000
    docs = llm.range(2).select(F.col("id").alias("doc_id"), F.lit(None).cast("string").alias("text"))
    docs = docs.unionByName(llm.range(7, 8).select(F.col("id").alias("doc_id"), F.repeat(F.lit(CHINESE + "aGVsbG8sIHdvcmxk/Zm9v+YmFy=0x1f9;{}"), 75_000).alias("text")))
    got = {r["doc_id"]: (r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(docs, BYTE_BPE).collect()}
    assert got == {0: (0, 0), 1: (0, 0), 7: (len(text.encode()), len(TOKENIZER.encode(text, add_special_tokens=False).ids))}


@pytest.mark.parametrize("held", [10, 200])
def test_remembered_pieces_are_bounded(monkeypatch, held):
    monkeypatch.setattr(encode, "HELD", held)
    monkeypatch.setattr(encode.words, "SLICE", 40)
    texts = [f"{i} word{i % 7}, and 数据{i % 3}" for i in range(60)]
    splitter = encode.PreTokens(BYTE_BPE)
    assert split(splitter, texts) == [library(t) for t in texts]
    assert splitter.held <= held + 200 and len(splitter.names) == len(splitter.keys) == len(splitter.numbers)
