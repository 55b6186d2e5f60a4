"""Token files, packing and token counts against the tokenizer itself."""

import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, encode, packing, token_counts, token_files, words

WORD_BPE, BYTE_BPE = encode.tokenizer_path("word_bpe_49k.json"), encode.tokenizer_path("byte_bpe_50k.json")


def ids_of(path, text):
    return encode.load(path).encode(text or "", add_special_tokens=False).ids


@pytest.mark.parametrize("path", [WORD_BPE, BYTE_BPE])
@pytest.mark.parametrize("cache", [encode.CACHE, 50])
def test_encoder_equals_library(odd_rows, path, cache):
    import pyarrow as pa

    texts = [t for _, t, *_ in odd_rows if t is None or len(t) < 5000] * 2 + ["  lead", "trail \n", " \u2028 a", "x\u0085 y", "<|startoftext|>a <|endoftext|> \n", "İ ǅ ß"]
    data, bounds = common.text_buffer(pa.array(texts, pa.string()))
    got = [ids[a:b].tolist() for ids, rows in encode.Encoder(path, cache).encode(data, bounds) for a, b in zip(rows[:-1], rows[1:], strict=True)]
    assert got == [ids_of(path, t) for t in texts]


@pytest.mark.parametrize("width", [1, 3, 8, 11, 16, 17, 25])
def test_bits_round_trip(width):
    ids = np.random.default_rng(width).integers(0, 1 << width, 1003).astype(np.uint32)
    packed = token_files.pack_bits(ids, width) + bytes(8)
    assert len(packed) <= (1003 * width + 7) // 8 + 8
    assert (token_files.unpack_bits(packed, width, 0, 1003) == ids).all()
    assert (token_files.unpack_bits(packed, width, 777, 100) == ids[777:877]).all()


def test_id_bits():
    assert [token_files.id_bits(n) for n in (1, 2, 3, 256, 257, 49408, 65537)] == [1, 1, 2, 8, 9, 16, 17]


def expected(odd_rows):
    rows = sorted(((d, t or "") for d, t, *_ in odd_rows), key=lambda r: (r[0] is not None, r[0] or 0))
    return [(d, ids_of(WORD_BPE, t) + [2]) for d, t in rows]


def test_token_files(llm, odd_docs, odd_rows, monkeypatch):
    path = common.new_path(llm, "test-files")
    token_files.write_token_files(odd_docs, path, WORD_BPE, 2)
    rows = token_files.read_token_files(llm, path).orderBy("start").collect()
    want = expected(odd_rows)
    assert sorted((str(d), ids) for d, ids in want) == sorted((str(r["doc_id"]), np.frombuffer(r["ids"], "<u4").tolist()) for r in rows)
    assert [r["doc_id"] for r in rows] == [d for d, _ in want]
    assert [r["start"] for r in rows] == np.cumsum([0] + [r["n_tokens"] for r in rows])[:-1].tolist()


def test_random_access(llm, odd_docs):
    path = common.new_path(llm, "test-access")
    token_files.write_token_files(odd_docs.coalesce(1), path, WORD_BPE, 2)
    contents = [bytes(r["content"]) for r in llm.read.format("binaryFile").load(path).orderBy("path").collect() if r["length"]]
    for content in contents:
        file = token_files.TokenFile(content)
        every = file.ids(0, file.n_ids)
        assert len(every) == file.n_ids == file.documents()[1].sum()
        for start in (0, file.n_ids // 3, max(0, file.n_ids - 5)):
            assert (file.ids(start, 70_000) == every[start : start + 70_000]).all()


def test_no_files(llm, no_docs):
    path = common.new_path(llm, "test-none")
    token_files.write_token_files(no_docs, path, WORD_BPE, 2)
    assert token_files.read_token_files(llm, path).count() == 0


def test_packing(odd_docs, odd_rows, no_docs):
    rows = packing.pack(odd_docs, WORD_BPE, 2, 64).collect()
    assert len({r["sequence_id"] for r in rows}) == len(rows)
    assert all(r["offset"] == 0 and r["length"] <= 64 and r["length"] & (r["length"] - 1) == 0 and len(r["ids"]) == 4 * r["length"] for r in rows)
    texts = {}
    for r in sorted(rows, key=lambda r: r["sequence_id"]):
        if r["start"] == 0:
            texts.setdefault(str(r["doc_id"]), []).append([])
        texts[str(r["doc_id"])][-1] += np.frombuffer(r["ids"], "<u4").tolist()
    want = {}
    for d, ids in expected(odd_rows):
        want.setdefault(str(d), []).append(ids)
    assert {k: sorted(v) for k, v in texts.items()} == {k: sorted(v) for k, v in want.items()}
    assert packing.pack(no_docs, WORD_BPE, 2).count() == 0
    with pytest.raises(ValueError):
        packing.pack(odd_docs, WORD_BPE, 2, 100)


@pytest.mark.parametrize("common_pieces", [0, 8, token_counts.COMMON])
def test_counts(odd_docs, odd_rows, common_pieces):
    got = sorted((str(r["doc_id"]), r["n_bytes"], r["n_tokens"]) for r in token_counts.count_tokens(odd_docs, BYTE_BPE, common_pieces).collect())
    assert got == sorted((str(d), len((t or "").encode()), len(ids_of(BYTE_BPE, t))) for d, t, *_ in odd_rows)


def test_counts_of_nothing(no_docs):
    assert token_counts.count_tokens(no_docs, BYTE_BPE).count() == 0


def test_whole_documents(documents):
    docs, texts = documents
    got = {r["doc_id"]: r["n_tokens"] for r in token_counts.count_tokens(docs, BYTE_BPE).collect()}
    assert got == {d: len(ids_of(BYTE_BPE, t)) for d, t in texts.items()}
    crc = {(r["doc_id"], r["start"], r["length"]): r["c"] for r in packing.pack(docs, WORD_BPE, 2).select("doc_id", "start", "length", F.crc32("ids").alias("c")).collect()}
    for d, t in texts.items():
        ids = np.array(ids_of(WORD_BPE, t) + [2], "<u4")
        own = {k: v for k, v in crc.items() if k[0] == d}
        assert sum(k[2] for k in own) == len(ids)
        assert all(zlib.crc32(ids[k[1] : k[1] + k[2]].tobytes()) == v for k, v in own.items())


def test_buckets(llm, odd_docs, no_docs):
    path = common.new_path(llm, "test-buckets")
    packing.write_buckets(packing.pack(odd_docs, WORD_BPE, 2, 64), path)
    key = lambda r: (str(r["doc_id"]), r["start"], r["length"], bytes(r["ids"]))
    whole = packing.pack(odd_docs, WORD_BPE, 2, 64).collect()
    assert sorted(map(key, packing.read_buckets(llm, path).collect())) == sorted(map(key, whole))
    for length in (1, 64):
        own = packing.read_buckets(llm, path, length)
        assert own.columns == packing.pack(odd_docs, WORD_BPE, 2, 64).columns and {f"length={length}" in f for f in own.inputFiles()} >= {True}
        assert sorted(map(key, own.collect())) == sorted(key(r) for r in whole if r["length"] == length)
    ids = [r["sequence_id"] for r in packing.bucketed(odd_docs, WORD_BPE, 2, 64).collect()]
    assert len(set(ids)) == len(ids) == len(whole) and packing.bucketed(no_docs, WORD_BPE, 2).count() == 0


def test_file_numbers_of_more_digits(llm, odd_docs):
    import os

    path = common.new_path(llm, "test-file-numbers")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "1000", "spark.sql.adaptive.coalescePartitions.minPartitionSize": "1"}
    for name, value in small.items():
        llm.conf.set(name, value)
    token_files.write_token_files(odd_docs, path, WORD_BPE, 2)
    for name in small:
        llm.conf.unset(name)
    want = [tuple(r) for r in token_files.read_token_files(llm, path).orderBy("start").collect()]
    names = sorted(n for n in os.listdir(path) if n.startswith("part-"))
    assert len(names) > 2
    for i, name in enumerate(names):  # the last range gets a number of one digit more
        os.rename(f"{path}/{name}", f"{path}/part-{100_001 - len(names) + i:05d}-x.txt")
    assert {len(n.split("-")[1]) for n in os.listdir(path) if n.startswith("part-")} == {5, 6}
    assert [tuple(r) for r in token_files.read_token_files(llm, path).orderBy("start").collect()] == want


def test_hashes_of_long_texts(monkeypatch):
    rng = np.random.default_rng(5)
    data = np.frombuffer(bytes(rng.choice(list(b"abcdefgh  \n"), 50_000)), np.uint8)
    bounds = np.array([0, 20_000, 20_000, 50_000])
    whole = words.words(data, bounds)
    monkeypatch.setattr(words, "SLICE", 300)
    assert all((a == b).all() for a, b in zip(words.words(data, bounds), whole, strict=True))
    one = np.frombuffer(b"x" * 2000 + b" y", np.uint8)  # a word longer than a part
    assert len(set(words.words(one, np.array([0, len(one)]))[0].tolist())) == 2
