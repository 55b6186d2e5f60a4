"""Fill-in-the-middle and its wavelet matrix against plain versions."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm import fill_middle
from tidemark.llm.wavelet import WaveletMatrix

from .conftest import frame

UNITS = {"lines": r"[^\n]*\n|[^\n]+", "words": r"[^ \t\n\x0b\f\r]*[ \t\n\x0b\f\r]|[^ \t\n\x0b\f\r]+", "chars": r"(?s)."}


def plain(doc_id, text, unit="lines", rate=100, spm_rate=50):
    text = text or ""
    digest = hashlib.sha256(f"7:{'' if doc_id is None else doc_id}".encode()).hexdigest()
    h = [int(digest[8 * i : 8 * i + 8], 16) for i in range(4)]
    units = re.findall(UNITS[unit], text)
    n = len(units)
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = "".join(units[:a]), "".join(units[a:b]), "".join(units[b:])
    assert prefix + middle + suffix == text
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= rate:
        return doc_id, n, "plain", None, None, text
    if h[3] % 100 < spm_rate:
        return doc_id, n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return doc_id, n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_ranks():
    rng = np.random.default_rng(1)
    for n in (0, 1, 63, 64, 65, 1000):
        for bits in (1, 2, 3):
            symbols = rng.integers(0, 1 << bits, n, dtype=np.uint8)
            matrix = WaveletMatrix(symbols, bits)
            for c in range(1 << bits):
                want = np.concatenate(([0], np.cumsum(symbols == c)))
                assert (matrix.rank(c, np.arange(n + 1)) == want).all()


def texts():
    rng = random.Random(2)
    parts = ["\n", "\n\n", " ", "\t", "a", "word", "é", "日本", "\U0001f600", "<", "P>", "<S", ">", "\r\n", " ", "\x0b"]
    out = [(i, "".join(rng.choice(parts) for _ in range(rng.randrange(0, 30)))) for i in range(400)]
    return [*out, (1000, "<P>"), (1001, "x\n<M>\ny"), (1002, "<"), (1003, "\n" * 50), (1004, "no feed"), (1004, "no feed"), (1005, "line of text\n" * 70_000)]


@pytest.mark.parametrize(("unit", "rate", "spm_rate"), [("lines", 100, 50), ("words", 60, 30), ("chars", 100, 100)])
def test_cuts(llm, odd_rows, unit, rate, spm_rate):
    rows = texts() + [(d, t) for d, t, *_ in odd_rows]
    made = fill_middle.transform(frame(llm, [(d, t, "en", "a", 0) for d, t in rows]), unit, 7, rate, spm_rate)
    made = made.withColumn("back", fill_middle.restored(F.col("output"), F.col("form"))).collect()
    key = lambda r: (str(r[0]), r[5], r[1])
    got = sorted(((r["doc_id"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in made), key=key)
    assert got == sorted((plain(d, t, unit, rate, spm_rate) for d, t in rows), key=key)
    assert sorted((str(r["doc_id"]), r["back"]) for r in made) == sorted((str(d), t or "") for d, t in rows)


def test_no_rows(no_docs, odd_docs):
    assert fill_middle.transform(no_docs).count() == 0
    with pytest.raises(ValueError, match="unknown unit"):
        fill_middle.transform(odd_docs, "pages")
