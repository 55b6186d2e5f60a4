"""Recall of forms the base patterns don't know, by kind, through the tagger that `train` makes."""

import os
import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import common, pii

SF = "/root/testdata/sf0.1"  # smaller scales have too few spans to learn from


def planted_forms(rng):
    digit = lambda n: "".join(rng.choice("0123456789") for _ in range(n))

    def card():
        while not pii.luhn(number := digit(16)):
            pass
        return [number[i : i + 4] for i in range(0, 16, 4)]

    name = lambda: rng.choice(["first.last", "j_doe", "anna", "user12"])
    out = {(0, at, host): lambda at=at, host=host: name() + at + host for at in ("(@)", "[@]") for host in ("mail3.example.com", "example.org", "uni.edu", "mail7.company.net")}
    out |= {(1, dot): lambda dot=dot: dot.join(str(rng.randrange(256)) for _ in range(4)) for dot in (" . ", "[.]", "(.)")}
    return out | {(2, sep): lambda sep=sep: sep.join(card()) for sep in (".", "_")}


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
def test_recall_by_form(llm):
    docs = common.need(llm.read.parquet(f"{SF}/documents.parquet"), doc_id="bigint", text="string")
    tagger, rng, found = pii.train(docs), random.Random(99), {}
    texts = [r[0] for r in docs.filter("length(text) > 600 AND NOT text RLIKE '[0-9@]'").orderBy(F.xxhash64("doc_id")).select("text").limit(20).collect()]
    assert len(texts) == 20 and not any(pii.extra(tagger, texts, [[]] * 20))
    for key, make in planted_forms(rng).items():
        planted, want = [], []
        for text in texts:
            at, own = text.index(" ", len(text) // 2) + 1, make()
            planted.append(f"{text[:at]}{own} {text[at:]}")
            want.append((key[0], at, at + len(own)))
        got = pii.extra(tagger, planted, [pii.base_spans(p) for p in planted])
        found[key] = sum(w in g for w, g in zip(want, got, strict=True)) / len(texts)
    kinds = {k: [v for key, v in found.items() if key[0] == k] for k in range(3)}
    assert sum(kinds[0]) / len(kinds[0]) >= 0.9 and sum(kinds[1]) / len(kinds[1]) >= 0.9 and sum(kinds[2]) / len(kinds[2]) >= 0.7, found
