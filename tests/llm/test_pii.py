import random
import re

import numpy as np
from pyspark.sql import functions as F

from tidemark.llm import pii
from tidemark.llm.pii_model import KINDS, Tagger

from .conftest import sentence

# The contract's patterns, run as they stand.
EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def plain(text):
    found = [(0, *m.span()) for m in EMAIL.finditer(text)]
    found += [(1, *m.span()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m.group().split("."))]
    found += [(2, *m.span()) for m in CARD.finditer(text) if 16 <= len(d := re.sub("[^0-9]", "", m.group())) <= 19 and pii.luhn(d)]
    return found + [(3, *m.span()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m.group())) <= 15]


def personal(rng):
    number = [rng.randrange(10) for _ in range(15)]
    number.append(next(d for d in range(10) if pii.luhn("".join(map(str, [*number, d])))))
    card = "".join(map(str, number))
    return rng.choice([
        f"{rng.choice('abcd')}{rng.randrange(999)}@mail{rng.randrange(9)}.example.com", ".".join(str(rng.randrange(256)) for _ in range(4)),
        card, " ".join(card[i : i + 4] for i in range(0, 16, 4)), f"+1 ({rng.randrange(200, 999)}) 555-{rng.randrange(1000, 9999)}",
    ])


def texts(seed, n):
    rng = random.Random(seed)
    return [f"{sentence(rng, rng.randrange(1, 30))} {personal(rng)} {sentence(rng, rng.randrange(1, 30))} version {rng.randrange(9)}." for _ in range(n)]


def test_base_equals_patterns():
    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice("a1.@+- ()2_%3é") for _ in range(rng.randrange(0, 50)))
        assert pii.base_spans(text) == plain(text), text
    assert pii.base_spans("a" * 50_000 + "1" * 50_000) == []


def test_tagger_on_held_out_windows():
    ids, tags = pii.labelled(texts(1, 250), 1200)
    tagger = Tagger()
    losses = tagger.fit(ids.astype(np.int64), tags, epochs=10)
    assert losses[-1] < losses[0] / 5
    held, gold = pii.labelled(texts(2, 80), 500)
    found, chances = tagger.decode(held.astype(np.int64))
    inside = gold > 0
    assert (found == gold).mean() > 0.97 and (found[inside] == gold[inside]).mean() > 0.9
    assert ((chances > 0) & (chances < 1.01)).all()


def test_gradient():
    rng = np.random.default_rng(0)
    tagger = Tagger()
    ids, tags = rng.integers(0, 99, (3, 8)), np.array([[0, 1, 2, 2, 0, 3, 4, 0]] * 3)
    _, grad = tagger.gradient(ids, tags)
    for name in ("recurrent_f", "recurrent_b", "out", "moves", "bias"):
        at = (0,) * tagger.weights[name].ndim
        before, ends = tagger.weights[name][at], []
        for step in (1e-2, -1e-2):
            tagger.weights[name][at] = before + step
            ends.append(float(tagger.gradient(ids, tags)[0]))
        tagger.weights[name][at] = before
        assert abs((ends[0] - ends[1]) / 2e-2 - float(grad[name][at])) < 2e-2


def test_reconcile():
    assert pii.reconcile([(0.99, 5, 9, 0), (0.99, 5, 9, 0), (0.97, 8, 12, 1), (0.5, 20, 25, 1), (0.98, 30, 34, 2)], [(0, 33, 40)]) == [(0, 5, 9)]


def test_documents(odd_docs, odd_rows, no_docs):
    rows = pii.find(odd_docs).collect()
    got = sorted((str(r["doc_id"]), [(s["kind"], s["start"], s["stop"]) for s in r["base"]]) for r in rows)
    assert got == sorted((str(d), [(KINDS[k], a, b) for k, a, b in plain(t or "")]) for d, t, *_ in odd_rows)
    assert pii.find(no_docs).count() == 0


def test_added_spans(llm):
    docs = llm.createDataFrame([(i, t) for i, t in enumerate(texts(5, 300) + [f"call 0012125551234{i} or 00{i} now" for i in range(3)])], "doc_id bigint, text string")
    rows = pii.find(docs).select("*", pii.joined(F.concat("base", "added")).alias("all")).collect()
    for r in rows:
        spans = sorted((s["start"], s["stop"]) for s in [*r["base"], *r["added"]] if s in r["added"] or True)
        added = [(s["start"], s["stop"]) for s in r["added"]]
        assert all(b <= c or d <= a for a, b in added for c, d in [(s["start"], s["stop"]) for s in r["base"]])
        assert len(spans) == len(r["all"].split(",")) if r["all"] else not spans
    assert sum(len(r["added"]) for r in rows[:300]) < 15  # texts whose personal data the patterns find stay as they are
