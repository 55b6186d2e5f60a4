"""Added spans at the ends of texts and across windows."""

import numpy as np
import pytest

from tidemark.llm import pii
from tidemark.llm.pii_model import LENGTH, Tagger

from .test_pii import texts


class Runs:
    """Stands for the tagger: every run without spaces is an email, as far as the window shows it."""

    def decode(self, ids):
        inside = (ids > 1) & (ids < 96)
        begins = inside & ~np.concatenate((np.zeros((len(ids), 1), bool), inside[:, :-1]), axis=1)
        return np.where(begins, 1, np.where(inside, 2, 0)), np.full(ids.shape, 0.99)


def form(size):
    left = "a" * (size // 2)
    return f"{left}(@){'b' * (size - len(left) - 7)}.com"


@pytest.mark.parametrize("size", [16, 31, 40, 62, 63, 64, 80, 200])
def test_whole_at_every_offset(size):
    own = form(size)
    assert len(own) == size
    for before in range(2 * LENGTH + 1):
        for after in (0, 1, 31, 70):
            text = " " * before + own + " " * after
            assert pii.extra(Runs(), [text], [[]]) == [[(0, before, before + size)]], (before, after)


def test_windows_end_between_neighbours():
    text = " ".join([form(20), form(45), form(30), form(80), form(9)])
    want = [(0, text.index(x), text.index(x) + len(x)) for x in text.split()]
    assert sorted(pii.extra(Runs(), [text, "", text], [[]] * 3)[2]) == want


def test_trained_tagger_at_the_ends():
    ids, tags = pii.labelled(texts(1, 250))
    tagger = Tagger()
    tagger.fit(ids.astype(np.int64), tags, epochs=10)
    own = [f"{'abcd'[i % 4]}{100 + i * 7} @ mail{i % 9}.example.com" for i in range(30)]
    words = "w12 w3991 w204 w77 w1400 w23 w8 w998 w1200 w3101 w44 w512 "

    def found(make):
        made = [make(x) for x in own]
        got = pii.extra(tagger, made, [pii.base_spans(t) for t in made])
        return sum(any(t[a:b] == x for _, a, b in spans) for t, x, spans in zip(made, own, got, strict=True))

    assert found(lambda x: f"{words}{x} {words}") > 20
    assert found(lambda x: (words * 3)[-(128 - len(x)) :] + x) > 20  # 128 characters: the text ends where a window does
    assert found(lambda x: f"{x} {words}") > 5  # with nothing before it, it is less often sure enough
