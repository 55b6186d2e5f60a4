"""Token ids of whole texts from a tokenizer file: every distinct piece of text between white space is encoded once."""

from __future__ import annotations

import json
import os
import re
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pandas as pd
import pyarrow as pa

from tidemark.llm import common, words

# Byte before a cut: printable ASCII, or the last byte of a two-byte character whose first byte is C3 to CF (letters).
_FULL = np.zeros(256, bool)
_FULL[0x21:0x7F] = True
_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0D]] = True
_LETTER = np.zeros(256, bool)
_LETTER[0xC3:0xD0] = True
_THREE = np.zeros(256, bool)
_THREE[0xE1:0xF0] = True
CACHE = 1 << 20  # pieces remembered by one Python worker, about 40 bytes each
JOINED = 256  # pieces encoded in one call
HELD = 1 << 25  # characters of pre-tokens remembered by one Python worker

# Fixed value: the split pattern of byte-level tokenizers, as it reads for ASCII.
ASCII_SPLIT = r"'(?:s|t|re|ve|m|ll|d)| ?[A-Za-z]+| ?[0-9]+| ?[^\t-\r A-Za-z0-9]+|[\t-\r ]+(?![^\t-\r ])|[\t-\r ]+"


def tokenizer_path(name: str) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def load(path: str):
    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs one task for each core
    from tokenizers import Tokenizer

    return Tokenizer.from_file(path)


def cuts(data: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """
    Starts of the pieces, and the place of each row's first piece. A text is cut where a character that is no white space
    is followed by white space: pre-tokenizers that take white space alone or in front of a word never join across such
    a place. Only places that are safe without decoding are used: a character that can't be told stays uncut.
    """
    first = np.zeros(len(data) + 1, bool)
    first[bounds] = True
    if len(data) > 1:
        last = data[:-1]
        full = _FULL[last]
        full[1:] |= _LETTER[data[:-2]] & (last[1:] >= 0x80)
        if len(data) > 3:  # three bytes, but not the white space below U+1680, U+2000 to U+207F and U+3000
            lead, second = data[:-3], data[1:-2]
            odd = ((lead == 0xE1) & (second == 0x9A)) | ((lead == 0xE2) & (second <= 0x81)) | ((lead == 0xE3) & (second == 0x80))
            full[2:] |= _THREE[lead] & ~odd & (last[2:] >= 0x80)
        first[1:-1] |= full & _SPACE[data[1:]]
    starts = np.flatnonzero(first[:-1])
    return starts, np.searchsorted(starts, bounds, "left")


def pieces(data: np.ndarray, bounds: np.ndarray) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """For each slice of rows: first row, last row (exclusive), its bytes, piece starts (one more at the end), piece hashes, row bounds among the pieces."""
    for a, b in common.slices(bounds, words.SLICE):
        own = data[bounds[a] : bounds[b]]
        rows = bounds[a : b + 1] - bounds[a]
        starts, firsts = cuts(own, rows)
        edges = np.append(starts, len(own))
        yield a, b, own, edges, words.span_hashes(own, edges[:-1], edges[1:]), firsts


class Encoder:
    """Ids of texts; pieces met before come from a table of bounded size."""

    def __init__(self, path: str, cache: int = CACHE):
        self.tokenizer = load(path)
        self.cache = cache
        self.clear()

    def clear(self):
        none = np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int32)
        self.tiers = [none, none]  # many old pieces, few new ones: sorted keys, starts and sizes of their ids
        self.ids = np.zeros(0, np.uint32)
        self.used = 0

    def fresh(self, texts: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """
        Order, ids and sizes of pieces. Pieces that begin with white space and end with none can be encoded as one text:
        they would be cut there again. Their ids are told apart by offsets, which point into the text as it was.
        """
        joined = [i for i, t in enumerate(texts) if t[0] in " \t\n\r" and not t[-1].isspace() and "<|" not in t]
        alone = sorted(set(range(len(texts))).difference(joined))
        ids, sizes = [], []
        for at in range(0, len(joined), JOINED):
            group = [texts[i] for i in joined[at : at + JOINED]]
            got = self.tokenizer.encode("".join(group), add_special_tokens=False)
            begins = np.array([begin for begin, _ in got.offsets], np.int64)
            edges = np.cumsum([0, *map(len, group)])
            ids.append(np.array(got.ids, np.uint32))
            sizes.append(np.diff(np.searchsorted(begins, edges, "left")))
        for i in alone:
            ids.append(np.array(self.tokenizer.encode(texts[i], add_special_tokens=False).ids, np.uint32))
            sizes.append([len(ids[-1])])
        return joined + alone, np.concatenate(ids), np.concatenate(sizes).astype(np.int64)

    def full(self, more: int) -> bool:
        """Whether so many pieces more are too many, or the ids of those met are: a text without white space is one piece."""
        return sum(len(t[0]) for t in self.tiers) + more > self.cache or self.used > 16 * self.cache

    def look(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        starts, sizes, known = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64), np.zeros(len(keys), bool)
        for own, at, n in self.tiers:
            if len(own):
                place = np.minimum(np.searchsorted(own, keys), len(own) - 1)
                hit = own[place] == keys
                starts[hit], sizes[hit] = at[place[hit]], n[place[hit]]
                known |= hit
        return starts, sizes, known

    def learn(self, keys: np.ndarray, texts: list[str]):
        order, ids, sizes = self.fresh(texts)
        keys = keys[order]
        if self.used + len(ids) > len(self.ids):
            self.ids = np.concatenate((self.ids[: self.used], ids, np.zeros(len(self.ids) // 2, np.uint32)))
        else:
            self.ids[self.used : self.used + len(ids)] = ids
        self._merge(1, (keys, self.used + np.cumsum(sizes) - sizes, sizes.astype(np.int32)))
        self.used += len(ids)
        if len(self.tiers[1][0]) > 20_000 + len(self.tiers[0][0]) // 8:
            self._merge(0, self.tiers[1])
            self.tiers[1] = tuple(x[:0] for x in self.tiers[1])

    def _merge(self, tier: int, new):
        both = [np.concatenate(x) for x in zip(self.tiers[tier], new, strict=True)]
        order = np.argsort(both[0], kind="stable")
        self.tiers[tier] = tuple(x[order] for x in both)

    def encode(self, data: np.ndarray, bounds: np.ndarray, end: int | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Ids and bounds of the rows, slice by slice; ``end`` is appended to every row."""
        for _, _, own, edges, hashes, firsts in pieces(data, bounds):
            codes, keys = pd.factorize(hashes)
            if self.full(len(keys)):
                self.clear()
            starts, sizes, known = self.look(keys)
            if not known.all():
                new = np.flatnonzero(~known)
                where = np.zeros(len(keys), np.int64)
                where[codes[::-1]] = np.arange(len(codes))[::-1]  # first piece of each key
                raw = own.tobytes()
                self.learn(keys[new], [raw[edges[i] : edges[i + 1]].decode() for i in where[new]])
                starts, sizes, _ = self.look(keys)
            sizes, starts = sizes[codes], starts[codes]
            ends = np.cumsum(sizes)
            ids = self.ids[np.repeat(starts - (ends - sizes), sizes) + np.arange(ends[-1] if len(ends) else 0)]
            rows = np.concatenate(([0], ends))[firsts]
            if end is not None:
                ids = np.insert(ids, rows[1:], np.uint32(end))
                rows = rows + np.arange(len(rows))
            yield ids, rows


class PreTokens(Encoder):
    """
    Pre-tokens of texts, as the tokenizer's own pre-tokenizer cuts them: ``encode`` gives their numbers, ``names`` their
    texts and ``keys`` the hashes of these, valid until the next slice is asked for. Special strings are pre-tokens of their
    own. Only byte-level pre-tokenizers without a normalizer are taken apart; with any other a piece stays whole.
    """

    def __init__(self, path: str, cache: int = CACHE >> 2):
        super().__init__(path, cache)
        with open(path) as file:
            settings = json.load(file)
        added = settings.get("added_tokens") or []
        own = settings.get("pre_tokenizer") or {}
        plain = not any(t.get(flag) for t in added for flag in ("single_word", "lstrip", "rstrip", "normalized"))
        split = own.get("type") == "ByteLevel" and own.get("use_regex", True) and not own.get("add_prefix_space", True)
        self.taken_apart = plain and split and settings.get("normalizer") is None
        contents = sorted((t["content"] for t in added), key=len, reverse=True)
        self.special = re.compile(f"({'|'.join(map(re.escape, contents)) or '(?!)'})")
        self.ascii = re.compile(ASCII_SPLIT)

    def clear(self):
        super().clear()
        self.numbers: dict[str, int] = {}
        self.names: list[str] = []
        self.keys = np.zeros(0, np.uint64)
        self.held = 0

    def full(self, more: int) -> bool:
        return super().full(more) or len(self.names) > self.cache or self.held > HELD

    def split(self, text: str) -> list[str]:
        if not self.taken_apart:
            return [text]
        out = []
        for i, part in enumerate(self.special.split(text)):
            if i % 2:
                out.append(part)
            elif part.isascii():
                out += self.ascii.findall(part)
            else:
                out += [part[a:b] for _, (a, b) in self.tokenizer.pre_tokenizer.pre_tokenize_str(part)]
        return out

    def fresh(self, texts: list[str]) -> tuple[list[int], np.ndarray, np.ndarray]:
        """Order, numbers of pre-tokens and their counts; pieces that can be joined are split as one text, ASCII apart from others."""
        joined = [i for i, t in enumerate(texts) if self.taken_apart and t[0] in " \t\n\r" and not t[-1].isspace()]
        simple = [i for i in joined if texts[i].isascii()]
        rest = sorted(set(joined).difference(simple))
        alone = sorted(set(range(len(texts))).difference(joined))
        parts, sizes = [], []
        for members, at_once in ((simple, JOINED), (rest, JOINED), (alone, 1)):
            for at in range(0, len(members), at_once):
                group = [texts[i] for i in members[at : at + at_once]]
                got = self.split("".join(group))
                begins = np.cumsum([0, *map(len, got)])[:-1]
                edges = np.cumsum([0, *map(len, group)])
                sizes.append(np.diff(np.searchsorted(begins, edges, "left")))
                parts += got
        numbers = np.array([self.numbers.setdefault(part, len(self.numbers)) for part in parts], np.uint32)
        new = list(islice(self.numbers, len(self.names), None))
        if new:
            data, bounds = common.text_buffer(pa.array(new, pa.string()))
            self.keys = np.concatenate((self.keys, words.span_hashes(data, bounds[:-1], bounds[1:])))
            self.names += new
            self.held += sum(map(len, new))
        return simple + rest + alone, numbers, np.concatenate(sizes).astype(np.int64)


_encoders: dict[str, Encoder] = {}
_splitters: dict[str, PreTokens] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which goes on from task to task."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def splitter(path: str) -> PreTokens:
    """The splitter of this Python worker, which goes on from task to task."""
    if path not in _splitters:
        _splitters[path] = PreTokens(path)
    return _splitters[path]
