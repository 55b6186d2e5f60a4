"""Personal data: base patterns, and spans that a character tagger adds to them."""

from __future__ import annotations

import random
import re
import zlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common
from tidemark.llm.pii_model import KINDS, LENGTH, Tagger, symbols

TRAIN_DOCS = 600  # documents the tagger is trained on, at most
TRAIN_WINDOWS = 5000  # and windows of them, one in five without a span
SURE = 0.95  # least probability of every character's tag in an added span
STRIDE = LENGTH // 2
BLANK = int(symbols(" ")[0])

# The base patterns.
EMAIL_LEFT = re.compile(r"[A-Za-z0-9._%+-]+\Z")
EMAIL_RIGHT = re.compile(r"@[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])[0-9]++\.[0-9]++\.[0-9]++\.[0-9]++")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def luhn(number: str) -> bool:
    total = 0
    for k, c in enumerate(reversed(number)):
        d = int(c) * (1 + k % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def small_parts(numbers: list[str]) -> bool:
    return all(len(n.lstrip("0")) <= 3 and int(n.lstrip("0") or "0") <= 255 for n in numbers)


def emails(text: str) -> list[tuple[int, int]]:
    """Leftmost matches, found from each at sign: the run of local characters before it, and the domain after it."""
    found, end, at = [], 0, text.find("@")
    while at >= 0:
        right = EMAIL_RIGHT.match(text, at)
        if right:
            start = at
            while start > end and text[start - 1] in LOCAL:
                start -= 1
            if start < at:
                found.append((start, right.end()))
                end = right.end()
        at = text.find("@", max(at + 1, end))
    return found


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(kind, start, end) in code points, by kind and start."""
    out = [(0, a, b) for a, b in emails(text)]
    out += [(1, m.start(), m.end()) for m in IP.finditer(text) if small_parts(m.group().split("."))]
    out += [(2, m.start(), m.end()) for m in CARD.finditer(text) if 16 <= len(d := digits(m.group())) <= 19 and luhn(d)]
    out += [(3, m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(digits(m.group())) <= 15]
    return out


def plausible(kind: int, text: str) -> bool:
    """Whether an added span can be of its kind at all."""
    if text != text.strip():
        return False
    numbers = re.findall("[0-9]+", text)
    if kind == 0:
        left, at, right = text.partition("@")
        return bool(at and left.strip() and "." in right and "@" not in right and not right.startswith("."))
    if kind == 1:
        return len(numbers) == 4 and small_parts(numbers)
    if kind == 2:
        return 13 <= len(d := digits(text)) <= 19 and luhn(d)
    return 8 <= len(digits(text)) <= 15 and "\n" not in text


class Piece(NamedTuple):
    """A span as far as a window, or several, show it: [a, b), the probability of each character's tag, and whether a window's end cuts it."""

    kind: int
    a: int
    b: int
    chances: np.ndarray
    cut_left: bool
    cut_right: bool


def last_window(ids: np.ndarray) -> int:
    return max(0, (len(ids) - 1) // STRIDE - 1)


def window_starts(ids: np.ndarray) -> np.ndarray:
    """Starts of the windows of a text: every place near a digit or at sign lies in two of them. Nothing else can be part of a span."""
    signs = np.flatnonzero(((ids >= 0x30 - 0x1F) & (ids <= 0x39 - 0x1F)) | (ids == 0x40 - 0x1F))
    near = np.concatenate([signs + d for d in (-LENGTH // 2, 0, LENGTH // 2)])
    last = last_window(ids)
    return np.unique(np.concatenate([np.clip(near // STRIDE - d, 0, last) for d in (0, 1)])) * STRIDE


def windows(ids: np.ndarray, starts: np.ndarray) -> np.ndarray:
    padded = np.concatenate((ids, np.zeros(LENGTH, ids.dtype)))
    return padded[starts[:, None] + np.arange(LENGTH)]


def tag_row(n: int, spans: list[tuple[int, int, int]]) -> np.ndarray:
    tags = np.zeros(n + LENGTH, np.int64)
    for kind, a, b in spans:
        tags[a:b] = 2 + 2 * kind
        tags[a] = 1 + 2 * kind
    return tags


SYLLABLES = ("an", "be", "co", "da", "el", "fo", "gu", "ha", "in", "jo", "ka", "lu", "me", "no", "or", "pa", "qui", "ra", "so", "te", "un", "vi", "wo", "xe", "ya", "zu")
ENDINGS = ("com", "org", "net", "edu", "de", "fr", "io", "info", "co.uk")


def made_up(rng: random.Random, most: int = 4) -> str:
    name = "".join(rng.choice(SYLLABLES) for _ in range(rng.randrange(1, most)))
    return name + rng.choice(("", "", str(rng.randrange(100))))


def form(kind: int, own: str, rng: random.Random) -> str:
    """A span in one of the other ways in which people write its kind, e-mails with names and hosts of any kind."""
    d = digits(own)
    if kind == 0:
        local = rng.choice((own.partition("@")[0], made_up(rng), f"{made_up(rng)}.{made_up(rng)}", f"{made_up(rng)}_{made_up(rng)}"))
        host = rng.choice(("", "", "mail.", f"mail{rng.randrange(10)}.", f"{made_up(rng)}.")) + made_up(rng) + "." + rng.choice(ENDINGS)
        return local + rng.choice((" @ ", "(@)", "[@]")) + host
    if kind == 1:
        return rng.choice((" . ", "[.]", "(.)")).join(own.split("."))
    if kind == 2:
        return rng.choice((".", " . ", "_")).join(d[i : i + 4] for i in range(0, len(d), 4))
    bare = d[-10:]
    return rng.choice(("00" + own[1:], f"({bare[:3]}) {bare[3:6]}-{bare[6:]}", f"{bare[:3]} {bare[3:6]} {bare[6:]}", own.replace("-", ".").replace("+", "")))


def rewritten(text: str, spans: list[tuple[int, int, int]], turn: int) -> tuple[str, list[tuple[int, int, int]]]:
    """The text with each of its spans in another form, chosen by the turn, so that the tagger does not only know the base patterns."""
    out, new, at, size, rng = [], [], 0, 0, random.Random(turn)
    for kind, a, b in sorted(spans, key=lambda s: s[1]):
        if a < at:
            continue
        own = form(kind, text[a:b], rng)
        out += [text[at:a], own]
        size += a - at
        new.append((kind, size, size + len(own)))
        size += len(own)
        at = b
    return "".join(out) + text[at:], new


def labelled(texts: list[str], limit: int = TRAIN_WINDOWS) -> tuple[np.ndarray, np.ndarray]:
    """
    Windows and tags from base spans, and twice again with the spans rewritten, as a hash of the text says, whatever texts are
    labelled with it; windows without a span stay as they are.
    """
    ids, tags = [], []
    for text in texts:
        turn = zlib.crc32(text.encode())
        for turn in (None, turn, turn + 1):
            spans = base_spans(text)
            # A shorter kind inside a longer one would clear its tags: longer ones are written last.
            own, spans = (text, spans) if turn is None else rewritten(text, spans, turn)
            spans = sorted(spans, key=lambda s: s[2] - s[1])
            row, starts = tag_row(len(own), spans), window_starts(symbols(own))
            if not len(starts) or (turn is not None and not spans):
                continue
            ids.append(windows(symbols(own), starts))
            tags.append(row[starts[:, None] + np.arange(LENGTH)])
    if not ids:
        return np.zeros((0, LENGTH), np.int16), np.zeros((0, LENGTH), np.int64)
    ids, tags = np.concatenate(ids), np.concatenate(tags)
    # A window that begins inside a span can't be told from one that begins with it.
    tags[:, 0] = np.where((tags[:, 0] > 0) & (tags[:, 0] % 2 == 0), tags[:, 0] - 1, tags[:, 0])
    order = np.random.default_rng(3).permutation(len(ids))[:limit]
    return ids[order], tags[order]


def train(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> Tagger | None:
    """
    A tagger trained on the base spans of at most ``train_docs`` documents that have a digit or at sign, the first by a
    hash of the row; None if they hold no span. A long text gives at most a tenth of
    TRAIN_WINDOWS windows, and at most TRAIN_WINDOWS are used in all.
    """
    signed = docs.filter(F.col("text").rlike("[0-9@]")).select("text", F.xxhash64("text", "doc_id").alias("place"))
    # The hashes alone are ordered; texts are read again for the few that are chosen.
    last = signed.select("place").orderBy("place").limit(train_docs).agg(F.max("place")).first()[0]
    rows = signed.filter(F.col("place") <= F.lit(last)).limit(train_docs)

    def cut(batches):
        for batch in batches:
            for text in batch.column("text").to_pylist():
                ids, tags = labelled([text], TRAIN_WINDOWS // 10)
                if len(ids):
                    yield pa.RecordBatch.from_arrays([pa.array([ids.astype(np.int16).tobytes()], pa.binary()), pa.array([tags.astype(np.int8).tobytes()], pa.binary())], ["ids", "tags"])

    found = rows.select("text").mapInArrow(cut, "ids binary, tags binary").collect()
    if not found:
        return None
    ids = np.concatenate([np.frombuffer(r["ids"], np.int16).reshape(-1, LENGTH) for r in found])
    tags = np.concatenate([np.frombuffer(r["tags"], np.int8).reshape(-1, LENGTH) for r in found]).astype(np.int64)
    order = np.random.default_rng(3).permutation(len(ids))
    spanned = tags[order].any(axis=1)
    if not spanned.any():
        return None
    order = np.concatenate((order[spanned][: TRAIN_WINDOWS - TRAIN_WINDOWS // 5], order[~spanned][: TRAIN_WINDOWS // 5]))
    order = np.random.default_rng(4).permutation(order)
    tagger = Tagger()
    tagger.fit(ids[order].astype(np.int64), tags[order])
    return tagger


def window_pieces(tags: np.ndarray, chances: np.ndarray, start: int, last: int) -> list[Piece]:
    """Spans of the window at ``start``, in places of the text; the text's last window is at ``last``."""
    out = []
    for at in np.flatnonzero((tags > 0) & (tags % 2 == 1)):
        kind, end = (int(tags[at]) - 1) // 2, at + 1
        while end < LENGTH and tags[end] == 2 + 2 * kind:
            end += 1
        out.append(Piece(kind, start + int(at), start + int(end), chances[at:end], at == 0 and start > 0, end == LENGTH and start < last))
    return out


def union(p: Piece, q: Piece) -> Piece | None:
    """One span of a window's piece and one of the next window, if they are of a kind, overlap, and a window's end cuts one of them."""
    if p.kind != q.kind or p.b <= q.a or q.b <= p.a or not (p.cut_right or q.cut_left):
        return None
    a = p.a if q.cut_left else min(p.a, q.a)
    b = q.b if p.cut_right else max(p.b, q.b)
    # A character in both windows is as sure as the window that sees more of its surroundings makes it.
    chances = np.zeros(b - a)
    for x in (p, q):
        low, high = max(a, x.a), min(b, x.b)
        chances[low - a : high - a] = np.maximum(chances[low - a : high - a], x.chances[low - x.a : high - x.a])
    return Piece(p.kind, a, b, chances, p.cut_left, q.cut_right)


def whole_spans(pieces: dict[int, list[Piece]]) -> list[tuple[Piece, bool]]:
    """Spans that no window's end cuts, and whether they are joined, from each window's pieces: neighbours' pieces are joined from left to right."""
    out, before, before_start = [], [], 0
    for start in sorted(pieces):
        now = []
        for q in pieces[start]:
            joined = [u for p in (before if start - before_start == STRIDE else []) if (u := union(p, q))]
            out += [(u, True) for u in joined]
            out.append((q, False))
            now += [*joined, q]
        before, before_start = now, start
    return [(p, joined) for p, joined in out if not (p.cut_left or p.cut_right)]


def reconcile(found: list[tuple[float, int, int, int]], base: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Of the windows' spans (probability, start, end, kind) those that stand: the surest first, none over a base span or a surer one."""
    taken = sorted((a, b) for _, a, b in base)
    out = []
    for chance, a, b, kind in sorted(set(found), key=lambda f: (-f[0], f[1], f[2], f[3])):
        if chance >= SURE and all(b <= x or y <= a for x, y in taken):
            taken.append((a, b))
            out.append((kind, a, b))
    return out


def find(docs: DataFrame, train_docs: int = TRAIN_DOCS) -> DataFrame:
    """
    doc_id, base and added for every document: arrays of spans (kind, start, stop) in code points, stop exclusive, by kind
    (email, ip, card, phone) and start.

    Base spans come from the four patterns over the whole text. A tagger trained on base spans of a bounded sample reads
    windows of 64 characters, overlapping by half, around every digit and at sign of the whole text, without which no
    span of the four kinds can be. Windows are decoded for themselves. What neighbouring windows show of a span that a
    window's end cuts is joined, whatever its length (further windows are read where it goes on), and of the whole spans the
    surest stand, none over another or over a base span. An added span
    must be of a form its kind can have and sure in every character.

    One narrow pass; the tagger's weights (0.1 MB) go to every task. Memory follows the longest text.

    Null or empty text: no spans. Repeated rows get equal spans; a null doc_id stays null. An empty table gives no rows, a
    table without any span adds none. Other columns are ignored.
    """
    spark = common.ready(docs.sparkSession)
    docs = common.need(docs, doc_id="bigint", text="string")
    tagger = train(docs, train_docs)
    sent = spark.sparkContext.broadcast(tagger.weights if tagger else None)

    def run(batches):
        own = Tagger(sent.value) if sent.value else None
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            signs = np.concatenate(([0], np.cumsum(((data >= 0x30) & (data <= 0x39)) | (data == 0x40))))
            some = np.flatnonzero(np.diff(signs[bounds]))
            base: list[list] = [[] for _ in range(batch.num_rows)]
            added: list[list] = [[] for _ in range(batch.num_rows)]
            for at in range(0, len(some), 64):
                rows = some[at : at + 64]
                texts = [data[bounds[r] : bounds[r + 1]].tobytes().decode() for r in rows]
                for r, text in zip(rows, texts, strict=True):
                    base[r] = base_spans(text)
                if own is not None:
                    for r, text, more in zip(rows, texts, extra(own, texts, [base[r] for r in rows]), strict=True):
                        added[r] = more
            kinds = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("stop", pa.int64())]))
            columns = [pa.array([[(KINDS[k], a, b) for k, a, b in sorted(s)] for s in spans], kinds) for spans in (base, added)]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], ["doc_id", "base", "added"])

    spans = "array<struct<kind: string, start: bigint, stop: bigint>>"
    return docs.mapInArrow(run, f"doc_id bigint, base {spans}, added {spans}")


def extra(tagger: Tagger, texts: list[str], base: list[list[tuple[int, int, int]]], batch: int = 512) -> list[list[tuple[int, int, int]]]:
    """Added spans of each text."""
    # A blank on both sides: the text's own ends are no window's ends.
    all_ids = [np.concatenate(([BLANK], symbols(t), [BLANK])).astype(np.int16) for t in texts]
    lasts = [last_window(i) * STRIDE for i in all_ids]
    pieces: list[dict[int, list[Piece]]] = [{} for _ in texts]
    wanted = [window_starts(i) for i in all_ids]
    read = [set(s.tolist()) for s in wanted]
    while any(len(s) for s in wanted):
        owner = np.repeat(np.arange(len(texts)), [len(s) for s in wanted])
        place = np.concatenate(wanted)
        more: list[set[int]] = [set() for _ in texts]
        for at in range(0, len(owner), batch):
            who, where = owner[at : at + batch], place[at : at + batch]
            ids = np.concatenate([windows(all_ids[w], where[who == w]) for w in np.unique(who)]).astype(np.int64)
            tags, chances = tagger.decode(ids)
            for k in np.flatnonzero(tags.any(axis=1)):
                w, start = int(who[k]), int(where[k])
                pieces[w][start] = window_pieces(tags[k], chances[k], start, lasts[w])
                # A span may go on where no digit or at sign is near.
                for p in pieces[w][start]:
                    more[w] |= {n for n, cut in ((start - STRIDE, p.cut_left), (start + STRIDE, p.cut_right)) if cut and n not in read[w]}
        for own, new in zip(read, more, strict=True):
            own |= new
        wanted = [np.array(sorted(new), np.int64) for new in more]
    out = []
    for text, own, spans in zip(texts, pieces, base, strict=True):
        found, joined = [], []
        for p, is_joined in whole_spans(own):
            a, b = max(p.a - 1, 0), min(p.b - 1, len(text))
            if a < b and plausible(p.kind, text[a:b]):
                found.append((round(float(p.chances.min()), 4), a, b, p.kind))
                if is_joined and found[-1][0] >= SURE:
                    joined.append(found[-1])
        # What a window has of a span that is sure as a whole is no span of its own.
        parts = {f for f in found for _, a, b, kind in joined if f[3] == kind and a <= f[1] and f[2] <= b and (a, b) != (f[1], f[2])}
        out.append(reconcile([f for f in found if f not in parts], spans))
    return out


def of_kind(spans: Column | str, kind: str) -> Column:
    return F.filter(spans, lambda s: s["kind"] == kind)


def joined(spans: Column) -> Column:
    """kind:start:stop of the spans, by kind as listed and start, with commas."""
    ordered = F.flatten(F.array(*[F.array_sort(of_kind(spans, k)) for k in KINDS]))
    return F.array_join(F.transform(ordered, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["stop"].cast("string"))), ",")
