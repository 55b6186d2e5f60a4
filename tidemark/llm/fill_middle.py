"""Fill-in-the-middle: two cuts at unit boundaries, found by ranks over a wavelet matrix of character classes."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common, words
from tidemark.llm.wavelet import WaveletMatrix

MARKS = ("<P>", "<S>", "<M>")
# Classes of the bytes of UTF-8 text. Continuation bytes are told apart so that ranks count code points as well.
OTHER, FEED, BLANK, INNER = range(4)
BITS = 2
_CLASS = np.full(256, OTHER, np.uint8)
_CLASS[[0x20, 0x09, 0x0B, 0x0C, 0x0D]] = BLANK
_CLASS[0x0A] = FEED
_CLASS[0x80:0xC0] = INNER
# A unit ends with a byte of these classes, or with the text; for chars, a unit begins with one.
UNITS = {"lines": (FEED,), "words": (FEED, BLANK), "chars": (OTHER, FEED, BLANK)}


class Boundaries:
    """Unit boundaries of the rows of a byte buffer."""

    def __init__(self, data: np.ndarray, bounds: np.ndarray, unit: str):
        self.starts, self.ends, self.unit = bounds[:-1], bounds[1:], unit
        self.matrix = WaveletMatrix(_CLASS[data], BITS)
        self.before = self.marks(self.starts)
        self.inside = self.marks(self.ends) - self.before
        self.units = self.inside.copy()
        if unit != "chars":
            # What follows the last mark is one more unit: the row has bytes, and its last one is no mark.
            some = self.ends > self.starts
            last = np.where(some, self.marks(self.ends) - self.marks(np.maximum(self.ends - 1, 0)), 1)
            self.units += last == 0

    def marks(self, at: np.ndarray) -> np.ndarray:
        """Bytes before each place that end (or begin) a unit: the ranks of their classes, added up."""
        return sum(self.matrix.rank(c, at) for c in UNITS[self.unit])

    def chars(self, at: np.ndarray) -> np.ndarray:
        """Code points before each place."""
        return at - self.matrix.rank(INNER, at)

    def after(self, k: np.ndarray) -> np.ndarray:
        """For each row the place after its first k units (0 to all), by bisection on the ranks."""
        wanted = k + 1 if self.unit == "chars" else k
        low, high = self.starts.copy(), self.ends.copy()
        while (low < high).any():  # smallest place with so many marks before it
            middle = (low + high) >> 1
            enough = self.marks(middle) - self.before >= wanted
            low, high = np.where(enough | (low >= high), low, middle + 1), np.where(enough, middle, high)
        if self.unit == "chars":
            low = np.where(k < self.units, low - 1, low)
        return np.where(k == 0, self.starts, np.where(k >= self.units, self.ends, low))


def numbers(doc_id: Column, seed: int) -> list[Column]:
    """The first four 8-digit groups of a digest of seed and doc_id (null: no digits), as whole numbers."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint").alias(f"h{i + 1}") for i in range(4)]


def transform(docs: DataFrame, unit: str = "lines", seed: int = 7, rate: int = 100, spm_rate: int = 50) -> DataFrame:
    """
    One row for each document: doc_id, n (units of the text), form, prefix_chars, middle_chars and output.

    A text is cut twice, at boundaries of its units, into prefix, middle and suffix. Units are ``lines`` (up to and with a
    line feed), ``words`` (up to and with a white space character) or ``chars``; what follows the last such mark is one
    more unit. Four numbers h1 to h4 come from a digest of seed and doc_id: the cuts are after h1 % (n + 1) and
    h2 % (n + 1) units, the smaller one first; the form is plain if h3 % 100 >= ``rate``, else spm if h4 % 100 < ``spm_rate``,
    else psm. psm puts out ``<P>`` prefix ``<S>`` suffix ``<M>`` middle, spm ``<S>`` suffix ``<P>`` prefix ``<M>`` middle.

    Each slice of texts gets one wavelet matrix over the classes of its bytes. Sums of ranks are counts of boundaries, of
    which differences at the rows' ends give n; bisection on them finds both cuts of all rows at once; ranks of the
    continuation bytes turn places into code points. Nothing is shuffled.

    Plain texts (also those that are null, empty or contain one of the marks) are put out as they are, null as empty, with
    null prefix_chars and middle_chars. A null doc_id has a digest of the seed alone. Equal doc_ids get equal cuts if their texts
    are equal; repeated rows stay repeated. An empty table gives no rows. Other columns are ignored.
    """
    common.ready(docs.sparkSession)
    if unit not in UNITS:
        raise ValueError(f"unknown unit {unit!r}, known are {', '.join(UNITS)}")
    docs = common.need(docs, doc_id="bigint", text="string")
    marks = [m.encode() for m in MARKS]

    def run(batches):
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            h = [batch.column(f"h{i}").to_numpy() for i in (1, 2, 3, 4)]
            for a, b in common.slices(bounds, words.SLICE):
                own, rows = data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a]
                found = Boundaries(own, rows, unit)
                cuts = [x[a:b] % (found.units + 1) for x in h[:2]]
                first, second = found.after(np.minimum(*cuts)), found.after(np.maximum(*cuts))
                prefix, middle = found.chars(first) - found.chars(rows[:-1]), found.chars(second) - found.chars(first)
                raw, outputs, forms = own.tobytes(), [], []
                chosen, suffix_first = (h[2][a:b] % 100 < rate).tolist(), (h[3][a:b] % 100 < spm_rate).tolist()
                for i, (s, p, m, e) in enumerate(zip(rows[:-1].tolist(), first.tolist(), second.tolist(), rows[1:].tolist(), strict=True)):
                    if not chosen[i] or s == e or any(raw.find(x, s, e) >= 0 for x in marks):
                        forms.append("plain")
                        outputs.append(raw[s:e])
                    elif suffix_first[i]:
                        forms.append("spm")
                        outputs.append(b"".join((marks[1], raw[m:e], marks[0], raw[s:p], marks[2], raw[p:m])))
                    else:
                        forms.append("psm")
                        outputs.append(b"".join((marks[0], raw[s:p], marks[1], raw[m:e], marks[2], raw[p:m])))
                plain = np.array([f == "plain" for f in forms], bool)
                columns = [pa.array(found.units), pa.array(forms, pa.string()), pa.array(prefix, mask=plain), pa.array(middle, mask=plain), pa.array(outputs, pa.string())]
                yield pa.RecordBatch.from_arrays([batch.column("doc_id").slice(a, b - a), *columns], ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    keyed = docs.select("doc_id", "text", *numbers(F.col("doc_id"), seed))
    return keyed.mapInArrow(run, "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, output string")


def restored(output: Column, form: Column) -> Column:
    """
    The text that an output was made from. A text with a mark in it is plain, and no mark can begin in one piece and end
    in the next, so the marks split an output into exactly its pieces.
    """
    piece = F.split(output, "<[PSM]>", -1)
    psm = F.concat(F.get(piece, F.lit(1)), F.get(piece, F.lit(3)), F.get(piece, F.lit(2)))
    spm = F.concat(F.get(piece, F.lit(2)), F.get(piece, F.lit(3)), F.get(piece, F.lit(1)))
    return F.when(form == "psm", psm).when(form == "spm", spm).otherwise(output)
