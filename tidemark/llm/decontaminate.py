"""Benchmark items inside documents: MinHash containment search partitioned by item size, verified by exact containment."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common, words

WORDS = 5
THRESHOLD = 0.8
FUNCTIONS = 64

# ASCII letters in lower case; everything else of ASCII but digits separates words.
NORMAL = np.arange(256, dtype=np.uint8)
NORMAL[:128] = 0x20
for _c in b"abcdefghijklmnopqrstuvwxyz0123456789":
    NORMAL[_c] = _c
for _c in b"ABCDEFGHIJKLMNOPQRSTUVWXYZ":
    NORMAL[_c] = _c + 32


def item_class(n: np.ndarray) -> np.ndarray:
    """Items of 2^c to 2^(c+1) - 1 distinct shingles are of class c."""
    return np.floor(np.log2(np.maximum(n, 1))).astype(np.int64)


def keys(kind: int, function: int, values: np.ndarray) -> np.ndarray:
    return words.mix((values.astype(np.uint64) | np.uint64(((kind << 8) | function) << 32)))


def turned(low: np.ndarray, high: np.ndarray, a: np.uint32, b: np.uint32) -> np.ndarray:
    return ((low * a + b) ^ high) * a


def shingled(data: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    hashes, _, firsts = words.words(NORMAL[data], rows)
    return words.shingles(hashes, firsts, WORDS, short_rows=False)


def item_keys(items: DataFrame) -> DataFrame:
    """item_id, item (hash of the row), n (distinct shingles), kind (size class), shingles and keys (one for each function)."""

    def run(batches):
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            for a, b in common.slices(bounds, words.SLICE):
                values, own = shingled(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                sets = [words.distinct(values[own[i] : own[i + 1]]) for i in range(b - a)]
                n = np.array([len(s) for s in sets])
                kinds = item_class(n)
                found = []
                for s, kind in zip(sets, kinds, strict=True):
                    low, high = s.astype(np.uint32), (s >> np.uint64(32)).astype(np.uint32)
                    found.append([int(keys(int(kind), f, turned(low, high, x, y).min(keepdims=True)).view(np.int64)[0]) for f, (x, y) in enumerate(zip(*words.minhash_constants(FUNCTIONS), strict=True))] if len(s) else [])
                columns = [batch.column("item_id").slice(a, b - a), batch.column("item").slice(a, b - a), pa.array(n), pa.array(kinds.astype(np.int32)), pa.array([s.view(np.int64) for s in sets], pa.list_(pa.int64())), pa.array(found, pa.list_(pa.int64()))]
                yield pa.RecordBatch.from_arrays(columns, ["item_id", "item", "n", "kind", "shingles", "keys"])

    keyed = common.need(items, item_id="bigint", text="string").select("item_id", F.xxhash64("item_id", "text").alias("item"), "text").dropDuplicates(["item"])
    return keyed.mapInArrow(run, "item_id bigint, item bigint, n bigint, kind int, shingles array<bigint>, keys array<bigint>").filter("n > 0")


def window_keys(values: np.ndarray, own: np.ndarray, kinds: list[int], wanted) -> tuple[np.ndarray, np.ndarray]:
    """
    Rows and keys of all windows whose key is wanted. For size class c, windows of 2^(c+2) shingles begin every 2^(c+1)
    shingles of a document, so a passage no longer than 2^(c+1) lies in one of them as a whole, wherever it stands.
    """
    rows, found = [np.zeros(0, np.int64)], [np.zeros(0, np.uint64)]
    full = np.flatnonzero(np.diff(own))
    if not len(full):
        return rows[0], found[0]
    low, high = values.astype(np.uint32), (values >> np.uint64(32)).astype(np.uint32)
    layouts, n = [], np.diff(own)[full]
    for kind in kinds:
        size = 1 << (kind + 1)
        count = -(-n // size)
        row = np.repeat(np.arange(len(full)), count)
        number = np.arange(len(row)) - np.repeat(np.cumsum(count) - count, count)
        last = np.append(row[1:] != row[:-1], True)
        if not layouts:
            at = own[:-1][full][row] + number * size
        else:  # blocks of the class before, joined
            ratio = 1 << (kind - kinds[len(layouts) - 1])
            at = (np.cumsum(layouts[-1][3]) - layouts[-1][3])[row] + number * ratio
        layouts.append((at, row, last, count))
    for f, (x, y) in enumerate(zip(*words.minhash_constants(FUNCTIONS), strict=True)):
        least = turned(low, high, x, y)
        for kind, (at, row, last, _) in zip(kinds, layouts, strict=True):
            least = np.minimum.reduceat(least, at)
            window = np.where(last, least, np.minimum(least, np.append(least[1:], least[-1:])))
            key = keys(kind, f, window)
            hit = np.flatnonzero(wanted(key))
            if len(hit):
                rows.append(full[row[hit]])
                found.append(key[hit])
    return np.concatenate(rows), np.concatenate(found)


def contaminated(docs: DataFrame, items: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """
    One row for each document and item of which it holds enough: doc_id, item_id, n_shingles (of the item), n_shared,
    containment (n_shared / n_shingles, at least ``threshold``), and the row hashes r1, r2 of the document and item.

    Words are runs of letters and digits, ASCII letters in lower case; shingles have five words. A short item has next to
    no Jaccard similarity with a long document, so documents are searched in windows: items are partitioned by size, and
    for each class windows of four to eight times its least size cover the whole text, overlapping by half. Item and
    window share a MinHash value with a chance of at least their similarity (0.19 for a contained share of 0.8 in one
    window), and 64 functions miss such a pair once in a million.

    Windows never leave the task unless a Bloom filter of fixed size, made from the items' keys, knows one of their keys;
    joins with the items' own keys and shingles decide what is a candidate and what is contained. Neither items nor documents
    are sent to all tasks, so both may be many; an item that a third of all documents hold is a join with one row on
    one side, which is split at run time.

    Items of fewer than five words, null or empty ones match nothing. Null or empty texts hold nothing. Repeated documents
    (equal doc_id and text) and repeated items (equal item_id and text) count once; items of equal text and different
    item_id give a row each. Empty tables give no rows. Other columns are ignored.
    """
    spark = common.ready(docs.sparkSession)
    items = common.written(item_keys(items), "decon-items")
    kinds = sorted(r[0] for r in items.select("kind").distinct().collect())  # at most one for each power of two
    by_key = items.select("item", F.explode("keys").alias("value"))
    by_shingle = items.select("item", F.explode("shingles").alias("value"))
    sent = spark.sparkContext.broadcast((common.bloom(by_key, "value"), common.bloom(by_shingle, "value")))
    keyed = common.need(docs, doc_id="bigint", text="string").select("doc_id", "text", F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("r2"))

    def search(batches):
        key_field, shingle_field = map(common.bloom_field, sent.value)
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            for a, b in common.slices(bounds, words.SLICE):
                values, own = shingled(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                rows, found = window_keys(values, own, kinds, lambda x: common.in_bloom(key_field, x))
                some = np.zeros(b - a, bool)
                some[rows] = True
                owner = np.repeat(np.arange(b - a), np.diff(own))
                known = np.flatnonzero(some[owner] & common.in_bloom(shingle_field, values))
                row = np.concatenate((rows, owner[known]))
                value = np.concatenate((found, values[known])).view(np.int64)
                kind = np.concatenate((np.zeros(len(rows), bool), np.ones(len(known), bool)))
                order = np.lexsort((value, kind, row))
                if len(order):
                    new = np.concatenate(([True], (row[order][1:] != row[order][:-1]) | (kind[order][1:] != kind[order][:-1]) | (value[order][1:] != value[order][:-1])))
                    order = order[new]
                which = pa.array(row[order] + a)
                yield pa.RecordBatch.from_arrays([*[batch.column(c).take(which) for c in ("doc_id", "r1", "r2")], pa.array(kind[order]), pa.array(value[order])], ["doc_id", "r1", "r2", "shingle", "value"])

    hits = common.written(keyed.mapInArrow(search, "doc_id bigint, r1 bigint, r2 bigint, shingle boolean, value bigint"), "decon-hits")
    pairs = hits.filter("not shingle").join(by_key, "value").select("doc_id", "r1", "r2", "item").distinct()
    own = hits.filter("shingle").select("r1", "r2", "value").distinct()
    shared = pairs.join(by_shingle, "item").join(own, ["r1", "r2", "value"]).groupBy("doc_id", "r1", "r2", "item").agg(F.count("*").alias("n_shared"))
    full = shared.join(items.select("item", "item_id", "n"), "item").filter(F.col("n_shared") >= threshold * F.col("n") - 1e-9)
    return full.select("doc_id", "item_id", F.col("n").alias("n_shingles"), "n_shared", (F.col("n_shared") / F.col("n")).alias("containment"), "r1", "r2", "item")


def without_contaminated(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The columns of ``documents`` for the documents that hold no item."""
    own = common.need(docs, doc_id="bigint", text="string", lang="string", source="string", n_chars="bigint")
    keyed = own.select("*", F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("r2"))
    return keyed.join(contaminated(docs, items).select("r1", "r2").distinct(), ["r1", "r2"], "left_anti").drop("r1", "r2")
