"""Jaccard join on word shingles: banded MinHash candidates, Bayesian pruning of pairs, exact verification."""

from __future__ import annotations

from math import comb

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common, groups, words

WORDS = 5
THRESHOLD = 0.8
BANDS, ROWS = 32, 4  # a pair at the threshold shares no band with probability (1 - 0.8^4)^32, about 5e-8
STEP = 32  # MinHash values compared between two looks at the posterior
TOLERANCE = 1e-6
BLOCK_ROWS, BLOCK_SHINGLES = 400, 400_000


def least_matches(threshold: float, tolerance: float, step: int, k: int) -> np.ndarray:
    """
    For 0, step, 2 step, ... compared values the least number of matches with which a pair stays: with a uniform prior
    the similarity given m matches of n has a Beta(m + 1, n - m + 1) law, and its chance to reach the threshold is that of
    at most m successes in n + 1 trials.
    """
    out = [0]
    for n in range(step, k + 1, step):
        chance, m = 0.0, -1
        while chance < tolerance:
            m += 1
            chance += comb(n + 1, m) * threshold**m * (1 - threshold) ** (n + 1 - m)
        out.append(m)
    return np.array(out)


def survivors(values: np.ndarray, a: np.ndarray, b: np.ndarray, band: int, least: np.ndarray) -> np.ndarray:
    """Pairs that no look at the posterior drops and whose first common band is ``band`` (others have them as well)."""
    alive = np.arange(len(a))
    matches = np.zeros(len(a), np.int64)
    for k, need in enumerate(least[1:]):
        part = slice(k * STEP, (k + 1) * STEP)
        matches = matches + (values[a[alive], part] == values[b[alive], part]).sum(axis=1)
        stay = matches >= need
        alive, matches = alive[stay], matches[stay]
    same = (values[a[alive]] == values[b[alive]]).reshape(len(alive), BANDS, ROWS).all(axis=2)
    return alive[same.argmax(axis=1) == band] if len(alive) else alive


def candidate_pairs(side: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """All pairs of a block, or of two blocks. A block has a bounded number of members."""
    if low == high:
        return np.triu_indices(len(side), 1)
    first, second = np.flatnonzero(side == low), np.flatnonzero(side == high)
    return np.repeat(first, len(second)), np.tile(second, len(first))


def pruned(table: pa.Table, least: np.ndarray):
    """For each group of the table: its first row, last row and the pairs that survive, in pieces of bounded size."""
    bounds = groups.group_bounds(table.column("g").to_numpy())
    values = np.frombuffer(b"".join(table.column("signature").to_pylist()), np.uint32).reshape(-1, BANDS * ROWS)
    side, low, high, band = (table.column(c).to_numpy() for c in ("side", "low", "high", "band"))
    for at, to in zip(bounds[:-1], bounds[1:], strict=True):
        a, b = candidate_pairs(side[at:to], low[at], high[at])
        kept = [survivors(values[at:to], a[i : i + (1 << 16)], b[i : i + (1 << 16)], band[at], least) + i for i in range(0, len(a), 1 << 16)]
        kept = np.concatenate(kept) if kept else np.zeros(0, np.int64)
        yield at, to, a[kept], b[kept]


def text_keys(docs: DataFrame) -> DataFrame:
    """doc_id, text and two 64-bit hashes that stand for the row (null-safe) and for the text."""
    return docs.select(
        "doc_id", "text", F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("r2"), F.xxhash64("text").alias("t1"), F.xxhash64(F.lit(1), "text").alias("t2"),
    )


def signatures(docs: DataFrame) -> DataFrame:
    """doc_id, r1, r2, n (distinct shingles), d1, d2 (digest of the set of shingles) and signature of every row."""

    def run(batches):
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            for a, b in common.slices(bounds, words.SLICE):
                hashes, _, firsts = words.words(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                values, own = words.shingles(hashes, firsts, WORDS)
                sets = [words.distinct(values[own[i] : own[i + 1]]) for i in range(b - a)]
                n = np.array([len(s) for s in sets])
                flat = words.mix(np.concatenate(sets)) if n.sum() else np.zeros(0, np.uint64)
                sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(flat, dtype=np.uint64)))
                again = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words.mix(flat), dtype=np.uint64)))
                ends = np.concatenate(([0], np.cumsum(n)))
                d1, d2 = (np.diff(x[ends]).view(np.int64) for x in (sums, again))
                found = words.minhash(values, own, BANDS * ROWS)
                columns = [batch.column(c).slice(a, b - a) for c in ("doc_id", "r1", "r2", "t1", "t2")]
                binary = pa.array([found[i].tobytes() if n[i] else None for i in range(b - a)], pa.binary())
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(d1), pa.array(d2), binary], ["doc_id", "r1", "r2", "t1", "t2", "n", "d1", "d2", "signature"])

    return text_keys(docs).mapInArrow(run, "doc_id bigint, r1 bigint, r2 bigint, t1 bigint, t2 bigint, n bigint, d1 bigint, d2 bigint, signature binary")


def blocks(members: Column, shingles: Column) -> Column:
    return F.greatest(F.ceil(members / BLOCK_ROWS), F.ceil(shingles / BLOCK_SHINGLES)).cast("int")


def similar(docs: DataFrame, threshold: float = THRESHOLD, tolerance: float = TOLERANCE) -> DataFrame:
    """
    One row for each document: doc_id, copy_1 and copy_2 (digest of its set of five-word shingles: equal for copies),
    n_links (other documents with Jaccard similarity of at least ``threshold``), class_id (smallest doc_id that links
    connect it with) and keep (true for one row of each class), with the row's hashes r1 and r2.

    1. Each row gets its set's digest and 128 MinHash values. Rows with equal sets are one class from here on, whatever
       their number; classes are what is compared.
    2. Classes that share one of 32 bands meet in a bucket. A bucket with the same members as one of an earlier band is dropped.
    3. Inside a bucket MinHash values are compared 32 at a time; a pair goes when the posterior chance of reaching the
       threshold falls below ``tolerance``. Pairs never become rows: what leaves the task is the members that still have a
       partner, each pair counted in its first common band.
    4. Texts of those members are fetched, and their shingles compared exactly, whole texts.
    5. Links become numbers for each class and a forest of edges, whose components are found by stars.

    A large bucket is split into blocks of bounded size, each pair of blocks a task's work of its own. There is no cap.

    A text of one to four words has one shingle of all its words. Null, empty and blank texts have none: no links, each
    its own class. Repeated rows are copies of each other, and one is kept. Null doc_ids sort first. An empty table gives no
    rows. Other columns are ignored.
    """
    common.ready(docs.sparkSession)
    docs = common.need(docs, doc_id="bigint", text="string")
    rows = common.written(signatures(docs), "join-rows")
    least = least_matches(threshold, tolerance, STEP, BANDS * ROWS)

    classes = common.written(
        rows.filter("n > 0").groupBy("d1", "d2").agg(F.count("*").alias("size"), F.min(F.struct("t1", "t2", "r1", "r2")).alias("text_of"), F.first("n").alias("n"), F.first("signature").alias("signature")),
        "join-classes",
    )
    keys = F.transform(F.sequence(F.lit(0), F.lit(BANDS - 1)), lambda b: F.xxhash64(b, F.substring("signature", b * (4 * ROWS) + 1, F.lit(4 * ROWS))))
    banded = classes.select("d1", "d2", "n", F.posexplode(keys).alias("band", "key"))
    member = F.xxhash64("d1", "d2")
    buckets = banded.groupBy("band", "key").agg(F.count("*").alias("m"), F.sum("n").alias("total"), F.sum(member.cast("decimal(20,0)")).alias("s1"), F.bit_xor(member).alias("s2")).filter("m > 1")
    buckets = buckets.groupBy("m", "total", "s1", "s2").agg(F.min("band").alias("band"), F.min_by("key", "band").alias("key")).select("band", "key", blocks(F.col("m"), F.col("total")).alias("blocks"))
    met = banded.join(buckets, ["band", "key"]).select("d1", "d2", "band", "key", "blocks", F.pmod("d2", "blocks").cast("int").alias("side"))
    met = met.select("*", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    met = met.select("d1", "d2", "band", "side", F.least("side", "other").alias("low"), F.greatest("side", "other").alias("high"), F.xxhash64("band", "key", F.least("side", "other"), F.greatest("side", "other")).alias("g"))
    met = met.join(classes.select("d1", "d2", "signature"), ["d1", "d2"])

    def prune():
        def step(table):
            keep = np.zeros(table.num_rows, bool)
            for at, _, a, b in pruned(table, least):
                keep[at + a] = keep[at + b] = True
            chosen = table.filter(pa.array(keep)).select(["d1", "d2", "band", "side", "low", "high", "g"])
            return chosen.combine_chunks().to_batches()[0] if chosen.num_rows else None

        return step

    place = "d1 bigint, d2 bigint, band int, side int, low int, high int, g bigint"
    left = common.written(groups.in_groups(met, "g", prune, place), "join-candidates")

    # One row for each class that has a partner, with a text that has its shingles.
    wanted = left.select("d1", "d2").distinct().join(classes, ["d1", "d2"]).select("d1", "d2", "size", "signature", "text_of.r1", "text_of.r2")
    texts = common.written(text_keys(docs).select("r1", "r2", "text").join(wanted, ["r1", "r2"]).dropDuplicates(["r1", "r2"]).drop("r1", "r2"), "join-texts")

    def verify():
        def step(table):
            data, bounds = common.text_buffer(table.column("text"))
            sets = []
            for a, b in common.slices(bounds, words.SLICE):
                hashes, _, firsts = words.words(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                values, own = words.shingles(hashes, firsts, WORDS)
                sets += [words.distinct(values[own[i] : own[i + 1]]) for i in range(b - a)]
            n, size = np.array([len(s) for s in sets]), table.column("size").to_numpy()
            d1, d2 = table.column("d1").to_numpy(), table.column("d2").to_numpy()
            found, spans = [], list(pruned(table, least))
            small = [(at + a, at + b) for at, to, a, b in spans if to - at <= 64]
            if small:
                a, b = (np.concatenate(x) for x in zip(*small, strict=True))
                found.append((a, b, overlaps_in(sets, a, b)))
            for at, to, a, b in spans:
                if to - at > 64:
                    found.append((at + a, at + b, groups.overlaps(sets[at:to], a, b)))
            a, b, both = (np.concatenate(x) for x in zip(*found, strict=True))
            linked = both * (1 + threshold) >= threshold * (n[a] + n[b]) - 1e-9
            a, b = a[linked], b[linked]
            links = np.bincount(a, size[b], table.num_rows) + np.bincount(b, size[a], table.num_rows)
            roots = groups.local_roots(table.num_rows, a, b)
            some = np.flatnonzero(links)
            columns = [d1[some], d2[some], links[some].astype(np.int64), d1[roots[some]], d2[roots[some]]]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["d1", "d2", "links", "e1", "e2"])

        def overlaps_in(sets, a, b):
            parts = [groups.overlaps(sets, a[i : i + (1 << 15)], b[i : i + (1 << 15)]) for i in range(0, len(a), 1 << 15)]
            return np.concatenate(parts) if parts else np.zeros(0, np.int64)

        return step

    links = common.written(groups.in_groups(left.join(texts, ["d1", "d2"]), "g", verify, "d1 bigint, d2 bigint, links bigint, e1 bigint, e2 bigint"), "join-links")
    roots = groups.connected(links.select(F.struct("d1", "d2").alias("a"), F.struct(F.col("e1").alias("d1"), F.col("e2").alias("d2")).alias("b")), "join")
    roots = roots.select("node.d1", "node.d2", "root")
    counts = links.groupBy("d1", "d2").agg(F.sum("links").alias("links"))

    own = F.struct("d1", "d2")
    full = rows.filter("n > 0").select("doc_id", "r1", "r2", "d1", "d2")
    full = full.join(classes.select("d1", "d2", "size"), ["d1", "d2"]).join(counts, ["d1", "d2"], "left").join(roots, ["d1", "d2"], "left")
    full = full.select("doc_id", "r1", "r2", "d1", "d2", (F.col("size") - 1 + F.coalesce("links", F.lit(0))).alias("n_links"), F.coalesce("root", own).alias("root"))
    firsts = full.groupBy("root").agg(F.min(F.struct("doc_id", "r1", "r2")).alias("first"))
    known = full.join(firsts, "root").select(
        "doc_id", F.col("d1").alias("copy_1"), F.col("d2").alias("copy_2"), "n_links", F.col("first.doc_id").alias("class_id"),
        ((F.col("r1") == F.col("first.r1")) & (F.col("r2") == F.col("first.r2"))).alias("keep"), "r1", "r2",
    )
    none = rows.filter("n = 0").select("doc_id", F.lit(None).cast("bigint").alias("copy_1"), F.lit(None).cast("bigint").alias("copy_2"), F.lit(0).cast("bigint").alias("n_links"), F.col("doc_id").alias("class_id"), F.lit(True).alias("keep"), "r1", "r2")
    return known.unionByName(none)


def one_of_each(docs: DataFrame) -> DataFrame:
    """
    The columns of ``documents`` for the first document (by doc_id) of each class of near copies. Rows equal in doc_id and
    text count once, texts without words included.
    """
    own = common.need(docs, doc_id="bigint", text="string", lang="string", source="string", n_chars="bigint")
    kept = similar(docs).filter("keep").select("r1", "r2")
    keyed = own.select("*", F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("r2"))
    return keyed.join(kept, ["r1", "r2"], "left_semi").dropDuplicates(["r1", "r2"]).drop("r1", "r2")
