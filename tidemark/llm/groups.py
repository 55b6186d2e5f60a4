"""Groups of rows that Spark has sorted together, links inside them, and connected components."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common


def whole_groups(batches: Iterator[pa.RecordBatch], key: str, rows: int = 4096, size: int = 32 << 20) -> Iterator[pa.Table]:
    """Tables of whole groups from batches sorted by ``key``: of about so many rows and bytes, or one larger group."""
    waiting: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        waiting.append(batch)
        if sum(b.num_rows for b in waiting) < rows and sum(b.nbytes for b in waiting) < size:
            continue
        keys = batch.column(key).to_numpy()
        start = int(np.searchsorted(keys, keys[-1], "left"))
        if start == 0 and len(waiting) > 1:
            before = waiting[-2].column(key).to_numpy()
            if before[-1] == keys[-1]:
                table = pa.Table.from_batches(waiting)
                start = int(np.searchsorted(table.column(key).to_numpy(), keys[-1], "left"))
                if start:
                    yield table.slice(0, start)
                    waiting = table.slice(start).to_batches()
                continue
        if start or len(waiting) > 1:
            yield pa.Table.from_batches([*waiting[:-1], batch.slice(0, start)])
            waiting = [batch.slice(start)]
    if waiting:
        yield pa.Table.from_batches(waiting)


def group_bounds(keys: np.ndarray) -> np.ndarray:
    return np.concatenate((np.flatnonzero(np.concatenate(([True], keys[1:] != keys[:-1]))), [len(keys)]))


def overlaps(sets: list[np.ndarray], a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Sizes of the intersections of sets[a] and sets[b] (sorted distinct values), for many pairs at once."""
    out = np.zeros(len(a), np.int64)
    if not len(a):
        return out
    used = np.unique(np.concatenate((a, b)))
    place = np.zeros(len(sets), np.int64)
    place[used] = np.arange(len(used))
    sizes = np.array([len(sets[i]) for i in used])
    codes, values = pd.factorize(np.concatenate([sets[i] for i in used]))
    owner = np.repeat(np.arange(len(used)), sizes)
    shared = np.bincount(codes, minlength=len(values)) > 1
    keep = shared[codes]
    codes, owner = (np.cumsum(shared) - 1)[codes[keep]], owner[keep]
    width = int(shared.sum())
    if not width:
        return out
    a, b = place[a], place[b]
    if len(a) * max(1, len(codes) // len(used)) > 20 * len(used) * width and len(used) <= 4096:
        both = np.zeros((len(used), len(used)), np.float32)  # dense: counts are far below 2^24, so they are exact
        for low in range(0, width, 4096):
            block = np.zeros((len(used), min(4096, width - low)), np.float32)
            own = (codes >= low) & (codes < low + 4096)
            block[owner[own], codes[own] - low] = 1
            both += block @ block.T
        return both[a, b].astype(np.int64)
    order = np.argsort(owner * width + codes)
    keys = (owner * width + codes)[order]
    starts = np.searchsorted(keys, np.arange(len(used) + 1) * width)
    small = np.where(np.diff(starts)[a] <= np.diff(starts)[b], a, b)
    large = a + b - small
    n = np.diff(starts)[small]
    for low in range(0, len(a), 1 << 14):
        part = slice(low, low + (1 << 14))
        which = np.repeat(np.arange(len(n[part])), n[part])
        at = np.repeat(starts[small[part]] - np.cumsum(n[part]) + n[part], n[part]) + np.arange(len(which))
        probe = keys[at] % width + large[part][which] * width
        found = np.minimum(np.searchsorted(keys, probe), len(keys) - 1)
        out[part] = np.bincount(which[keys[found] == probe], minlength=len(n[part]))
    return out


def local_roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """For each of n members the smallest member that links a-b connect it with."""
    root = np.arange(n)
    while True:
        low = np.minimum(root[a], root[b])
        new = root.copy()
        np.minimum.at(new, a, low)
        np.minimum.at(new, b, low)
        new = new[new]
        if (new == root).all():
            return root
        root = new


def connected(links: DataFrame, label: str) -> DataFrame:
    """
    Components of undirected links a-b (any type with an order): node and root, the smallest node of its component.

    Large and small stars by turns: nodes are hung onto smaller neighbours until every node hangs on its root. Each round
    is two groupings, written to the shared folder; the number of rounds grows with the logarithm of the graph's size.
    A node with very many neighbours is reduced to a minimum before the shuffle and joined with uneven keys split.
    """
    links = common.written(links.filter("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), f"{label}-links")

    def hung(pairs: DataFrame, large: bool) -> DataFrame:
        both = pairs.unionByName(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))) if large else pairs
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        met = both.join(least, "a")
        if large:
            return met.filter(F.col("b") > F.col("a")).select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b").distinct()
        return met.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).filter("a <> b").distinct()

    def state(pairs: DataFrame):
        return tuple(pairs.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    now = state(links)
    while now[0]:
        links = common.written(hung(hung(links, True), False), f"{label}-round")
        before, now = now, state(links)
        if now == before:
            break
    return links.select(F.col("a").alias("node"), F.col("b").alias("root"))


def in_groups(rows: DataFrame, key: str, make: Callable[[], Callable[[pa.Table], pa.RecordBatch | None]], schema: str, at_once: int = 4096) -> DataFrame:
    """
    Deal rows by ``key`` (bigint), sort them by it and apply a function, made once a task, to tables of whole groups, of
    about ``at_once`` rows.
    """

    def run(batches):
        step = make()
        for table in whole_groups(batches, key, at_once):
            out = step(table.combine_chunks())
            if out is not None and out.num_rows:
                yield out

    return rows.repartition(key).sortWithinPartitions(key).mapInArrow(run, schema)
