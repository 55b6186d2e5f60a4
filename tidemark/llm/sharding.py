"""Shards by minimax contiguous partition of groups of equal texts."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

POINTS = 1 << 15  # bounds of groups that the driver looks at in one round


def greedy_cuts(ends: np.ndarray, capacity: int, shards: int) -> np.ndarray | None:
    """Last bound of each shard when each takes as many groups as fit; None if the groups don't fit into the shards."""
    cuts, at = [], 0
    for _ in range(shards):
        place = int(np.searchsorted(ends, at + capacity, "right")) - 1
        if place >= 0 and ends[place] > at:
            at = int(ends[place])
        cuts.append(at)
    return np.array(cuts, np.int64) if at == ends[-1] else None


def smallest_capacity(ends: np.ndarray, low: int, high: int, shards: int) -> int:
    """Binary search for the least capacity from low to high that is enough, given that high is."""
    while low < high:
        middle = (low + high) // 2
        if greedy_cuts(ends, middle, shards) is None:
            low = middle + 1
        else:
            high = middle
    return low


def even_cuts(ends: np.ndarray, capacity: int, shards: int) -> np.ndarray:
    """
    Cuts with no shard above a capacity that is enough, near the places of equal shards. A cut may lie anywhere between
    the first place from which the rest still fits and the last one that the shard before can reach.
    """
    starts, least = np.concatenate(([0], ends[:-1])), [int(ends[-1])]
    for _ in range(shards - 1):  # from the back: the first start from which so many shards reach what follows
        least.append(int(starts[np.searchsorted(starts, least[-1] - capacity, "left")]) if least[-1] > capacity else 0)
    cuts, at, total = [], 0, int(ends[-1])
    for k, first in enumerate(reversed(least), 1):
        place = int(np.searchsorted(ends, at + capacity, "right")) - 1
        last = max(at, int(ends[place])) if place >= 0 else at
        near = int(starts[np.argmin(np.abs(starts - total * k / shards))]) if k < shards else total
        at = min(max(near, first, at), last)
        cuts.append(at)
    return np.array(cuts, np.int64)


def minimax_cuts(groups: DataFrame, shards: int, points: int = POINTS) -> np.ndarray:
    """
    Bounds of the shards with the least possible largest shard. ``groups``: size and before_size, the running total.

    The driver never sees all groups. It gets the last bound of a group in each of at most ``points`` (and as many again)
    equal steps of the running total. Cuts at these bounds alone give a capacity that is surely enough; any smaller one
    cuts each shard at or before the same place. Steps are then halved again and again only where a cut can lie, until
    these places hold every bound of a group, and the search over them is the search over all groups. The cuts are then
    set for that capacity, as evenly as it allows.
    """
    size = F.col("size")
    total, largest = groups.agg(F.max(F.col("before_size") + size), F.max("size")).first()
    if not total:
        return np.zeros(shards, np.int64)
    low = max(int(largest), -(-int(total) // shards))
    end = F.col("before_size") + size
    spots, step = [(0, int(total))], max(1, int(total) // points)
    bounds = np.array([int(total)], np.int64)
    while True:
        inside = F.lit(False)
        for a, b in spots:
            inside = inside | end.between(a, b)
        rows = groups.filter(inside).groupBy(F.floor(end / step)).agg(F.max(end).alias("end"), F.count_distinct(end).alias("n")).toPandas()
        bounds = np.unique(np.concatenate((bounds, rows["end"].to_numpy(np.int64))))
        high = low
        while greedy_cuts(bounds, high, shards) is None:
            high = min(2 * high, int(total))
        high = smallest_capacity(bounds, low, high, shards)
        if high == low or step == 1 or not len(rows) or int(rows["n"].max()) == 1:
            return even_cuts(bounds, high, shards)
        # With a capacity between low and high, cut k lies between what these bounds give for low, and for high plus a step.
        tight, wide = [], []
        for capacity, to in ((low, tight), (high + step, wide)):
            at = 0
            for _ in range(shards):
                place = int(np.searchsorted(bounds, at + capacity, "right")) - 1
                at = int(bounds[place]) if place >= 0 and bounds[place] > at else at
                to.append(at)
        spots = [(a, b) for a, b in zip(tight, wide, strict=True)]
        merged: list[list[int]] = []
        for a, b in sorted(spots):
            if merged and a <= merged[-1][1]:
                merged[-1][1] = max(merged[-1][1], b)
            else:
                merged.append([a, b])
        spots = [(a, b) for a, b in merged]
        step = max(1, min(step // 2, sum(b - a for a, b in spots) // points))


def shard(docs: DataFrame, shards: int = 24, overhead: int = 8) -> DataFrame:
    """
    doc_id, size (UTF-8 bytes of the text plus ``overhead``), text_crc32, law ("bytes"), shard, slot and grown_shard (null).

    Rows with equal texts are one group and stay together. Groups are ordered by their smallest doc_id and cut into
    ``shards`` runs such that the largest run is as small as it can be, the others near an equal share. No shard is larger than an equal share plus the
    largest group. A slot numbers the rows of a shard from 0, by group and doc_id.

    Sizes are added up before the shuffle on the text's digest (SHA-256), so a text held by a third of all rows is one
    row for each task. Running totals are taken by ranges of the order; rows meet their group in a join whose uneven keys
    are split at run time. The driver holds a bounded number of group bounds.

    Null text: size is the overhead, crc 0; such a row equals no other text and is a group of its own. Empty texts are
    equal texts. Null doc_ids come first. Repeated doc_ids are rows of their own. An empty table gives no rows; if there are
    fewer groups than shards, some shards stay empty. Other columns are ignored.
    """
    spark = common.ready(docs.sparkSession)
    text = F.coalesce("text", F.lit(""))
    rows = common.written(
        common.need(docs, doc_id="bigint", text="string").select(
            "doc_id", (F.octet_length(text) + F.lit(overhead)).cast("bigint").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
            F.coalesce(F.sha2(F.col("text").cast("binary"), 256), F.concat(F.lit("null "), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))).alias("digest"),
        ),
        "shard-rows",
    )
    groups = rows.groupBy("digest").agg(F.min("doc_id").alias("first_id"), F.sum("size").alias("size"))
    groups = common.written(common.running_totals(groups, ["first_id", "digest"], ["size"], "shard-groups").select("digest", "first_id", "size", "before_size"), "shard-totals")
    cuts = minimax_cuts(groups, shards)
    # The shard of a group is the number of cuts at or before its start; empty shards repeat the last cut.
    number = sum((F.when(F.col("before_size") >= F.lit(int(c)), 1).otherwise(0) for c in cuts[:-1]), F.lit(0))
    placed = rows.join(groups.select("digest", "first_id", number.cast("int").alias("shard")), "digest").select("doc_id", "size", "text_crc32", "shard", "first_id", "digest", F.lit(1).cast("bigint").alias("one"))
    order = ["shard", "first_id", "digest", "doc_id"]
    numbered = common.written(common.running_totals(placed, order, ["one"], "shard-slots"), "shard-numbered")
    first = numbered.groupBy("shard").agg(F.min("before_one").alias("first"))
    # One row a shard.
    return numbered.join(F.broadcast(first), "shard").select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", (F.col("before_one") - F.col("first")).alias("slot"), F.lit(None).cast("int").alias("grown_shard"),
    )
