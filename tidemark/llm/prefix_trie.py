"""Trie of the shared beginnings of conversations: ternary search trees a range shard, boundary nodes merged."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

FAMILY, MOST_SHARED = 5, 8  # a rebuilt conversation begins with up to 8 turns of the one whose id is the multiple of 5 below
SHARD_TURNS = 100_000  # turns (and conversations) that go into one tree
NO_ENDS = hashlib.sha256(b"").hexdigest()

NUMBERS = ["conv_id", "depth", "n_convs", "n_children", "n_leaves", "saved_tokens"]
SHARD_SCHEMA = ", ".join(f"{c} bigint" for c in NUMBERS) + ", parent_conv_id bigint, ends_sha256 string, own_bytes bigint, key binary, parent_key binary, first_end bigint, ends string"


class TernaryTree:
    """
    Sequences of numbers as a ternary search tree: a node has a number, nodes of smaller and larger numbers at the same
    place, and one of the next place. Node 0 is the empty beginning.
    """

    def __init__(self):
        self.number, self.size, self.low, self.high, self.next = [-1], [0], [-1], [-1], [-1]

    def _new(self, number: int, size: int) -> int:
        self.number.append(number)
        self.size.append(size)
        for links in (self.low, self.high, self.next):
            links.append(-1)
        return len(self.number) - 1

    def insert(self, numbers: list[int], sizes: list[int]) -> int:
        """The node of the whole sequence."""
        node, own, low, high, after = 0, self.number, self.low, self.high, self.next
        for number, size in zip(numbers, sizes, strict=True):
            at, links, place = after[node], after, node
            while at >= 0 and own[at] != number:
                links, place = (low, at) if number < own[at] else (high, at)
                at = links[place]
            if at < 0:
                at = links[place] = self._new(number, size)
            node = at
        return node

    def path(self, numbers: list[int]) -> list[int]:
        nodes = [0]
        for number in numbers:
            at = self.next[nodes[-1]]
            while self.number[at] != number:
                at = self.low[at] if number < self.number[at] else self.high[at]
            nodes.append(at)
        return nodes

    def walk(self) -> tuple[list[int], list[int], list[int]]:
        """Nodes with every parent before its children, and the parent (the node one place before) and depth of each node."""
        parent, depth, order = [-1] * len(self.number), [0] * len(self.number), []
        waiting = [(0, -1)]
        while waiting:
            node, above = waiting.pop()
            order.append(node)
            parent[node], depth[node] = above, depth[above] + 1 if above >= 0 else 0
            for beside in (self.low[node], self.high[node]):
                if beside >= 0:
                    waiting.append((beside, above))
            if self.next[node] >= 0:
                waiting.append((self.next[node], node))
        # A node beside another is at the same depth and never its parent, so order holds parents first.
        return order, parent, depth


def median_order(n: int) -> Iterator[int]:
    """The middle of 0 to n - 1, then the middles of both halves, and so on."""
    ranges = [(0, n)]
    for low, high in ranges:
        if low < high:
            middle = (low + high) // 2
            yield middle
            ranges += [(low, middle), (middle + 1, high)]


def child_key(key: bytes, number: int) -> bytes:
    """128 bits that stand for a beginning of a conversation."""
    return hashlib.blake2b(key + number.to_bytes(8, "big", signed=True), digest_size=16).digest()


def common_length(a: list[int] | None, b: list[int] | None) -> int | None:
    """Length of the common beginning; None where a neighbour is not known."""
    if a is None or b is None:
        return None
    n = min(len(a), len(b))
    return next((i for i in range(n) if a[i] != b[i]), n)


def shard_rows(sequences: list[tuple[list[int], list[int], list[int]]], left: int | None, right: int | None) -> pa.RecordBatch:
    """
    Nodes of one tree, from distinct sequences in ascending order with their sizes and conversations (ascending). Nodes that
    the neighbours may hold too, those of the first ``left`` places of the first sequence and of the first ``right`` places of
    the last one (None: all), have a key and only what this tree adds outside of nodes with a key.
    """
    tree, ends = TernaryTree(), {}
    for i in median_order(len(sequences)):
        ends[tree.insert(sequences[i][0], sequences[i][1])] = sequences[i][2]
    order, parent, depth = tree.walk()
    shared: dict[int, bytes] = {}
    for (numbers, _, _), places in ((sequences[0], left), (sequences[-1], right)):
        key = b""
        for node, number in zip(tree.path(numbers[:places]), [None, *numbers], strict=False):
            key = key if number is None else child_key(key, number)
            shared[node] = key
    n = len(order)
    members, first, children, leaves, saved = [0] * n, [None] * n, [0] * n, [0] * n, [0] * n
    for node in reversed(order):
        own = ends.get(node)
        if own:
            members[node] += len(own)
            first[node] = own[0] if first[node] is None else min(first[node], own[0])
        if node not in shared:
            leaves[node] = leaves[node] or 1
            saved[node] += (members[node] - 1) * tree.size[node]
        above = parent[node]
        if above >= 0:
            members[above] += members[node]
            first[above] = first[node] if first[above] is None else min(first[above], first[node])
            if node not in shared:
                children[above] += 1
                leaves[above] += leaves[node]
                saved[above] += saved[node]

    def joined(node):
        return ",".join(map(str, ends.get(node, ())))

    columns = [[column[node] for node in order] for column in (first, depth, members, children, leaves, saved)]
    own = [node in shared for node in order]
    columns.append([None if s or parent[node] in shared else first[parent[node]] for node, s in zip(order, own, strict=True)])
    columns.append([None if s else hashlib.sha256(joined(node).encode()).hexdigest() if node in ends else NO_ENDS for node, s in zip(order, own, strict=True)])
    columns.append([tree.size[node] for node in order])
    columns.append([shared.get(node) for node in order])
    columns.append([shared.get(parent[node]) for node in order])
    columns.append([ends[node][0] if s and node in ends else None for node, s in zip(order, own, strict=True)])
    columns.append([joined(node) if s and node in ends else None for node, s in zip(order, own, strict=True)])
    types = [pa.int64()] * 7 + [pa.string(), pa.int64(), pa.binary(), pa.binary(), pa.int64(), pa.string()]
    names = [*NUMBERS, "parent_conv_id", "ends_sha256", "own_bytes", "key", "parent_key", "first_end", "ends"]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, types, strict=True)], names)


def shards(batches: Iterator[pa.RecordBatch], limit: int) -> Iterator[pa.RecordBatch]:
    """Trees of about ``limit`` turns or conversations from rows sorted by sequence and conversation."""
    waiting, load, left, last = [], 0, None, None
    for batch in batches:
        numbers, sizes = batch.column("numbers"), batch.column("sizes")
        for i, conv_id in enumerate(batch.column("conv_id").to_pylist()):
            own = numbers[i].as_py()
            if load >= limit:
                right = common_length(last, own)
                yield shard_rows(waiting, left, right)
                waiting, load, left = [], 0, right
            if waiting and own == last:
                waiting[-1][2].append(conv_id)
                load += 1
            else:
                waiting.append((own, sizes[i].as_py(), [conv_id]))
                load += len(own) + 1
            last = own
    if waiting:
        yield shard_rows(waiting, left, None)


def rebuilt(conversations: DataFrame) -> DataFrame:
    """
    conv_id, numbers and sizes of every rebuilt conversation: dictionary ids and UTF-8 bytes of its turns. It is made of the
    first h turns of conversation c - c % 5, h = crc32(c) % 9, and of its own turns after its first h.
    """
    text, role = F.coalesce("text", F.lit("")), F.coalesce("role", F.lit(""))
    key = F.unhex(F.md5(F.concat(F.char_length(role).cast("string"), F.lit(":"), role, text)))
    turns = conversations.filter("conv_id IS NOT NULL").select("conv_id", "turn", key.alias("key"), F.octet_length(text).cast("bigint").alias("size"))
    turns = common.written(turns, "trie-turns")
    dictionary = common.written(turns.groupBy("key").agg(F.first("size").alias("size")).select("key", F.monotonically_increasing_id().alias("number")), "trie-dictionary")
    coded = turns.join(dictionary, "key").select((F.col("conv_id") - F.col("conv_id") % FAMILY).alias("family"), "conv_id", F.struct(F.col("turn").isNotNull().alias("timed"), "turn", "key", "number", "size").alias("turn"))
    # One shuffle by family serves the turns of a conversation and those it takes from another one.
    own = coded.repartition("family").groupBy("family", "conv_id").agg(F.sort_array(F.collect_list("turn")).alias("turns"))
    own = own.select("family", "conv_id", F.transform("turns", lambda t: F.struct(t["number"].alias("number"), t["size"].alias("size"))).alias("turns"))
    families = own.groupBy("family").agg(F.collect_list(F.struct("conv_id", "turns")).alias("convs"), F.first(F.when(F.col("family") == F.col("conv_id"), F.col("turns")), ignorenulls=True).alias("base"))
    one = families.select(F.coalesce("base", F.expr("filter(convs[0].turns, t -> false)")).alias("base"), F.explode("convs").alias("conv"))
    one = one.select("base", "conv.conv_id", "conv.turns", (F.crc32(F.col("conv.conv_id").cast("string")) % (MOST_SHARED + 1)).cast("int").alias("h"))
    one = one.select("conv_id", F.concat(F.slice("base", F.lit(1), F.col("h")), F.slice("turns", F.col("h") + 1, F.size("turns"))).alias("turns"))
    return one.select("conv_id", F.col("turns.number").alias("numbers"), F.col("turns.size").alias("sizes"))


def summed(rows: DataFrame) -> DataFrame:
    """
    Boundary nodes of all shards, one row a key, to whole nodes: what lies outside of boundary nodes is there already, so
    children add theirs to their parents from the deepest on. A task of its own: these are a few nodes a range of the shuffle.
    """
    parts = rows.groupBy("key").agg(
        F.first("parent_key").alias("parent_key"), F.first("depth").alias("depth"), F.first("own_bytes").alias("own_bytes"), F.min("conv_id").alias("conv_id"),
        *[F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")],
    )

    def run(batches):
        tables = [b for b in batches if b.num_rows]
        if not tables:
            return
        table = pa.Table.from_batches(tables).sort_by([("depth", "descending")])
        keys, parents = table.column("key").to_pylist(), table.column("parent_key").to_pylist()
        at = {k: i for i, k in enumerate(keys)}
        first, convs, children, leaves, saved, size = (table.column(c).to_pylist() for c in ("conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "own_bytes"))
        for i, above in enumerate(parents):
            leaves[i] = leaves[i] or 1
            saved[i] += (convs[i] - 1) * size[i]
            if above is not None:
                up = at[above]
                children[up] += 1
                leaves[up] += leaves[i]
                saved[up] += saved[i]
        above = [None if p is None else first[at[p]] for p in parents]
        columns = [first, table.column("depth").to_pylist(), convs, children, leaves, saved, above]
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), *[pa.array(c, pa.int64()) for c in columns]], ["key", *NUMBERS, "parent_conv_id"])

    return parts.repartition(1).mapInArrow(run, "key binary, " + ", ".join(f"{c} bigint" for c in [*NUMBERS, "parent_conv_id"]))


def end_digests(rows: DataFrame) -> DataFrame:
    """
    key and digest of the conversations that end in a boundary node, from its pieces in ascending order. A digest is made
    from first to last, so one task reads all pieces of a node, one after another.
    """

    def run(batches):
        now, digest = None, None
        for batch in batches:
            for key, ends in zip(batch.column("key").to_pylist(), batch.column("ends").to_pylist(), strict=True):
                if key != now:
                    if digest is not None:
                        yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])
                    now, digest = key, hashlib.sha256()
                else:
                    digest.update(b",")
                digest.update(ends.encode())
        if digest is not None:
            yield pa.RecordBatch.from_arrays([pa.array([now], pa.binary()), pa.array([digest.hexdigest()])], ["key", "ends_sha256"])

    return rows.repartition("key").sortWithinPartitions("key", "first_end").select("key", "ends").mapInArrow(run, "key binary, ends_sha256 string")


def trie(conversations: DataFrame, shard_turns: int = SHARD_TURNS) -> DataFrame:
    """
    One row for each node, a distinct beginning of the rebuilt conversations (see ``rebuilt``): conv_id (its smallest member),
    depth, parent_conv_id (null for the root), n_convs (members), n_children, n_leaves (childless nodes below it, or itself),
    saved_tokens (over all nodes below it and itself: members less one times the bytes of the last text) and ends_sha256
    (of the comma-joined ids of the conversations that end there).

    1. Distinct turns (role, text) get dictionary numbers; texts are not shuffled, only their 128-bit digests are.
    2. Sequences of numbers are sorted by ranges, with conv_id, so that copies of one conversation may lie in several ranges.
       A range is cut into shards of bounded size; each becomes a ternary search tree, filled in the order of medians. An iterative
       walk adds up members, leaves and savings.
    3. Nodes that a neighbouring shard may hold, on the way to a shard's first or last sequence, leave it as parts: inside a
       range as far as the next sequence agrees, at its ends the whole way. Parts of a node are summed by its key.
       Their number depends on ranges and depth, not on rows; one task adds them up along the tree.
    4. Nodes below a boundary node get its smallest member by a join.

    Null role or text is empty; turns are ordered by number, null first, equal ones by a digest of role and text. Repeated rows are
    turns of their own. Rows without a conv_id belong to no conversation and are left out. An empty table has no nodes. c % 5 has the
    sign of c. The numbers of one conversation are held in one row (16 bytes a turn). Other columns are ignored.
    """
    common.ready(conversations.sparkSession)
    conversations = common.need(conversations, conv_id="bigint", turn="bigint", role="string", text="string")
    sequences = common.written(rebuilt(conversations), "trie-sequences")
    dealt = sequences.repartitionByRange("numbers", "conv_id").sortWithinPartitions("numbers", "conv_id")
    nodes = common.written(dealt.mapInArrow(lambda batches: shards(batches, shard_turns), SHARD_SCHEMA), "trie-shards")

    out = [*NUMBERS, "parent_conv_id", "ends_sha256"]
    edge = common.written(summed(nodes.filter("key IS NOT NULL")), "trie-edges")
    digests = end_digests(nodes.filter("key IS NOT NULL AND ends IS NOT NULL"))
    edges = edge.join(digests, "key", "left").withColumn("ends_sha256", F.coalesce("ends_sha256", F.lit(NO_ENDS)))
    inner = nodes.filter("key IS NULL")
    below = inner.filter("parent_key IS NOT NULL").drop("parent_conv_id").join(edge.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent_conv_id")), "parent_key")
    found = inner.filter("parent_key IS NULL").select(*out).unionByName(below.select(*out)).unionByName(edges.select(*out))
    return found.select("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
