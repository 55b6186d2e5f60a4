"""Conversation tries against a plain version, in shards of any size."""

import hashlib
import random
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import prefix_trie

COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def plain(rows):
    own = defaultdict(list)
    for conv, turn, role, text in rows:
        if conv is not None:
            role, text = role or "", text or ""
            own[conv].append(((turn is not None, turn or 0, hashlib.md5(f"{len(role)}:{role}{text}".encode()).digest()), (role, text)))
    own = {c: [t for _, t in sorted(turns)] for c, turns in own.items()}
    members, ends = defaultdict(list), defaultdict(list)
    for c in sorted(own):
        h = zlib.crc32(str(c).encode()) % 9
        base = c - (abs(c) % 5) * (1 if c >= 0 else -1)
        whole = tuple(own.get(base, [])[:h] + own[c][h:])
        for d in range(len(whole) + 1):
            members[whole[:d]].append(c)
        ends[whole].append(c)
    children, leaves, saved = defaultdict(int), defaultdict(int), defaultdict(int)
    for node in sorted(members, key=len, reverse=True):
        leaves[node] = leaves[node] or 1
        saved[node] += (len(members[node]) - 1) * (len(node[-1][1].encode()) if node else 0)
        if node:
            children[node[:-1]] += 1
            leaves[node[:-1]] += leaves[node]
            saved[node[:-1]] += saved[node]
    return sorted(
        (m[0], len(n), members[n[:-1]][0] if n else None, len(m), children[n], leaves[n], saved[n], hashlib.sha256(",".join(map(str, ends[n])).encode()).hexdigest())
        for n, m in members.items()
    ) if members else []


def conversations(seed=5, n=150):
    rng, rows = random.Random(seed), []
    for c in range(-20, n):
        for turn in range(rng.choice([0, 1, 2, 3, 5, 9])):
            rows.append((c, turn, rng.choice(["user", "assistant"]), rng.choice(["a", "b", "é日", "a long text"])))
    rows += [(1000 + c, t, "user", f"same {t}") for c in range(60) for t in range(12)]  # copies of one conversation
    rows += [(5000, t, "user", f"turn {t % 7}") for t in range(1500)] + [(5001, t, "user", f"turn {t % 7}") for t in range(900)]
    rows += [(7, None, "user", "x"), (7, None, None, "x"), (7, 0, "user", None), (8, 1, "r", "t"), (8, 1, "r", "t"), (8, 1, "t", "r"), (None, 1, "user", "lost"), (2**62, 0, "rt", ""), (2**62 + 1, 0, "r", "t")]
    rng.shuffle(rows)
    return rows


def frame(spark, rows):
    clashing = [F.lit("x").alias(c) for c in ("key", "number", "size", "numbers", "sizes", "turns", "base", "family", "h", "depth", "ends", "convs")]
    return spark.createDataFrame(rows, "conv_id bigint, turn bigint, role string, text string").repartition(3).select("*", *clashing)


@pytest.mark.parametrize("limit", [3, 40, prefix_trie.SHARD_TURNS])
def test_nodes(llm, limit):
    rows = conversations()
    made = prefix_trie.trie(frame(llm, rows), limit)
    assert made.columns == COLUMNS
    order = lambda r: [(v is None, v) for v in r if not isinstance(v, str)]
    assert sorted((tuple(r) for r in made.collect()), key=lambda r: (order(r), r[-1])) == sorted(plain(rows), key=lambda r: (order(r), r[-1]))


def test_few_rows(llm):
    for rows in ([], [(3, 0, "user", "x")], [(None, 0, "user", "x")], [(0, 0, "", ""), (1, 0, None, None)]):
        assert sorted(map(tuple, prefix_trie.trie(frame(llm, rows)).collect()), key=str) == sorted(plain(rows), key=str)


def test_tree():
    rng = random.Random(6)
    sequences = sorted({tuple(rng.randrange(40) for _ in range(rng.randrange(6))) for _ in range(500)})
    order = list(prefix_trie.median_order(len(sequences)))
    assert sorted(order) == list(range(len(sequences)))
    tree = prefix_trie.TernaryTree()
    at = {s: tree.insert(list(s), [0] * len(s)) for s in (sequences[i] for i in order)}
    assert all(tree.path(list(s))[-1] == node for s, node in at.items())
    walked, parent, depth = tree.walk()
    assert sorted(walked) == list(range(len(tree.number))) and len(walked) == len({s[:d] for s in sequences for d in range(len(s) + 1)})
    place = {node: i for i, node in enumerate(walked)}
    assert all(place[parent[n]] < place[n] and depth[n] == depth[parent[n]] + 1 for n in walked if n)

    # Inserted by medians, the nodes beside each other are searched in about log2 steps.
    wide = prefix_trie.TernaryTree()
    for i in prefix_trie.median_order(1023):
        wide.insert([i], [0])
    heights = [0] * 1024
    for node in range(1023, 0, -1):
        heights[node] = 1 + max([heights[x] for x in (wide.low[node], wide.high[node]) if x >= 0], default=0)
    assert max(heights) == 10
