"""Near-duplicate documents: fast similarity sketches, banding, exact links between sets of shingles, components."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common, groups, sketches, words

WORDS, THRESHOLD = 4, 0.8
BANDS, ROWS = 32, 4  # a pair at the threshold shares no band with probability (1 - 0.8^4)^32, about 5e-8
ENTRIES = BANDS * ROWS
LEAST_EQUAL = 76  # of 128 bytes of two sketches; a pair at the threshold has 102 on average, and fewer than 76 with a chance below 1e-7
STAR_ROWS = 4096  # members compared with one representative in one group
BLOCK_ROWS, BLOCK_SHINGLES = 400, 400_000  # of a block whose members are compared with each other

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def keyed(docs: DataFrame) -> DataFrame:
    """doc_id, text and two 64-bit hashes that stand for the row."""
    return docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("r2"))


def shingle_sets(data: np.ndarray, rows: np.ndarray, n: int) -> list[np.ndarray]:
    """Sorted distinct hashes of the n-word shingles of each row, A-Z lower-cased."""
    hashes, _, firsts = words.words(_LOWER[data], rows)
    values, own = words.shingles(hashes, firsts, n)
    return [words.distinct(values[own[i] : own[i + 1]]) for i in range(len(rows) - 1)]


def may_differ(n: np.ndarray, threshold: float) -> np.ndarray:
    """Whether a set of n elements can be similar to another one: the nearest has one element more."""
    return n >= threshold * (n + 1) - 1e-9


def document_rows(docs: DataFrame, n_words: int, threshold: float) -> DataFrame:
    """
    doc_id, r1, r2, n (distinct shingles) and d1, d2 (digest of the set) of every row; sketch (a byte an entry) and bands
    of those sets that can be similar to another one, for the first row of a set that the task meets.
    """
    names = ["doc_id", "r1", "r2", "n", "d1", "d2", "sketch", "bands"]

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            for a, b in common.slices(bounds, words.SLICE):
                sets = shingle_sets(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], n_words)
                n = np.array([len(s) for s in sets], np.int64)
                flat, ends = np.concatenate(sets), np.concatenate(([0], np.cumsum(n)))
                mixed = words.mix(flat)
                sums = (np.concatenate((np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)))[ends] for x in (mixed, words.mix(mixed ^ words.mix(mixed >> np.uint64(7)))))
                d1, d2 = (np.diff(x).view(np.int64) for x in sums)
                new = np.array([ok and d not in seen and not seen.add(d) for d, ok in zip(d1.tolist(), (may_differ(n, threshold) & (n > 0)).tolist(), strict=True)], bool)
                chosen = np.flatnonzero(new)
                made = sketches.sketches(np.concatenate([sets[i] for i in chosen]) if len(chosen) else flat[:0], np.concatenate(([0], np.cumsum(n[chosen]))), ENTRIES)
                short, bands = sketches.short(made), sketches.band_keys(made, ROWS).view(np.int64)
                at = np.cumsum(new) - 1
                sketch = pa.array([short[at[i]].tobytes() if new[i] else None for i in range(b - a)], pa.binary())
                offsets = pa.array(np.concatenate(([0], np.cumsum(new * BANDS))).astype(np.int32))
                lists = pa.ListArray.from_arrays(offsets, pa.array(bands.ravel()))
                columns = [batch.column(c).slice(a, b - a) for c in ("doc_id", "r1", "r2")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(n), pa.array(d1), pa.array(d2), sketch, lists], names)

    return keyed(docs).mapInArrow(run, "doc_id bigint, r1 bigint, r2 bigint, n bigint, d1 bigint, d2 bigint, sketch binary, bands array<bigint>")


def byte_rows(column) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(-1, ENTRIES)


def near_in_size(a: np.ndarray, b: np.ndarray, threshold: float) -> np.ndarray:
    return np.minimum(a, b) >= threshold * np.maximum(a, b) - 1e-9


def heads_of(table: pa.Table) -> np.ndarray:
    """For each row the row of its group whose node is the group's representative."""
    g = table.column("g").to_numpy()
    bounds = groups.group_bounds(g)
    heads = np.flatnonzero(table.column("node").to_numpy() == table.column("head").to_numpy())
    # Groups are made of (head, part): a hash of both may coincide, so a group may have two heads.
    group = np.searchsorted(bounds, np.arange(len(g)), "right") - 1
    pairs = {(group[i], h): i for i, h in zip(heads.tolist(), table.column("head").to_numpy()[heads].tolist(), strict=True)}
    return np.array([pairs[k] for k in zip(group.tolist(), table.column("head").to_pylist(), strict=True)], np.int64)


def like_heads(threshold: float):
    """Members whose sketch and size allow that they are similar to the representative."""

    def step(table):
        head, sketch, n = heads_of(table), byte_rows(table.column("sketch")), table.column("n").to_numpy()
        ok = ((sketch == sketch[head]).sum(axis=1) >= LEAST_EQUAL) & near_in_size(n, n[head], threshold)
        chosen = np.flatnonzero(ok & (head != np.arange(len(head))))
        return pa.RecordBatch.from_arrays([table.column(c).combine_chunks().take(pa.array(chosen)) for c in ("head", "node")], ["head", "node"]) if len(chosen) else None

    return lambda: step


def sets_in(table: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    """Elements of all rows' sets, and where each row's begin."""
    column = table.column("elements").to_pylist()
    return np.frombuffer(b"".join(column), np.uint64), np.concatenate(([0], np.cumsum([len(x) // 8 for x in column])))


def linked_heads(threshold: float):
    """Members that are similar to the representative: intersections of whole sets."""

    def step(table):
        head, (flat, at) = heads_of(table), sets_in(table)
        out = []
        order = np.argsort(head, kind="stable")
        bounds = groups.group_bounds(head[order])
        for low, high in zip(bounds[:-1], bounds[1:], strict=True):
            rows = order[low:high]
            h = head[rows[0]]
            own = flat[at[h] : at[h + 1]]
            members = rows[rows != h]
            if not len(members):
                continue
            sizes = at[members + 1] - at[members]
            all_ = np.concatenate([flat[at[m] : at[m + 1]] for m in members])
            place = np.minimum(np.searchsorted(own, all_), len(own) - 1)
            both = np.add.reduceat((own[place] == all_).astype(np.int64), np.cumsum(sizes) - sizes)
            out.append(members[both * (1 + threshold) >= threshold * (sizes + len(own)) - 1e-9])
        chosen = np.concatenate(out) if out else np.zeros(0, np.int64)
        return pa.RecordBatch.from_arrays([table.column(c).combine_chunks().take(pa.array(chosen)) for c in ("node", "head")], ["a", "b"]) if len(chosen) else None

    return lambda: step


def stars(pairs: DataFrame, payload: DataFrame, make, schema: str, shingles: int | None) -> DataFrame:
    """
    Apply a step to groups of a representative (head) and members (node), each with its payload. A representative with many
    members, or with members of many shingles, is repeated in several groups.
    """
    pairs = pairs.join(payload.select("node", "n"), "node") if shingles else pairs.withColumn("n", F.lit(0).cast("bigint"))
    sizes = pairs.groupBy("head").agg(F.greatest(F.ceil(F.count("*") / STAR_ROWS), F.ceil(F.sum("n") / (shingles or 1)) if shingles else F.lit(1)).cast("int").alias("parts"))
    members = pairs.join(sizes, "head").select("head", "node", F.pmod(F.xxhash64("node"), "parts").cast("int").alias("part"))
    # A member alone with its head is in a group with it; heads of parts that got no member make groups of one.
    heads = sizes.select("head", F.col("head").alias("node"), F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part"))
    placed = members.unionByName(heads).select("head", "node", F.xxhash64("head", "part").alias("g"))
    return groups.in_groups(placed.join(payload, "node"), "g", make, schema)


def unlike(table: pa.Table, threshold: float):
    """
    For each group (a block, or two blocks that meet): first row, last row, and the pairs of different components whose
    sketches and sizes allow similarity, those of two blocks across them only, in the first band that both have in common.
    """
    g, component, n = (table.column(c).to_numpy() for c in ("g", "component", "n"))
    side, low, high, key = (table.column(c).to_numpy() for c in ("side", "low", "high", "key"))
    sketch = byte_rows(table.column("sketch"))
    bands = table.column("bands").combine_chunks()
    bands = bands.flatten().to_numpy().reshape(-1, BANDS)
    bounds = groups.group_bounds(g)
    for at, to in zip(bounds[:-1], bounds[1:], strict=True):
        if (component[at:to] == component[at]).all():
            continue
        out_a, out_b = [], []
        for i in range(at, to - 1):
            others = np.arange(i + 1, to)
            ok = (component[others] != component[i]) & near_in_size(n[others], n[i], threshold) & ((low[i] == high[i]) | (side[others] != side[i]))
            others = others[ok]
            others = others[(sketch[others] == sketch[i]).sum(axis=1) >= LEAST_EQUAL]
            if len(others):
                same = bands[others] == bands[i]
                others = others[same.any(axis=1) & (bands[i][same.argmax(axis=1)] == key[i])]
                out_a.append(np.full(len(others), i))
                out_b.append(others)
        if out_a:
            yield at, to, np.concatenate(out_a), np.concatenate(out_b)


def with_partners(threshold: float):
    """Members that have a possible partner in another component."""

    def step(table):
        keep = np.zeros(table.num_rows, bool)
        for _, _, a, b in unlike(table, threshold):
            keep[a] = keep[b] = True
        chosen = table.filter(pa.array(keep)).select(["g", "node", "component", "key", "side", "low", "high"])
        return chosen.combine_chunks().to_batches()[0] if chosen.num_rows else None

    return lambda: step


def joined_components(threshold: float):
    """Links that join components: pairs are tried until all of a group's have become one component or are unlike."""

    def step(table):
        flat, starts = sets_in(table)
        sets = [flat[starts[i] : starts[i + 1]] for i in range(table.num_rows)]
        n, component = np.diff(starts), table.column("component").to_numpy()
        links = []
        for at, to, a, b in unlike(table, threshold):
            _, label = np.unique(component[at:to], return_inverse=True)
            a, b = a - at, b - at
            tries = 1
            while len(a):
                # Some pairs of each two components, then more of those that did not become one.
                both = np.minimum(label[a], label[b]) * (to - at) + np.maximum(label[a], label[b])
                order = np.argsort(both, kind="stable")
                turn = np.arange(len(a)) - np.repeat(*(lambda c: (c[:-1], np.diff(c)))(groups.group_bounds(both[order])))
                chosen = order[turn < tries]
                x, y = at + a[chosen], at + b[chosen]
                shared = groups.overlaps(sets, x, y)
                ok = shared * (1 + threshold) >= threshold * (n[x] + n[y]) - 1e-9
                links += zip(component[x[ok]].tolist(), component[y[ok]].tolist(), strict=True)
                label = groups.local_roots(label.max() + 1, label[x[ok] - at], label[y[ok] - at])[label]
                rest = np.ones(len(a), bool)
                rest[chosen] = False
                rest &= label[a] != label[b]
                a, b, tries = a[rest], b[rest], 4 * tries
        return pa.RecordBatch.from_arrays([pa.array([x[i] for x in links], pa.int64()) for i in (0, 1)], ["a", "b"]) if links else None

    return lambda: step


def components(docs: DataFrame, n_words: int = WORDS, threshold: float = THRESHOLD) -> DataFrame:
    """
    One row for each document: doc_id, n_shingles (distinct shingles of ``n_words`` words, A-Z lower-cased), component_id
    (smallest doc_id that links connect it with, its own included) and kept (doc_id is component_id).

    Two documents are linked if the Jaccard similarity of their whole sets of shingles is at least ``threshold``.

    1. Rows with equal sets become one node, whatever their number. Each node has a fast similarity sketch of 128 entries
       in 32 bands of 4. Sets of which no other can be near enough (fewer than 4 shingles at 0.8) need none.
    2. Nodes that share a band meet in a bucket. In a first step the members of a bucket meet its smallest node only: those
       whose sketches allow it are compared exactly, and the links found give a first set of components. A group of near
       copies costs one comparison for each member, not one for each pair, and its equal buckets cost one.
    3. In buckets that still hold more than one component, members outside the largest one meet that one and each other, in
       blocks of bounded size, each pair of blocks apart. Only pairs of different components count, in the first band they
       share, and they are tried until their components are one. No pair that could join two components is left out.
    4. Sets travel only for nodes with a possible partner, made again from the texts, and as hashes. Pairs become rows only
       for a member and its bucket's smallest node.

    Shingles are compared by 64-bit hashes. A pair at the threshold is missed with a chance of about 5e-8 (bands) and 1e-7
    (sketches). A text of one to three words has one shingle of all of them. Null, empty and blank texts have none, and are
    linked with nothing, not with each other. Null doc_ids come first; repeated rows are copies of each other. An empty table
    gives no rows. Other columns are ignored.
    """
    spark = common.ready(docs.sparkSession)
    docs = common.need(docs, doc_id="bigint", text="string")
    rows = common.written(document_rows(docs, n_words, threshold), "near-rows")

    # Of a set's rows only the first of each task carries the sketch.
    own = rows.filter("n > 0").groupBy("d1", "d2").agg(
        F.min(F.struct("doc_id")).alias("first"), F.first("n").alias("n"), F.min(F.when(F.col("sketch").isNotNull(), F.struct("r1", "r2"))).alias("text_of"),
        F.first("sketch", ignorenulls=True).alias("sketch"), F.max(F.when(F.col("sketch").isNotNull(), F.col("bands"))).alias("bands"),
    )
    nodes = common.written(own.select(F.monotonically_increasing_id().alias("node"), "d1", "d2", "first", "n", "text_of", "sketch", "bands"), "near-nodes")
    banded = nodes.filter("sketch IS NOT NULL").select("node", F.explode("bands").alias("key"))
    buckets = banded.groupBy("key").agg(F.count("*").alias("m"), F.min("node").alias("head")).filter("m > 1").select("key", "head")
    met = common.written(banded.join(buckets, "key").select("key", "head", "node"), "near-met")

    payload = nodes.select("node", "n", "sketch")
    pairs = met.filter("node <> head").select("head", "node").distinct()
    likely = common.written(stars(pairs, payload, like_heads(threshold), "head bigint, node bigint", None), "near-likely")

    def sets_of(wanted: DataFrame) -> DataFrame:
        """node and elements of the wanted nodes, each from the one row that stands for it."""
        wanted = common.written(wanted.distinct().join(nodes, "node").select("node", "n", "text_of.r1", "text_of.r2"), "near-wanted")
        sent = spark.sparkContext.broadcast(common.bloom(wanted, "r1"))

        def fetch(batches):
            field, seen = common.bloom_field(sent.value), set()
            for batch in batches:
                r1 = batch.column("r1").to_numpy()
                chosen = [i for i in np.flatnonzero(common.in_bloom(field, r1)).tolist() if (r1[i], batch.column("r2")[i].as_py()) not in seen]
                chosen = [i for i in chosen if not seen.add((r1[i], batch.column("r2")[i].as_py()))]
                if not chosen:
                    continue
                part = batch.take(pa.array(chosen))
                data, bounds = common.text_buffer(part.column("text"))
                for a, b in common.slices(bounds, words.SLICE):
                    sets = shingle_sets(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], n_words)
                    columns = [part.column(c).slice(a, b - a) for c in ("r1", "r2")]
                    yield pa.RecordBatch.from_arrays([*columns, pa.array([s.tobytes() for s in sets], pa.binary())], ["r1", "r2", "elements"])

        made = keyed(docs).select("text", "r1", "r2").mapInArrow(fetch, "r1 bigint, r2 bigint, elements binary")
        return made.join(wanted, ["r1", "r2"]).groupBy("node").agg(F.first("n").alias("n"), F.first("elements").alias("elements"))

    # Counted from the rows of a star; a node is fetched once, however many stars it is in.
    fetched = common.written(sets_of(likely.select("node").unionByName(likely.select(F.col("head").alias("node")))), "near-sets")
    links = common.written(stars(likely, fetched, linked_heads(threshold), "a bigint, b bigint", BLOCK_SHINGLES), "near-links")
    common.discard(likely, fetched)
    first = groups.connected(links, "near").withColumnRenamed("root", "component")
    labelled = common.written(met.select("key", "node").join(first, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component")), "near-labelled")
    common.discard(met)

    # Buckets of several components. The members of a bucket's largest one need not meet each other: only the rest meets
    # them, and itself, both dealt out in blocks.
    shown = nodes.select("node", "n", "sketch", "bands")
    parts = labelled.join(nodes.select("node", "n"), "node").groupBy("key", "component").agg(F.count("*").alias("m"), F.sum("n").alias("total"))
    open_ = parts.groupBy("key").agg(F.max(F.struct("m", "component", "total")).alias("main"), F.sum("m").alias("m"), F.sum("total").alias("total")).filter("main.m < m")

    def blocks(m, total):
        return F.greatest(F.ceil(m / BLOCK_ROWS), F.ceil(total / BLOCK_SHINGLES)).cast("int")

    open_ = open_.select("key", F.col("main.component").alias("main"), blocks(F.col("main.m"), F.col("main.total")).alias("wide"), blocks(F.col("m") - F.col("main.m"), F.col("total") - F.col("main.total")).alias("deep"))
    open_ = labelled.join(open_, "key").withColumn("own", F.pmod(F.xxhash64("node"), F.when(F.col("component") == F.col("main"), F.col("wide")).otherwise(F.col("deep"))).cast("int"))
    open_ = common.written(open_, "near-open")
    rest, zero, one = open_.filter("component <> main"), F.lit(0), F.lit(1)

    def dealt(members, count, side, low, high, kind, x, y):
        out = members.withColumn("other", F.explode(F.sequence(F.lit(0), F.col(count) - 1)))
        return out.select("key", "node", "component", side.alias("side"), low.alias("low"), high.alias("high"), F.xxhash64("key", F.lit(kind), x, y).alias("g"))

    own, other = F.col("own"), F.col("other")
    low, high = F.least("own", "other"), F.greatest("own", "other")
    sided = dealt(open_.filter("component = main"), "deep", zero, zero, one, 0, own, other)
    sided = sided.unionByName(dealt(rest, "wide", one, zero, one, 0, other, own)).unionByName(dealt(rest, "deep", own, low, high, 1, low, high))
    place = "g bigint, node bigint, component bigint, key bigint, side int, low int, high int"
    some = common.written(groups.in_groups(sided.join(shown, "node"), "g", with_partners(threshold), place), "near-partners")
    sets = sets_of(some.select("node")).select("node", "elements")
    joins = common.written(groups.in_groups(some.join(shown, "node").join(sets, "node"), "g", joined_components(threshold), "a bigint, b bigint", 1024), "near-joins")
    second = groups.connected(joins, "near-second").select(F.col("node").alias("component"), "root")

    rooted = nodes.select("node", "d1", "d2", "first").join(first, "node", "left").withColumn("component", F.coalesce("component", "node"))
    rooted = common.written(rooted.join(second, "component", "left").select("d1", "d2", "first", F.coalesce("root", "component").alias("root")), "near-rooted")
    smallest = rooted.groupBy("root").agg(F.min("first").alias("smallest"))
    named = rooted.join(smallest, "root").select("d1", "d2", F.col("smallest.doc_id").alias("component_id"))
    known = rows.filter("n > 0").select("doc_id", "n", "d1", "d2").join(named, ["d1", "d2"]).select("doc_id", F.col("n").alias("n_shingles"), "component_id")
    none = rows.filter("n = 0").select("doc_id", F.col("n").alias("n_shingles"), F.col("doc_id").alias("component_id"))
    return known.unionByName(none).select("*", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))
