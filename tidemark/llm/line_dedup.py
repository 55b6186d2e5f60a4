"""Removal of lines that are near copies of earlier lines: an exact set-similarity join with prefix, length and positional filters."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common, groups, words

THRESHOLD = 0.8
EVERY_LINE = 1  # a caller may set a higher floor: lines of fewer distinct words then stay
BUCKET_BITS, HASH_BITS, PIECE_BITS = 20, 42, 10
BLOCK = 2000  # members of a token's block
COARSE = 48  # tokens of a set for which a bitmap of 64 bits is enough


def buckets(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - BUCKET_BITS)).astype(np.int64)


def lines_of(data: np.ndarray, rows: np.ndarray, rarity: np.ndarray) -> tuple[np.ndarray, ...]:
    """
    Distinct tokens of each line that has words: tokens (rarest first), where each line's begin (one more at the end), the
    line's row and its number in the row (split at line feeds). A token is its rarity class and a 42-bit hash of the word.
    """
    feeds = np.flatnonzero(data == 10) + 1
    edges = np.unique(np.concatenate((rows[:-1][rows[:-1] < rows[1:]], feeds[feeds < len(data)])))
    hashes, starts, _ = words.words(data, rows)
    line = np.searchsorted(edges, starts, "right") - 1
    used, line = np.unique(line, return_inverse=True)
    tokens = (rarity[buckets(hashes)].astype(np.uint64) << np.uint64(HASH_BITS)) | (hashes & np.uint64((1 << HASH_BITS) - 1))
    if len(used) < 1 << 16:
        keys = words.distinct((line.astype(np.uint64) << np.uint64(48)) | tokens)
        line, tokens = (keys >> np.uint64(48)).astype(np.int64), keys & np.uint64((1 << 48) - 1)
    else:  # one very long text
        order = np.lexsort((tokens, line))
        line, tokens = line[order], tokens[order]
        new = np.concatenate(([True], (line[1:] != line[:-1]) | (tokens[1:] != tokens[:-1])))
        line, tokens = line[new], tokens[new]
    begins = np.searchsorted(line, np.arange(len(used) + 1))
    row = np.searchsorted(rows, edges[used], "right") - 1
    feeds_before = np.searchsorted(feeds, edges[used], "right")
    first = np.searchsorted(feeds, rows[row], "right")
    # A feed that ends the row before this one begins no line of this row.
    return tokens, begins, row, feeds_before - first


def digests(tokens: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """A 64-bit number that stands for each set of tokens."""
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words.mix(tokens + np.uint64(1)), dtype=np.uint64)))
    return words.mix(np.diff(sums[begins])).view(np.int64)


def bitmaps(tokens: np.ndarray, begins: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """
    Parities of the tokens that fall on each of 64 bits: two sets differ in at least as many tokens as their bitmaps differ
    in bits, and unlike bits that are only set, parities don't fill up. A set of more than ``COARSE`` tokens has 128 of them:
    the second value holds the upper 64, the first the upper and lower ones together; smaller sets have 0 there.
    """
    if len(begins) < 2:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64)
    mixed = words.mix(tokens)
    bits = np.left_shift(np.uint64(1), mixed >> np.uint64(58))
    upper = np.bitwise_xor.reduceat(np.where((mixed & np.uint64(1)).astype(bool), bits, np.uint64(0)), begins[:-1])
    return np.bitwise_xor.reduceat(bits, begins[:-1]), np.where(np.diff(begins) > COARSE, upper, np.uint64(0))


def differing(coarse: np.ndarray, fine: np.ndarray, n: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The bits in which the bitmaps of members a and b differ: of the 128 where both have them, else of the 64."""
    folded, upper = coarse[a] ^ coarse[b], fine[a] ^ fine[b]
    both = (n[a] > COARSE) & (n[b] > COARSE)
    return np.where(both, np.bitwise_count(folded ^ upper) + np.bitwise_count(upper), np.bitwise_count(folded)).astype(np.int64)


def may_differ(n: np.ndarray, threshold: float) -> np.ndarray:
    """Whether a set of n tokens can be similar to one that isn't equal to it: the nearest one has all its tokens and one more."""
    return n >= threshold * (n + 1) - 1e-9


def word_rarity(docs: DataFrame) -> np.ndarray:
    """Class (0: rarest) of each of 2^20 buckets of words, from the counts over all texts. The table's size is fixed."""

    def count(batches):
        counts = np.zeros(1 << BUCKET_BITS, np.int64)  # of the whole task
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            for a, b in common.slices(bounds, words.SLICE):
                hashes, _, _ = words.words(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a])
                counts += np.bincount(buckets(hashes), minlength=len(counts))
        pieces = counts.astype(np.uint32).reshape(-1, 1 << PIECE_BITS)
        some = np.flatnonzero(pieces.any(1))
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array([pieces[g].tobytes() for g in some], pa.binary())], ["g", "counts"])

    def classes(table):
        g = table.column("g").to_numpy()
        bounds, out = groups.group_bounds(g), []
        for at, to in zip(bounds[:-1], bounds[1:], strict=True):
            n = np.zeros(1 << PIECE_BITS, np.int64)
            for own in table.column("counts").slice(at, to - at).to_pylist():
                n += np.frombuffer(own, np.uint32)
            out.append(np.minimum(63, np.floor(2 * np.log2(np.maximum(n, 1)))).astype(np.uint8).tobytes())
        return pa.RecordBatch.from_arrays([pa.array(g[bounds[:-1]]), pa.array(out, pa.binary())], ["g", "classes"])

    counted = docs.select("text").mapInArrow(count, "g bigint, counts binary")
    rarity = np.zeros((1 << (BUCKET_BITS - PIECE_BITS), 1 << PIECE_BITS), np.uint8)
    for row in groups.in_groups(counted, "g", lambda: classes, "g bigint, classes binary").collect():  # 1,024 rows of 1 KB
        rarity[row["g"]] = np.frombuffer(row["classes"], np.uint8)
    return rarity.ravel()


def line_table(docs: DataFrame, rarity, threshold: float, min_words: int) -> DataFrame:
    """
    A row for each line of at least ``min_words`` distinct words (line: its number) and one for each document (line -1,
    n: its lines with words, n_long: those of at least ``min_words``). ``prefix`` holds the rarest tokens, of which a similar line shares at least one; it is
    empty where the task has met the same set of tokens before, and for sets so small that only equal ones are similar.
    """

    def run(batches):
        seen: set[int] = set()
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            for a, b in common.slices(bounds, words.SLICE):
                tokens, begins, row, number = lines_of(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], rarity.value)
                n = np.diff(begins)
                d1 = digests(tokens, begins)
                bitmap, fine = (x.view(np.int64) for x in bitmaps(tokens, begins))
                chosen = np.flatnonzero(n >= min_words)
                new = np.array([d not in seen and not seen.add(d) for d in d1[chosen].tolist()], bool) if len(chosen) else np.zeros(0, bool)
                length = np.where(new & may_differ(n[chosen], threshold), n[chosen] - np.ceil(threshold * n[chosen] - 1e-9).astype(np.int64) + 1, 0)
                ends = np.cumsum(length)
                at = np.repeat(begins[:-1][chosen] - (ends - length), length) + np.arange(ends[-1] if len(ends) else 0)
                prefix = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(tokens[at].view(np.int64)))
                which = pa.array(row[chosen] + a)
                columns = [batch.column(c).take(which) for c in ("doc_id", "r1", "r2")]
                yield pa.RecordBatch.from_arrays([*columns, pa.array(number[chosen].astype(np.int32)), pa.array(n[chosen].astype(np.int32)), pa.array(d1[chosen]), pa.array(bitmap[chosen]), pa.array(fine[chosen]), prefix, pa.nulls(len(chosen), pa.int32())], names)
                per_doc, long = (np.bincount(r, minlength=b - a).astype(np.int32) for r in (row, row[chosen]))
                none = [pa.nulls(b - a, t) for t in (pa.int64(), pa.int64(), pa.int64(), prefix.type)]
                yield pa.RecordBatch.from_arrays([*[batch.column(c).slice(a, b - a) for c in ("doc_id", "r1", "r2")], pa.array(np.full(b - a, -1, np.int32)), pa.array(per_doc), *none, pa.array(long)], names)

    names = ["doc_id", "r1", "r2", "line", "n", "d1", "bitmap", "fine", "prefix", "n_long"]
    keyed = docs.select("doc_id", "text", F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("r2"))
    return keyed.mapInArrow(run, "doc_id bigint, r1 bigint, r2 bigint, line int, n int, d1 bigint, bitmap bigint, fine bigint, prefix array<bigint>, n_long int")


def unpacked(block: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """A member's own block and the two blocks that meet."""
    return block >> 42, (block >> 21) & 0x1FFFFF, block & 0x1FFFFF


def filtered(g, n, position, bitmap, side, apart, threshold, fine=None) -> tuple[np.ndarray, np.ndarray]:
    """
    Members that may be similar, as pairs, of all groups at once (rows sorted by group and size): near in size, with enough
    tokens left after the common one (if it is the first they share, these hold all others), and with bitmaps that differ
    in few enough bits. ``apart``: the group is two blocks, and only pairs across them are its own. Without ``fine`` the
    bitmaps have 64 bits.
    """
    fine = np.zeros(len(g), np.uint64) if fine is None else fine
    base = (np.cumsum(np.concatenate(([0], g[1:] != g[:-1]))) if len(g) else g) << 32
    times = np.searchsorted(base + n, base + np.floor(n / threshold + 1e-9).astype(np.int64), "right") - np.arange(len(n)) - 1
    done, out_a, out_b = np.cumsum(times), [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    cuts = np.unique(np.searchsorted(done, np.arange(0, done[-1] if len(done) else 0, 1 << 19), "left"))
    for at, to in zip(cuts, [*cuts[1:], len(n)] if len(cuts) else [], strict=True):
        t = times[at:to]
        a = np.repeat(np.arange(at, to), t)
        b = a + 1 + np.arange(len(a)) - np.repeat(np.cumsum(t) - t, t)
        need = np.ceil(threshold / (1 + threshold) * (n[a] + n[b]) - 1e-9)
        ok = (np.minimum(n[a] - position[a], n[b] - position[b]) >= need) & (~apart[a] | (side[a] != side[b]))
        a, b, need = a[ok], b[ok], need[ok]
        ok = differing(bitmap, fine, n, a, b) <= n[a] + n[b] - 2 * need
        out_a.append(a[ok])
        out_b.append(b[ok])
    return np.concatenate(out_a), np.concatenate(out_b)


def members_with_partners(rows: DataFrame, threshold: float) -> DataFrame:
    """Of each token's (block's) members those that have a possible partner there; s: number that stands for them all and their sides."""

    def make():
        def step(table):
            g = table.column("g").to_numpy()
            if not (g[1:] == g[:-1]).any():
                return None
            d1, shape, block = (table.column(c).to_numpy() for c in ("d1", "shape", "block"))
            n, position, (side, low, high) = shape >> 32, shape & 0xFFFFFFFF, unpacked(block)
            bitmap = table.column("bitmap").to_numpy().view(np.uint64)
            fine = table.column("fine").to_numpy().view(np.uint64) if "fine" in table.column_names else np.zeros(len(g), np.uint64)
            order = np.lexsort((d1, n, g))
            order = order[np.concatenate(([True], (g[order][1:] != g[order][:-1]) | (d1[order][1:] != d1[order][:-1])))]
            same = g[order][1:] == g[order][:-1]
            order = order[np.concatenate(([False], same)) | np.concatenate((same, [False]))]  # groups of one go
            a, b = filtered(g[order], n[order], position[order], bitmap[order], side[order], low[order] != high[order], threshold, fine[order])
            keep = np.zeros(len(order), bool)
            keep[a] = keep[b] = True
            chosen = order[keep]
            if not len(chosen):
                return None
            bounds = groups.group_bounds(g[chosen])
            # A member counts with its side: equal members on other sides meet other partners.
            placed = words.mix(words.mix(d1[chosen].view(np.uint64)) + side[chosen].astype(np.uint64))
            sums = np.repeat(np.add.reduceat(placed, bounds[:-1]), np.diff(bounds))
            columns = [g[chosen], d1[chosen], block[chosen], sums.view(np.int64)]
            return pa.RecordBatch.from_arrays([pa.array(c) for c in columns], ["g", "d1", "block", "s"])

        return step

    return groups.in_groups(rows, "g", make, "g bigint, d1 bigint, block bigint, s bigint", 1 << 16)


def matched_sets(rows: DataFrame, threshold: float) -> DataFrame:
    """The d1 of sets that are similar to one of their group whose first line comes earlier."""

    def make():
        def step(table):
            g, d1, line, r1, r2, block = (table.column(c).to_numpy() for c in ("g", "d1", "line", "r1", "r2", "block"))
            side, low, high = unpacked(block)
            doc_id = table.column("doc_id").fill_null(-(1 << 63)).to_numpy()
            tokens = table.column("tokens").combine_chunks() if isinstance(table.column("tokens"), pa.ChunkedArray) else table.column("tokens")
            flat, offsets = tokens.flatten().to_numpy().view(np.uint64), tokens.offsets.to_numpy() - tokens.offsets[0].as_py()
            order = np.lexsort((line, r2, r1, doc_id, g))
            sets = [flat[offsets[i] : offsets[i + 1]] for i in order]
            n = np.diff(offsets)[order]
            g, d1, side, low, high = g[order], d1[order], side[order], low[order], high[order]
            bounds = groups.group_bounds(g)
            done = np.zeros(len(g), bool)
            start = np.repeat(bounds[:-1], np.diff(bounds))
            # Every line against the earliest ones of its group first: in a group of near copies that settles most.
            for first, last in ((0, 4), (4, 36), (36, 1 << 62)):
                index = np.arange(len(g)) - start
                waiting = np.flatnonzero(~done & (index > first))
                times = np.minimum(index[waiting], last) - first
                for at in range(0, len(waiting), 2048):
                    y = np.repeat(waiting[at : at + 2048], times[at : at + 2048])
                    t = times[at : at + 2048]
                    x = start[y] + first + np.arange(len(y)) - np.repeat(np.cumsum(t) - t, t)
                    ok = (np.minimum(n[x], n[y]) >= threshold * np.maximum(n[x], n[y]) - 1e-9) & ((low[y] == high[y]) | (side[x] != side[y]))
                    x, y = x[ok], y[ok]
                    for low_ in range(0, len(x), 1 << 16):
                        a, b = x[low_ : low_ + (1 << 16)], y[low_ : low_ + (1 << 16)]
                        both = groups.overlaps(sets, a, b)
                        done[b[both * (1 + threshold) >= threshold * (n[a] + n[b]) - 1e-9]] = True
            return pa.RecordBatch.from_arrays([pa.array(d1[done])], ["d1"])

        return step

    return groups.in_groups(rows, "g", make, "d1 bigint")


def removed_lines(docs: DataFrame, threshold: float = THRESHOLD, min_words: int = EVERY_LINE) -> DataFrame:
    """
    One row for each document: doc_id, r1, r2 (hashes of the row), n_lines (lines with words), n_long (those of at least
    ``min_words`` distinct words), n_removed and removed (their numbers from 0, ascending).

    A line is removed if an earlier line, by (doc_id, row hash, line number) over all documents, has a set of words whose
    Jaccard similarity with its own is at least ``threshold``, whether or not that line is removed itself. Lines of fewer
    than ``min_words`` distinct words stay.

    1. Word counts over all texts give rarity classes of a fixed number of word buckets; tokens of a line are ordered by
       them. Any fixed order makes the join exact; rarity makes it cheap.
    2. Lines with equal sets are one set from here on, and later ones go whatever their length. Sets of 1 to 3 words are
       similar to equal ones only (at 0.8), so that is all for them. Each larger set sends its prefix, the tokens of which
       a similar set shares at least one, with its size, the token's place and a bitmap of 64 or 128 parities.
    3. In a token's group length, positional and bitmap filters leave the sets that may have a partner. Pairs never become
       rows. A token with many sets is dealt out in blocks of bounded size, each pair of blocks apart.
    4. Groups with the same members, on the same sides of a pair of blocks, count once. The sets are fetched and written
       once, in a pass over the texts that hold their first lines (through Bloom filters of fixed size and a join), and
       similarity is computed exactly, in order, until an earlier match is found: in one group of each set, then, for sets
       still without a match, in all their others.

    Null or empty text: no lines. Rows equal in doc_id and text are one document and get the same result. Null doc_ids
    come first. An empty table gives no rows. Other columns are ignored.
    """
    spark = common.ready(docs.sparkSession)
    docs = common.need(docs, doc_id="bigint", text="string")
    rarity = spark.sparkContext.broadcast(word_rarity(docs))
    lines = common.written(line_table(docs, rarity, threshold, min_words), "dedup-lines")

    shape = F.shiftleft(F.col("n").cast("bigint"), 32).bitwiseOR(F.col("position").cast("bigint")).alias("shape")

    def tokens_of(chosen):
        return chosen.select("d1", "n", "bitmap", "fine", F.posexplode("prefix").alias("position", "token")).select("d1", shape, "bitmap", "fine", "token")

    def is_upper(token):
        return F.shiftright(token, HASH_BITS) >= int(np.floor(2 * np.log2(BLOCK + 1)))

    # A token's group is no larger than the count of its bucket, so only tokens of the upper classes can need blocks. They
    # stand at the end of a prefix.
    prefixes = lines.filter("size(prefix) > 0")
    lower = tokens_of(prefixes).filter(~is_upper("token"))
    tokens = tokens_of(prefixes.filter(is_upper(F.element_at("prefix", -1)))).filter(is_upper("token"))
    large = tokens.groupBy("token").agg(F.count("*").alias("m")).filter(F.col("m") > BLOCK)
    large = common.written(large.select("token", F.ceil(F.col("m") / BLOCK).cast("int").alias("blocks")), "dedup-large")
    dealt = tokens.join(large, "token", "left").withColumn("side", F.coalesce(F.pmod("d1", "blocks"), F.lit(0)))
    dealt = dealt.withColumn("other", F.explode(F.sequence(F.lit(0).cast("bigint"), F.coalesce("blocks", F.lit(1)).cast("bigint") - 1)))
    low, high = F.least("side", "other"), F.greatest("side", "other")
    block = F.shiftleft("side", 42).bitwiseOR(F.shiftleft(low, 21)).bitwiseOR(high)
    whole = F.lit(0).cast("bigint")
    dealt = dealt.select(F.xxhash64("token", low, high).alias("g"), "d1", "shape", "bitmap", "fine", block.alias("block")).unionByName(
        lower.select(F.xxhash64("token", whole, whole).alias("g"), "d1", "shape", "bitmap", "fine", whole.alias("block"))
    )
    met = common.written(members_with_partners(dealt, threshold), "dedup-candidates")
    common.release(spark)

    firsts = lines.filter("line >= 0").groupBy("d1").agg(F.min(F.struct("doc_id", "r1", "r2", "line")).alias("first"), F.count("*").alias("times"))
    firsts = common.written(firsts.select("d1", "first.*", "times"), "dedup-firsts")
    # A set needs one earlier match, and a similar pair meets in most of its groups. So each set is first tried in the
    # largest of the groups in which it isn't the earliest, and only those without a match in the others.
    blocks = F.col("block").bitwiseAND((1 << 42) - 1)
    once = met.groupBy("s", blocks.alias("blocks")).agg(F.min("g").alias("g")).select("g")
    placed = met.join(once, "g").join(firsts.drop("times"), "d1").select("g", "d1", "block", "doc_id", "r1", "r2", "line")
    placed = common.written(placed, "dedup-placed")
    common.discard(met, large)
    at = F.struct("doc_id", "r1", "r2", "line")
    heads = placed.groupBy("g").agg(F.min(at).alias("head"), F.count("*").alias("m"))
    probes = common.written(placed.join(heads, "g").filter(at > F.col("head")).select("d1", "g", "m"), "dedup-probes")
    tried = common.written(probes.groupBy("d1").agg(F.max(F.struct("m", "g")).alias("best")).select(F.col("best.g").alias("g")).distinct(), "dedup-tried")
    common.release(spark)

    def fetch(batches, sent):
        sets_field, rows_field = (common.bloom_field(x) for x in sent.value)
        for batch in batches:
            held = common.in_bloom(rows_field, batch.column("r1").to_numpy())
            if not held.any():
                continue
            batch = batch.filter(pa.array(held))
            data, bounds = common.text_buffer(batch.column("text"))
            for a, b in common.slices(bounds, words.SLICE):
                tokens, begins, _, _ = lines_of(data[bounds[a] : bounds[b]], bounds[a : b + 1] - bounds[a], rarity.value)
                n = np.diff(begins)
                d1 = digests(tokens, begins)
                chosen = np.flatnonzero((n >= min_words) & may_differ(n, threshold) & common.in_bloom(sets_field, d1))
                _, first = np.unique(d1[chosen], return_index=True)
                chosen = chosen[first]
                ends = np.cumsum(n[chosen])
                at = np.repeat(begins[:-1][chosen] - (ends - n[chosen]), n[chosen]) + np.arange(ends[-1] if len(ends) else 0)
                lists = pa.ListArray.from_arrays(pa.array(np.append(0, ends).astype(np.int32)), pa.array(tokens[at].view(np.int64)))
                yield pa.RecordBatch.from_arrays([pa.array(d1[chosen]), lists], ["d1", "tokens"])

    # The sets are read where their first lines stand; other rows need no second look.
    wanted = placed.select("d1", "r1").distinct()
    sent = spark.sparkContext.broadcast((common.bloom(wanted, "d1"), common.bloom(wanted, "r1")))
    found = docs.select("text", F.xxhash64("doc_id", "text").alias("r1")).mapInArrow(lambda batches: fetch(batches, sent), "d1 bigint, tokens array<bigint>")
    sets = common.written(found.join(wanted.select("d1"), "d1", "left_semi").dropDuplicates(["d1"]), "dedup-sets")
    common.release(spark)

    def tested(groups_, label):
        members = placed.join(groups_, "g", "left_semi")
        out = common.written(matched_sets(members.join(sets, "d1"), threshold).distinct(), f"dedup-{label}")
        common.release(spark)
        return out

    matched = tested(tried, "matched")
    others = probes.join(matched, "d1", "left_anti").join(tried, "g", "left_anti").select("g").distinct()
    rest = tested(others, "rest")
    common.discard(placed, probes, tried, sets)
    matched = matched.unionByName(rest).distinct()

    # Most sets are those of one line and have no match; they need no look at their lines.
    some = firsts.join(matched.withColumn("matched", F.lit(True)), "d1", "left").filter("matched or times > 1").select("d1", at.alias("first"), "matched")
    judged = lines.filter("line >= 0").select("doc_id", "r1", "r2", "line", "d1").join(some, "d1")
    copied = judged.filter(F.col("matched").isNotNull() | ~at.eqNullSafe(F.col("first")))
    # Repeated rows repeat their lines; a set of line numbers holds each once.
    gone = copied.groupBy("r1", "r2").agg(F.array_sort(F.collect_set("line")).alias("removed"))
    empty = F.array().cast("array<int>")
    return lines.filter("line = -1").select("doc_id", "r1", "r2", F.col("n").cast("bigint").alias("n_lines"), F.col("n_long").cast("bigint").alias("n_long")).join(gone, ["r1", "r2"], "left").select(
        "doc_id", "r1", "r2", "n_lines", "n_long", F.coalesce(F.size("removed"), F.lit(0)).cast("bigint").alias("n_removed"), F.coalesce("removed", empty).alias("removed"),
    )


def without_copied_lines(docs: DataFrame, min_words: int = EVERY_LINE) -> DataFrame:
    """
    The columns of ``documents`` with the texts less their removed lines. A document of which no line with words is left
    goes; every other keeps the rest of its text. Documents that have no words stay as they are.
    """
    own = common.need(docs, doc_id="bigint", text="string", lang="string", source="string", n_chars="bigint")
    keyed = own.select("*", F.xxhash64("doc_id", "text").alias("r1"), F.xxhash64(F.lit(1), "text", "doc_id").alias("r2"))
    gone = removed_lines(docs, min_words=min_words).filter("n_removed > 0").select("r1", "r2", "removed", (F.col("n_removed") == F.col("n_lines")).alias("whole")).dropDuplicates(["r1", "r2"])
    rest = F.array_join(F.filter(F.split("text", "\n"), lambda _, i: ~F.array_contains("removed", i)), "\n")
    left = keyed.join(gone, ["r1", "r2"], "left").filter(~F.coalesce("whole", F.lit(False)))
    left = left.select("doc_id", F.when(F.col("removed").isNull(), F.col("text")).otherwise(rest).alias("text"), "lang", "source", F.col("removed").isNotNull().alias("cut"), "n_chars")
    return left.select("doc_id", "text", "lang", "source", F.when(F.col("cut"), F.char_length("text")).otherwise(F.col("n_chars")).cast("bigint").alias("n_chars"))
