"""Token ids in binary files: fixed-width bit packing in blocks with an index of block offsets."""

from __future__ import annotations

import struct

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm import common, encode

# A file is a row of records, each followed by one line feed (the writer adds it); numbers are little-endian.
# Block: "TIDB", u32 width in bits, u32 ids, u32 documents, then for each document i64 doc_id, u8 flags (1: it has a
#   doc_id, 2: it begins here) and u32 ids in this block, as three arrays, then the packed ids, padded by 8 bytes.
# Index, the last record: "TIDX", u64 offset of each block, u64 ids before each block, u64 blocks, u64 ids, u64 offset of the index.
BLOCK_IDS = 1 << 16
BEGINS = 2
HEAD = struct.Struct("<4sIII")
TAIL = struct.Struct("<QQQ")


def id_bits(vocabulary: int) -> int:
    """The fewest bits that hold every id below ``vocabulary``."""
    return max(1, (vocabulary - 1).bit_length())


def pack_bits(ids: np.ndarray, width: int) -> bytes:
    if width in (8, 16, 32):
        return ids.astype(f"<u{width // 8}").tobytes()
    bits = np.unpackbits(ids.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")[:, :width]
    return np.packbits(bits.ravel(), bitorder="little").tobytes()


def unpack_bits(packed, width: int, start: int, n: int) -> np.ndarray:
    """Ids start to start + n of a packed block, without touching the others; ``packed`` has 8 bytes of padding."""
    at = np.arange(start, start + n, dtype=np.int64) * width
    words = np.ndarray((max(0, len(packed) - 7),), "<u8", packed, strides=(1,))
    return ((words[at >> 3] >> (at & 7).astype(np.uint64)) & np.uint64((1 << width) - 1)).astype(np.uint32)


def block(doc_ids: list[int | None], begins: np.ndarray, counts: np.ndarray, ids: np.ndarray, width: int) -> bytes:
    flags = np.array([d is not None for d in doc_ids], np.uint8) | (begins.astype(np.uint8) * BEGINS)
    numbers = np.array([d or 0 for d in doc_ids], "<i8")
    return HEAD.pack(b"TIDB", width, len(ids), len(doc_ids)) + numbers.tobytes() + flags.tobytes() + counts.astype("<u4").tobytes() + pack_bits(ids, width) + bytes(8)


def index(offsets: list[int], before: list[int], total: int, size: int) -> bytes:
    return b"TIDX" + np.array(offsets, "<u8").tobytes() + np.array(before, "<u8").tobytes() + TAIL.pack(len(offsets), total, size)


class TokenFile:
    """Reader of one file's bytes, which may be a memory map."""

    def __init__(self, content):
        self.content = memoryview(content)
        blocks, self.n_ids, at = TAIL.unpack_from(self.content, len(self.content) - TAIL.size - 1)
        self.offsets = np.frombuffer(self.content, "<u8", blocks, at + 4).astype(np.int64)
        self.before = np.frombuffer(self.content, "<u8", blocks, at + 4 + 8 * blocks).astype(np.int64)

    def _head(self, k: int) -> tuple[int, int, int, int]:
        magic, width, n_ids, n_docs = HEAD.unpack_from(self.content, self.offsets[k])
        if magic != b"TIDB":
            raise ValueError("not a block of token ids")
        return width, n_ids, n_docs, int(self.offsets[k]) + HEAD.size

    def _block_ids(self, k: int, start: int, n: int) -> np.ndarray:
        width, n_ids, n_docs, at = self._head(k)
        at += 13 * n_docs
        return unpack_bits(self.content[at : at + (n_ids * width + 7) // 8 + 8], width, start, n)

    def ids(self, start: int, n: int) -> np.ndarray:
        """Ids start to start + n of the file."""
        out, k = [np.zeros(0, np.uint32)], max(0, int(np.searchsorted(self.before, start, "right")) - 1)
        while n > 0 and k < len(self.offsets):
            own = start - int(self.before[k])
            take = min(n, self._head(k)[1] - own)
            out.append(self._block_ids(k, own, take))
            start, n, k = start + take, n - take, k + 1
        return np.concatenate(out)

    def documents(self) -> tuple[list[int | None], np.ndarray]:
        """doc_ids and token counts of the file's documents, in order."""
        numbers, flags, counts = [], [], []
        for k in range(len(self.offsets)):
            _, _, n_docs, at = self._head(k)
            numbers.append(np.frombuffer(self.content, "<i8", n_docs, at))
            flags.append(np.frombuffer(self.content, np.uint8, n_docs, at + 8 * n_docs))
            counts.append(np.frombuffer(self.content, "<u4", n_docs, at + 9 * n_docs))
        numbers, flags, counts = (np.concatenate(x) for x in (numbers, flags, counts))
        first = np.flatnonzero(flags & BEGINS)
        return [int(n) if f & 1 else None for n, f in zip(numbers[first], flags[first], strict=True)], np.add.reduceat(counts.astype(np.int64), first) if len(first) else np.zeros(0, np.int64)


def write_token_files(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> None:
    """
    Encode every text, append ``end_id`` and write the ids to files below ``path`` in ascending order of doc_id: file by
    file, and inside each file. Spark's own writer commits the files, so a lost executor or a repeated task leaves no
    half-written file, and any storage that Spark writes to will do.

    The texts are dealt by ranges of (doc_id, hash of the text), so neither a repeated doc_id nor a hot source fills a
    task. Null text is empty (only the end id); a null doc_id comes first and is kept as such; rows with equal doc_id are
    documents of their own; an empty table gives a folder without ids. Other columns are ignored.
    """
    common.ready(docs.sparkSession)
    width = id_bits(max(encode.load(tokenizer).get_vocab_size(with_added_tokens=True), end_id + 1))

    def run(batches):
        encoder, offsets, before, size, total = encode.encoder(tokenizer), [], [], 0, 0
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            doc_ids, at = batch.column("doc_id").to_pylist(), 0
            for ids, rows in encoder.encode(data, bounds, end_id):
                records = []
                for a in range(0, len(ids), BLOCK_IDS):
                    b = min(len(ids), a + BLOCK_IDS)
                    first, last = int(np.searchsorted(rows, a, "right")) - 1, int(np.searchsorted(rows, b, "left"))
                    edges = np.clip(rows[first : last + 1], a, b)
                    records.append(block(doc_ids[at + first : at + last], rows[first:last] >= a, np.diff(edges), ids[a:b], width))
                    offsets.append(size)
                    before.append(total)
                    size += len(records[-1]) + 1
                    total += b - a
                at += len(rows) - 1
                yield pa.RecordBatch.from_arrays([pa.array(records, pa.binary())], ["record"])
        if offsets:
            yield pa.RecordBatch.from_arrays([pa.array([index(offsets, before, total, size)], pa.binary())], ["record"])

    order = [F.col("doc_id"), F.xxhash64("text")]
    ranged = common.need(docs, doc_id="bigint", text="string").repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.mapInArrow(run, "record binary").select(F.col("record").cast("string")).write.text(path)


def read_token_files(spark: SparkSession, path: str) -> DataFrame:
    """
    Documents of the files below ``path``: doc_id, start (ids of all documents before it, over all files), n_tokens and
    ids (little-endian unsigned 32-bit). One task reads a file at a time; the files' totals, one row each, give the starts.
    """
    common.ready(spark)
    files = spark.read.format("binaryFile").option("pathGlobFilter", "part-*").load(path).filter("length > 0").select(F.element_at(F.split("path", "/"), -1).alias("file"), "content")

    def totals(batches):
        for batch in batches:
            n = [TokenFile(c.as_buffer()).n_ids for c in batch.column("content")]
            yield pa.RecordBatch.from_arrays([batch.column("file"), pa.array(n, pa.int64())], ["file", "n"])

    def documents(batches):
        for batch in batches:
            for name, content in zip(batch.column("file"), batch.column("content"), strict=True):
                file = TokenFile(content.as_buffer())
                doc_ids, counts = file.documents()
                edges = np.concatenate(([0], np.cumsum(counts)))
                for a, b in common.slices(edges, 1 << 20):
                    ids = file.ids(int(edges[a]), int(edges[b] - edges[a])).astype("<u4")
                    offsets = ((edges[a : b + 1] - edges[a]) * 4).astype(np.int32)
                    columns = [pa.array([name.as_py()] * (b - a)), pa.array(doc_ids[a:b], pa.int64()), pa.array(edges[a:b]), pa.array(counts[a:b]), pa.Array.from_buffers(pa.binary(), b - a, [None, pa.py_buffer(offsets), pa.py_buffer(ids)])]
                    yield pa.RecordBatch.from_arrays(columns, ["file", "doc_id", "own_start", "n_tokens", "ids"])

    # By number: from part-100000 on the names' own order is another one.
    number = F.regexp_extract("file", "part-([0-9]+)", 1).cast("bigint")
    earlier = Window.orderBy(number, "file").rowsBetween(Window.unboundedPreceding, -1)
    # The numbers of part files ascend with the ranges. One row a file: its size is bounded by the number of files.
    base = files.mapInArrow(totals, "file string, n bigint").select("file", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("base"))
    found = files.mapInArrow(documents, "file string, doc_id bigint, own_start bigint, n_tokens bigint, ids binary")
    return found.join(F.broadcast(base), "file").select("doc_id", (F.col("own_start") + F.col("base")).alias("start"), "n_tokens", "ids")
