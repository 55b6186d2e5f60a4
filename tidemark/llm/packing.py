"""Packing by power-of-two decomposition: no padding, and no sequence holds tokens of two documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, encode

SCHEMA = "doc_id bigint, start bigint, length bigint, ids binary, doc_tokens bigint, sequence_id bigint, offset bigint"


def binary_pieces(tokens: np.ndarray, limit: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and length of the pieces of documents with so many tokens: whole limits first, then falling powers of two."""
    sizes = [limit] + [1 << k for k in range(limit.bit_length() - 2, -1, -1)]
    times = np.stack([tokens // limit] + [(tokens % limit) // s % 2 for s in sizes[1:]], axis=1)
    rows = np.repeat(np.arange(len(tokens)), times.sum(axis=1))
    lengths = np.repeat(np.tile(sizes, len(tokens)), times.ravel())
    ends = np.cumsum(lengths)
    firsts = np.concatenate(([0], np.cumsum(tokens)))[:-1]
    return rows, ends - lengths - firsts[rows], lengths


def pack(docs: DataFrame, tokenizer: str, end_id: int, limit: int = 4096) -> DataFrame:
    """
    One row for each piece of each document: doc_id, start (ids of the document before it), length (a power of two, at
    most ``limit``, itself a power of two), ids (little-endian unsigned 32-bit), doc_tokens (with the end id),
    sequence_id and offset. A document's tokens are cut into pieces of ``limit`` and then into the powers of two of the
    rest, so a piece fills a sequence of its own length exactly: there is no padding and the offset is always 0. ``write_buckets`` puts each length in a bucket of its own.

    It is one narrow pass: no shuffle, whatever the size, and no document or source can make a task uneven beyond its own
    text. Sequence ids hold the task's number and a running number; they are unique, not dense.

    Null or empty text: one piece with the end id. Null or repeated doc_id: each row is a document. Empty table: no rows.
    Other columns of ``docs`` are ignored.
    """
    if limit & (limit - 1):
        raise ValueError("limit must be a power of two")

    def make():
        encoder, state = encode.encoder(tokenizer), {"next": TaskContext.get().partitionId() << 40}

        def step(batch):
            data, bounds = common.text_buffer(batch.column("text"))
            doc_ids, out, at = batch.column("doc_id"), [], 0
            for ids, firsts in encoder.encode(data, bounds, end_id):
                tokens = np.diff(firsts)
                rows, starts, lengths = binary_pieces(tokens, limit)
                offsets = np.concatenate(([0], np.cumsum(lengths * 4))).astype(np.int32)
                payload = pa.Array.from_buffers(pa.binary(), len(rows), [None, pa.py_buffer(offsets), pa.py_buffer(ids.astype("<u4"))])
                numbers = state["next"] + np.arange(len(rows))
                state["next"] += len(rows)
                columns = [doc_ids.slice(at, len(tokens)).take(pa.array(rows)), pa.array(starts), pa.array(lengths), payload, pa.array(tokens[rows]), pa.array(numbers), pa.array(np.zeros(len(rows), np.int64))]
                out.append(pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"]))
                at += len(tokens)
            return out

        return step

    def run(batches):
        step = make()
        for batch in batches:
            if batch.num_rows:
                yield from step(batch)

    common.ready(docs.sparkSession)
    return common.need(docs, doc_id="bigint", text="string").mapInArrow(run, SCHEMA)


def write_buckets(packed: DataFrame, path: str) -> None:
    """Write the sequences with a folder for each length: every task adds a file to each of at most 13 (for 4096) of them."""
    packed.write.partitionBy("length").option("compression", "zstd").parquet(path)


def read_buckets(spark: SparkSession, path: str, length: int | None = None) -> DataFrame:
    """The sequences of all lengths, or of one, whose folder alone is read then."""
    stored = spark.read.schema(SCHEMA).parquet(path).select(*[c.split()[0] for c in SCHEMA.split(", ")])
    return stored if length is None else stored.filter(F.col("length") == length)


def bucketed(docs: DataFrame, tokenizer: str, end_id: int, limit: int = 4096) -> DataFrame:
    """The sequences of ``pack`` by way of their buckets: sequences of equal length lie together, none next to another length."""
    path = common.new_path(common.ready(docs.sparkSession), "packing-buckets")
    write_buckets(pack(docs, tokenizer, end_id, limit), path)
    return read_buckets(docs.sparkSession, path)
