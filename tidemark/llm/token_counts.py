"""Token counts: pieces are counted once for each distinct pre-token and summed over its frequencies in each document."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common, encode, words

COMMON = 1 << 19  # counts of the commonest pre-tokens sent to every task: at most so many, 10 bytes each


def count_tokens(docs: DataFrame, tokenizer: str, common_pieces: int = COMMON) -> DataFrame:
    """
    doc_id, n_bytes (UTF-8) and n_tokens of every text, as the tokenizers library counts them, without special tokens of
    its own. Pre-tokens are those of the library's byte-level pre-tokenizer, also in texts without white space; with
    another kind of tokenizer, stretches of text between two places where a character is followed by white space.

    1. Distinct pre-tokens with their frequencies, added up before and after one shuffle.
    2. The library counts the tokens of each distinct pre-token once; the table is written.
    3. Documents are read again. The counts of the commonest pre-tokens (all whose frequency reaches a power of two that
       at most ``common_pieces`` reach, hence a bound on what is sent) are looked up in the task; all others leave the
       task as (document, pre-token, frequency) and are joined with the table, so every pre-token is counted.

    No ids are made, and what is shuffled is rare pre-tokens only; no pre-token of the join is hot, since hot ones are common.
    Null or empty text: 0 bytes, 0 tokens. Null or repeated doc_id: each row is a document. Other columns are ignored.
    """
    spark = common.ready(docs.sparkSession)
    docs = common.need(docs, doc_id="bigint", text="string")

    def distinct(batches):
        splitter = encode.splitter(tokenizer)
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            for numbers, _ in splitter.encode(data, bounds):
                n = np.bincount(numbers)
                found = np.flatnonzero(n)
                texts = [splitter.names[i] for i in found.tolist()]
                yield pa.RecordBatch.from_arrays([pa.array(texts, pa.string()), pa.array(n[found])], ["piece", "n"])

    def counted(batches):
        encoder = encode.Encoder(tokenizer)
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("piece"))
            order, _, sizes = encoder.fresh(batch.column("piece").to_pylist())
            tokens = np.zeros(batch.num_rows, np.int32)
            tokens[order] = sizes
            keys = words.span_hashes(data, bounds[:-1], bounds[1:]).view(np.int64)
            yield pa.RecordBatch.from_arrays([pa.array(keys), batch.column("n"), pa.array(tokens)], ["key", "n", "tokens"])

    pieces = docs.select("text").mapInArrow(distinct, "piece string, n bigint").groupBy("piece").agg(F.sum("n").alias("n"))
    table = common.written(pieces.mapInArrow(counted, "key bigint, n bigint, tokens int"), "piece-counts")

    classes = sorted(table.groupBy(F.length(F.bin("n")).alias("bits")).count().collect(), reverse=True)  # 63 rows at most
    least, total = None, 0
    for bits, n in classes:
        total += n
        if total > common_pieces:
            break
        least = 1 << (bits - 1)
    usual = table.filter(F.col("n") >= least).select("key", "tokens").toPandas() if least else pd.DataFrame({"key": np.zeros(0, np.int64), "tokens": np.zeros(0, np.int32)})
    order = np.argsort(usual["key"].to_numpy().view(np.uint64))
    sent = spark.sparkContext.broadcast((usual["key"].to_numpy().view(np.uint64)[order], usual["tokens"].to_numpy()[order]))

    def known(batches):
        keys, tokens = sent.value
        number = TaskContext.get().partitionId() << 40
        splitter = encode.splitter(tokenizer)
        for batch in batches:
            data, bounds = common.text_buffer(batch.column("text"))
            b = 0
            for numbers, firsts in splitter.encode(data, bounds):
                a, b = b, b + len(firsts) - 1
                codes, own = pd.factorize(numbers)
                own = splitter.keys[own]
                at = np.minimum(np.searchsorted(keys, own), max(0, len(keys) - 1))
                hit = keys[at] == own if len(keys) else np.zeros(len(own), bool)
                counts = np.where(hit, tokens[at] if len(keys) else 0, 0).astype(np.int64)[codes]
                sums = np.diff(np.concatenate(([0], np.cumsum(counts)))[firsts])
                rare = np.flatnonzero(~hit[codes])
                rows = np.searchsorted(firsts, rare, "right") - 1
                pairs = np.sort(rows * (len(own) + 1) + codes[rare])
                first = np.flatnonzero(np.concatenate(([True], pairs[1:] != pairs[:-1]))) if len(pairs) else np.zeros(0, np.int64)
                times = np.diff(np.append(first, len(pairs))).astype(np.int32)
                row, code = pairs[first] // (len(own) + 1), pairs[first] % (len(own) + 1)
                lists = pa.array(np.searchsorted(row, np.arange(b - a + 1)).astype(np.int32))
                columns = [pa.array(number + np.arange(b - a)), batch.column("doc_id").slice(a, b - a), pa.array(np.diff(bounds[a : b + 1])), pa.array(sums), pa.ListArray.from_arrays(lists, pa.array(own[code].view(np.int64))), pa.ListArray.from_arrays(lists, pa.array(times))]
                yield pa.RecordBatch.from_arrays(columns, ["row", "doc_id", "n_bytes", "known", "keys", "times"])
                number += b - a

    per_doc = common.written(docs.mapInArrow(known, "row bigint, doc_id bigint, n_bytes bigint, known bigint, keys array<bigint>, times array<int>"), "document-pieces")
    rare = per_doc.select("row", F.explode(F.arrays_zip("keys", "times")).alias("p")).select("row", F.col("p.keys").alias("key"), F.col("p.times").alias("times"))
    rest = rare.join(table.select("key", "tokens"), "key").groupBy("row").agg(F.sum(F.col("times") * F.col("tokens")).alias("rest"))
    return per_doc.select("row", "doc_id", "n_bytes", "known").join(rest, "row", "left").select("doc_id", "n_bytes", (F.col("known") + F.coalesce("rest", F.lit(0))).alias("n_tokens"))
