"""Streaming twin of the incremental export: each micro-batch is exported and remembered."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.query import StreamingQuery

from tidemark.files import Files
from tidemark.plans.incremental import next_state, pending_documents, write_dataset_files
from tidemark.plans.state import advance_state
from tidemark.session import materialize
from tidemark.sinks.tables import StateTable


HELD_NUMBER = 0xFFFFFFFF  # in the place of a batch's number, in the names of files of documents that were held back


def start_incremental_export(
    docs: DataFrame, descriptors: DataFrame, state: StateTable, held: str, upper_id: str, checkpoint: str, time_zone: str = "UTC"
) -> StreamingQuery:
    """Export arriving documents of the described datasets in the range (last exported id, upper id], and return when all are done.

    The stream's checkpoint decides which documents have arrived. Those above the upper id (younger than the grace) are
    kept in the folder ``held``; the next run exports those that its upper id has reached, with or without new arrivals. Files get the final names, with the upper id
    and the batch number in the low digits, so a batch that is run again after a failure writes the same names; the state
    keeps the highest id and follows the files. Documents of a dataset have to arrive in the order of their ids.
    """
    spark = docs.sparkSession

    def publish(rows: DataFrame, number: int) -> None:
        pending = materialize(pending_documents(rows, descriptors, state.read(), upper_id), "pending")
        sizes = materialize(next_state(pending), "sizes")
        write_dataset_files(pending, sizes, descriptors, F.lit(f"{upper_id[:16]}{number:08x}"), time_zone)
        state.update(lambda now: advance_state(now, sizes))

    def export(batch: DataFrame, batch_id: int) -> None:
        rows = batch
        earlier = [n for n in Files(spark).names(held) if int(n) < batch_id]
        if earlier:  # the last one holds all that still waits
            rows = rows.unionByName(spark.read.schema(batch.schema).parquet(f"{held}/{earlier[-1]}"))
        rows = materialize(rows, "batch")
        rows.where(F.col("id") > upper_id).write.mode("overwrite").parquet(f"{held}/{batch_id:012d}")
        publish(rows, batch_id)
        for n in earlier[:-1]:  # the last one stays until this batch is known to be done
            Files(spark).delete(f"{held}/{n}")

    query = docs.writeStream.foreachBatch(export).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    # A batch takes up what was held back, together with what has arrived: the ids of both may be mixed. Where nothing has
    # arrived there was no batch, and what has come of age meanwhile is exported here.
    kept = [n for n in Files(spark).names(held) if Files(spark).is_complete(f"{held}/{n}")]
    if kept:
        ripe = spark.read.schema(docs.schema).parquet(f"{held}/{kept[-1]}").where(F.col("id") <= upper_id)
        if not ripe.isEmpty():
            publish(ripe, HELD_NUMBER)
    return query
