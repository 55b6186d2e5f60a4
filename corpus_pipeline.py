"""A training corpus from ``documents``: quality rules, line dedup, one of each near copy, decontamination, packing."""

from __future__ import annotations

from functools import wraps

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import common, decontaminate, encode, line_dedup, ngram_join, packing, quality

TOKENIZER, END_ID, LIMIT = "word_bpe_49k.json", 2, 4096

ORACLE_SQL = None  # SQL can't express the tokenizer; tests hold the stages against brute force


_left: list[str] = []


def stage(function):
    """
    A stage deletes the intermediate tables of the stage before it: that one's result has been written by now, as the
    pipeline asks. A frame that a stage returned is void once another stage has been called.
    """

    @wraps(function)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        common.delete_tables(common.ready(spark), _left)
        with common.tables_made() as made:
            result = function(spark, docs, sf_dir)
        _left[:] = made
        return result

    return run_stage


@stage
def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the rules, without the lines that too many documents of their source share."""
    return quality.kept_documents(docs)


@stage
def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without lines that are near copies of earlier lines."""
    return line_dedup.without_copied_lines(docs)


@stage
def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document of each class of near copies."""
    return ngram_join.one_of_each(docs)


@stage
def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.without_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


@stage
def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token sequences whose lengths are powers of two, a bucket for each length."""
    return packing.bucketed(docs, encode.tokenizer_path(TOKENIZER), END_ID, LIMIT)


STAGES = [("quality", quality_rules), ("lines", dedup_lines), ("near copies", near_copies), ("decontamination", decontamination), ("packing", packed)]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages in turn; each result is written to the shared folder and read again as the next one's documents."""
    docs, before = common.ready(spark).read.parquet(f"{sf_dir}/documents.parquet"), None
    for name, function in STAGES:
        docs = common.written(function(spark, docs, sf_dir), f"pipeline-{name.replace(' ', '-')}")
        if before is not None:
            common.discard(before)
        before = docs
    common.delete_tables(spark, _left)
    _left.clear()
    return docs
