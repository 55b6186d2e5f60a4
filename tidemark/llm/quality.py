"""Quality rules on words, symbols and repetition, and lines that many documents of a host share. Column expressions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm import common

SPACES = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

MIN_WORDS = 50
MAX_REPEAT_PERCENT = 50
# A line is taken for a host's boilerplate if more distinct texts of the host hold it than both limits allow.
MIN_DOCS = 20
MAX_DOCS = 1000  # a line in more texts of a host than that is boilerplate whatever the host's size
MAX_SHARE = 0.05
# A document is depleted if less than this share of its word characters is left.
LEAST_LEFT = 0.5


def without(text: Column, characters: str) -> Column:
    return F.translate(text, characters, "")


def word_list(text: Column) -> Column:
    return F.filter(F.split(text, "[\\x20\\x09-\\x0D]+"), lambda w: w != "")


def lines_with_words(text: Column) -> Column:
    return F.filter(F.split(text, "\n"), lambda line: without(line, SPACES) != "")


def normal_line(line: Column) -> Column:
    """ASCII letters in lower case, digits as 0, runs of white space as one space."""
    line = F.translate(line, "ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789", "abcdefghijklmnopqrstuvwxyz000000000")
    return F.trim(F.regexp_replace(line, "[\\x20\\x09-\\x0D]+", " "))


def shift_left(value: Column, bits: Column) -> Column:
    return F.call_function("shiftleft", value, bits)


def repeated_words(words: str, count: str, bits: str) -> Column:
    """
    Words that lie in a three-word window found again in the same text. Windows are hashed into the upper bits of a
    number whose lower bits hold the place, sorted as plain numbers, and neighbours of equal hash are compared word by
    word. ``bits``: column with the bits that hold a place.
    """
    n, width, all_ = F.col(count), F.col(bits), F.col(words)

    def packed(i: Column) -> Column:
        h = F.xxhash64(F.get(all_, i), F.get(all_, i + 1), F.get(all_, i + 2))
        return shift_left(h, width).bitwiseOR(i.cast("bigint"))

    return F.when(n >= 4, F.sort_array(F.transform(F.sequence(F.lit(0), n - 3), packed)))


def metrics(docs: DataFrame) -> DataFrame:
    """Add n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words and base_failed for the column ``_text``; no shuffle."""
    kept = docs.columns
    text = F.col("_text")
    one = docs.select(
        *kept, word_list(text).alias("_words"), F.char_length(without(text, SPACES)).cast("bigint").alias("word_chars"),
        (F.char_length(text) - F.char_length(without(text, SYMBOLS))).cast("bigint").alias("n_symbols"), lines_with_words(text).alias("_lines"),
    )
    two = one.select(
        *kept, "_words", "word_chars", "n_symbols", F.size("_words").alias("_n"), (F.size("_lines") - F.size(F.array_distinct("_lines"))).cast("bigint").alias("n_dup_lines"),
        F.length(F.bin(F.size("_words").cast("bigint"))).cast("int").alias("_bits"),
    )
    keys = [*kept, "_words", "word_chars", "n_symbols", "_n", "n_dup_lines", "_bits"]
    three = two.select(*keys, repeated_words("_words", "_n", "_bits").alias("_sorted"))

    def equal(a: Column, b: Column) -> Column:
        place_a, place_b = (x.bitwiseAND(shift_left(F.lit(1).cast("bigint"), F.col("_bits")) - 1).cast("int") for x in (a, b))
        same = [F.get(F.col("_words"), place_a + k) == F.get(F.col("_words"), place_b + k) for k in range(3)]
        return (F.call_function("shiftright", a, F.col("_bits")) == F.call_function("shiftright", b, F.col("_bits"))) & same[0] & same[1] & same[2]

    last = F.size("_sorted") - 1
    pairs = F.filter(
        F.col("_sorted"),
        lambda x, i: F.coalesce(((i > 0) & equal(x, F.get(F.col("_sorted"), i - 1))) | ((i < last) & equal(x, F.get(F.col("_sorted"), i + 1))), F.lit(False)),
    )
    four = three.select(*keys, F.transform(pairs, lambda x: x.bitwiseAND(shift_left(F.lit(1).cast("bigint"), F.col("_bits")) - 1)).alias("_places"))
    covered = F.size(F.array_distinct(F.flatten(F.transform("_places", lambda p: F.array(p, p + 1, p + 2)))))
    five = four.select(
        *kept, F.col("_n").cast("bigint").alias("n_words"), "word_chars", "n_symbols", "n_dup_lines",
        F.when(F.col("_n") >= 4, F.coalesce(covered, F.lit(0))).otherwise(0).cast("bigint").alias("n_repeat_words"),
    )
    failed = (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    # The partition's number keeps a filter on the verdict above this projection: below it, the filter would hold every
    # expression above written out in full, a tree too large to plan.
    return five.withColumn("base_failed", failed & (F.spark_partition_id() >= 0))


def boilerplate(docs: DataFrame, min_docs: int, max_share: float, max_docs: int) -> DataFrame:
    """
    For each text (_host, _key) that has lines over the limits: _removed (their hashes) and _removed_chars (characters of
    words in them). Documents are counted once for each distinct text of a host, so copies of a text make no boilerplate.
    """
    line = F.explode(lines_with_words(F.col("_text"))).alias("_line")
    lines = docs.select("_host", "_key", line).select("_host", "_key", F.xxhash64(normal_line(F.col("_line"))).alias("_line"), F.char_length(without(F.col("_line"), SPACES)).alias("_chars"))
    # A text that has many rows gives the same sums for each of them: the mean over its rows is what one row has.
    rows = common.written(docs.groupBy("_host", "_key").agg(F.count("*").alias("_rows")), "host-texts")
    lines = common.written(lines.groupBy("_host", "_line", "_key").agg(F.sum("_chars").alias("_chars")), "host-lines")
    sizes = rows.groupBy("_host").agg(F.count("*").alias("_docs"))
    often = lines.groupBy("_host", "_line").agg(F.count("*").alias("_n")).filter(F.col("_n") > min_docs)
    often = often.join(sizes, "_host").filter((F.col("_n") > max_share * F.col("_docs")) | (F.col("_n") > max_docs)).select("_host", "_line")
    removed = lines.join(often, ["_host", "_line"]).groupBy("_host", "_key").agg(F.collect_set("_line").alias("_removed"), F.sum("_chars").alias("_all_chars"))
    return removed.join(rows, ["_host", "_key"]).select("_host", "_key", "_removed", (F.col("_all_chars") / F.col("_rows")).alias("_removed_chars"))


def quality(docs: DataFrame, min_docs: int = MIN_DOCS, max_share: float = MAX_SHARE, least_left: float = LEAST_LEFT, max_docs: int = MAX_DOCS) -> DataFrame:
    """
    Judge every document: doc_id, text, lang, source, n_chars, then n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, base_failed, removed_chars, clean_text and kept.

    Method: normalised lines are hashed and the distinct texts of each host (``source``) that hold them are counted. A line
    in more than ``min_docs`` texts is boilerplate, and missing from clean_text, if it is in more than ``max_share`` of the
    host's texts or, in a host of very many, in more than ``max_docs`` of them. A document is kept unless a base rule fails (fewer than 50 words, or more than half of them in repeated
    three-word windows) or less than ``least_left`` of its word characters are left.

    The text never takes part in a shuffle unless clean_text is asked for. Lines are summed for (host, line, text) before
    they are counted, so a line that most documents share is dealt out by text; the join that finds a text's lines
    over the limits has few lines on one side, and its uneven keys are split at run time.

    Null text: no words, not kept, clean_text null. Empty text: no words, not kept. Null source is a host of its own.
    Repeated rows get the same verdict. Missing columns are null, others are ignored. An empty table gives no rows.
    """
    common.ready(docs.sparkSession)
    own = common.need(docs, doc_id="bigint", text="string", lang="string", source="string", n_chars="bigint")
    keyed = own.select("*", F.coalesce("text", F.lit("")).alias("_text"), F.xxhash64(F.lit(1), "source").alias("_host"), F.xxhash64(F.lit(2), "text").alias("_key"))
    removed = boilerplate(keyed.select("_host", "_key", "_text"), min_docs, max_share, max_docs)
    judged = metrics(keyed).join(removed, ["_host", "_key"], "left")
    left = F.col("word_chars") - F.coalesce("_removed_chars", F.lit(0))
    rest = F.filter(F.split("text", "\n"), lambda line: (without(line, SPACES) == "") | ~F.array_contains("_removed", F.xxhash64(normal_line(line))))
    return judged.select(
        "doc_id", "text", "lang", "source", "n_chars", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        F.coalesce("_removed_chars", F.lit(0)).cast("bigint").alias("removed_chars"),
        F.when(F.col("_removed").isNull(), F.col("text")).otherwise(F.array_join(rest, "\n")).alias("clean_text"),
        (~F.col("base_failed") & (left >= least_left * F.col("word_chars"))).alias("kept"),
    )


def kept_documents(docs: DataFrame) -> DataFrame:
    """The kept documents without their hosts' boilerplate lines, in the columns of ``documents``."""
    return quality(docs).filter("kept").select("doc_id", F.col("clean_text").alias("text"), "lang", "source", F.char_length("clean_text").cast("bigint").alias("n_chars"))
