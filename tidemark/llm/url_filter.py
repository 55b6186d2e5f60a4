"""URL rules by a sorted sweep over reversed hosts and paths. Column expressions and SQL operators only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm import common

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z in lower case; empty if there is no ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, "(?s)^.*?://([^/?#]*)", 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """After the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, "(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def host_key(host: Column) -> Column:
    """Labels from the last to the first, each followed by a dot: a host and its subdomains have one prefix."""
    return F.concat(F.array_join(F.reverse(F.split(host, "\\.")), "."), F.lit("."))


def _interval(key: Column) -> tuple[Column, Column]:
    """First and, exclusive, last key with this prefix, as bytes: no UTF-8 byte reaches FF."""
    return F.encode(key, "UTF-8"), F.concat(F.encode(key, "UTF-8"), F.unhex(F.lit("FF")))


def sweep(points: DataFrame, rules: DataFrame, label: str) -> DataFrame:
    """
    Find for each point the rules whose interval holds it. ``points``: key (string, distinct). ``rules``: key (a prefix),
    level (0, 1, ...: two rules of one level never nest) and rule (anything not null). Returns key and stack: the active
    rules from the outermost to the innermost.

    Bounds of the rules and the points are dealt by ranges of the key and written. Along the key, a start puts its rule
    on its level of the stack and an end takes it off; the last event of a level before a point says what is active there.
    A range begins with the stack that the ranges before it leave, one row a range.
    """
    levels = (rules.agg(F.max("level")).first()[0] or 0) + 1
    start, end = _interval(F.col("key"))
    kind = dict(rules.dtypes)["rule"]
    events = rules.select(start.alias("at"), F.lit(1).alias("turn"), "level", "rule", F.lit(None).cast("string").alias("key")).unionByName(
        rules.select(end.alias("at"), F.lit(0).alias("turn"), "level", F.lit(None).cast(kind).alias("rule"), F.lit(None).cast("string").alias("key"))
    )
    marks = points.select(start.alias("at"), F.lit(2).alias("turn"), F.lit(None).cast("int").alias("level"), F.lit(None).cast(kind).alias("rule"), "key")
    order = ["at", "turn", "level"]
    parts = common.written(events.unionByName(marks).repartitionByRange(*order).withColumn("part", F.spark_partition_id()), label)

    def slot(level: int, rule: str) -> Column:
        return F.when(F.col("level") == level, F.struct(F.col(rule).alias("rule")))

    slots = [f"slot_{k}" for k in range(levels)]
    ends = parts.filter("level is not null").groupBy("part").agg(*[F.max_by(F.struct("rule"), F.when(F.col("level") == k, F.struct("at", "turn"))).alias(slots[k]) for k in range(levels)])
    every = parts.groupBy("part").agg(F.lit(1).alias("_one")).drop("_one").join(ends, "part", "left")
    earlier = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    carried = every.select("part", *[F.last(s, ignorenulls=True).over(earlier).alias(s) for s in slots])
    so_far = Window.partitionBy("part").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    # One row a range: its size is bounded by the number of partitions.
    swept = parts.select("*", *[F.last(slot(k, "rule"), ignorenulls=True).over(so_far).alias(f"own_{k}") for k in range(levels)]).filter("key is not null").join(F.broadcast(carried), "part")
    active = [F.coalesce(f"own_{k}", s)["rule"] for k, s in enumerate(slots)]
    return swept.select("key", F.array_compact(F.array(*active)).alias("stack"))


def filter_urls(pages: DataFrame, rules: DataFrame, default: str = "allow") -> DataFrame:
    """
    page_id, host, path, rule (host and path of the rule, or null) and verdict for every page.

    ``rules`` has host, path and verdict. A rule fits its host and all subdomains if the url's path starts with the rule's.
    The longest rule (host and path together; of equally long ones the one with the longer host) wins; without one the
    verdict is ``default``. Of two rules with equal host and path the greater verdict ("block") holds.

    Two sweeps find the rules: one over the distinct hosts, and for the rule hosts found one over the distinct (rule host,
    path). Rules may be many: they are never sent to all tasks. A host with a third of all pages is dealt out by path,
    and a url with a third of all pages is one key of the sweep; pages meet their key in a join whose uneven keys are
    split at run time.

    Null url, or one without ``://``: empty host and path, default verdict. Rules without host or verdict fit nothing; a
    rule's null path is empty and fits every path. Repeated pages are judged one by one. No rules: everything gets the
    default. Empty table: no rows. Other columns are ignored.
    """
    common.ready(pages.sparkSession)
    rules = (
        common.need(rules, host="string", path="string", verdict="string").select(F.translate("host", UPPER, LOWER).alias("host"), F.coalesce("path", F.lit("")).alias("path"), "verdict")
        .filter("host <> '' and verdict is not null").groupBy("host", "path").agg(F.max("verdict").alias("verdict"))
    )
    rules = common.written(rules, "url-rules")
    urls = common.need(pages, page_id="bigint", url="string").select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    places = common.written(urls.select("host", "path").distinct(), "url-places")

    hosts = rules.select(F.col("host").alias("rule")).distinct().select(host_key(F.col("rule")).alias("key"), (F.size(F.split("rule", "\\.")) - 1).alias("level"), "rule")
    found = sweep(places.select(host_key(F.col("host")).alias("key")).distinct(), hosts, "url-hosts")
    # For each place the rule hosts that fit it, at most one a label.
    near = common.written(places.join(found.filter("size(stack) > 0"), host_key(F.col("host")) == F.col("key")).select("host", "path", F.explode("stack").alias("rule_host")), "url-near")

    # The level of a path rule is the number of shorter rules of its host that it starts with.
    lengths = rules.groupBy("host").agg(F.collect_set(F.char_length("path")).alias("lengths"))
    shorter = rules.join(lengths, "host").select("host", "path", F.explode(F.filter("lengths", lambda n: n < F.char_length("path"))).alias("n")).select("host", "path", F.expr("substring(path, 1, n)").alias("outer_path"))
    outer = rules.select(F.col("host").alias("outer_host"), F.col("path").alias("outer_path"))
    levels = shorter.join(outer.withColumnRenamed("outer_host", "host"), ["host", "outer_path"]).groupBy("host", "path").agg(F.count("*").cast("int").alias("level"))
    full = F.concat("host", F.lit("\x01"), "path")
    paths = rules.join(levels, ["host", "path"], "left").select(full.alias("key"), F.coalesce("level", F.lit(0)).alias("level"), F.struct("host", "path", "verdict").alias("rule"))
    probe = F.concat("rule_host", F.lit("\x01"), "path")
    hit = sweep(near.select(probe.alias("key")).distinct(), paths, "url-paths")
    # The innermost rule of a rule host is its longest; the longest of all rule hosts wins.
    best = F.max_by(F.element_at("stack", -1), F.struct(F.char_length(F.concat(F.element_at("stack", -1)["host"], F.element_at("stack", -1)["path"])), F.char_length("rule_host")))
    chosen = near.join(hit.filter("size(stack) > 0"), probe == F.col("key")).groupBy("host", "path").agg(best.alias("rule"))
    return urls.join(chosen, ["host", "path"], "left").select(
        "page_id", "host", "path", F.concat("rule.host", "rule.path").alias("rule"), F.coalesce("rule.verdict", F.lit(default)).alias("verdict"),
    )
