"""The driver-facing queries of the operators, each over its whole table, and their texts for DuckDB."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import common, decontaminate, encode, fill_middle, line_dedup, near_dedup, ngram_join, packing, pii, prefix_trie, quality, sharding, token_counts, token_files, url_filter

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

WORD_BPE, BYTE_BPE = "word_bpe_49k.json", "byte_bpe_50k.json"
END_ID = 2
# The rules of the url query.
URL_RULES = [("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block")]


def query(name: str, oracle: str | None = None):
    def add(f):
        QUERIES[name] = f
        if oracle is not None:
            ORACLES[name] = oracle
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return common.ready(spark).read.parquet(f"{sf_dir}/{name}.parquet")


URL_SQL = """
WITH u AS (
  SELECT page_id, coalesce(url, '') AS url, strpos(coalesce(url, ''), '://') AS pos FROM pages
), r AS (
  SELECT page_id, CASE WHEN pos > 0 THEN substr(url, pos + 3) ELSE '' END AS rest FROM u
), p AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path FROM r
), rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'), ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')
), m AS (
  SELECT p.*, rule_host || rule_path AS rule, rule_verdict,
    row_number() OVER (PARTITION BY page_id, host, path ORDER BY length(rule_host || rule_path) DESC NULLS LAST, length(rule_host) DESC) AS k
  FROM p LEFT JOIN rules ON (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)
)
SELECT page_id, host, path, rule, coalesce(rule_verdict, 'allow') AS verdict FROM m WHERE k = 1
"""


@query("op1_url_filters", URL_SQL)
def url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    rules = common.ready(spark).createDataFrame(URL_RULES, "host string, path string, verdict string")
    return url_filter.filter_urls(table(spark, sf_dir, "pages"), rules)


@query("op4_token_files")
def token_file_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = common.new_path(common.ready(spark), "token-files")
    token_files.write_token_files(table(spark, sf_dir, "documents"), path, encode.tokenizer_path(WORD_BPE), END_ID)
    return token_files.read_token_files(spark, path).select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


QUALITY_SQL = """
WITH d AS (SELECT doc_id, source, text, coalesce(text, '') AS t FROM documents),
w AS (
  SELECT *, list_filter(string_split_regex(t, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words,
    translate(t, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') AS solid,
    list_filter(string_split(t, chr(10)), lambda x: translate(x, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '') <> '') AS lines
  FROM d
),
m AS (
  SELECT doc_id, source, text, lines, len(words) AS n_words, length(solid)::BIGINT AS word_chars,
    (length(t) - length(translate(t, '#*$%&|<>', '')))::BIGINT AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines
  FROM w
),
g AS (SELECT doc_id, i, words[i] || ' ' || words[i + 1] || ' ' || words[i + 2] AS tri FROM (SELECT doc_id, words, unnest(range(1, len(words) - 1)) AS i FROM w)),
again AS (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, tri) AS n FROM g),
covered AS (SELECT doc_id, count(DISTINCT i + k) AS n_repeat_words FROM again, range(3) AS r(k) WHERE n > 1 GROUP BY doc_id),
l AS (
  SELECT doc_id, source, text, trim(regexp_replace(translate(line, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ123456789', 'abcdefghijklmnopqrstuvwxyz000000000'), '[\\x20\\x09-\\x0D]+', ' ', 'g')) AS line,
    length(translate(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13), '')) AS chars
  FROM (SELECT doc_id, source, text, unnest(lines) AS line FROM m)
),
often AS (
  SELECT source, line FROM (SELECT source, line, count(DISTINCT text) AS n FROM l GROUP BY ALL) JOIN (SELECT source, count(DISTINCT text) AS docs FROM d GROUP BY ALL) USING (source)
  WHERE n > 20 AND (n > 0.05 * docs OR n > 1000)
),
gone AS (SELECT doc_id, sum(chars)::BIGINT AS removed_chars FROM l JOIN often USING (source, line) GROUP BY doc_id),
j AS (
  SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, coalesce(n_repeat_words, 0) AS n_repeat_words, coalesce(removed_chars, 0) AS removed_chars
  FROM m LEFT JOIN covered USING (doc_id) LEFT JOIN gone USING (doc_id)
)
SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed,
  NOT (n_words < 50 OR 100 * n_repeat_words > 50 * n_words) AND word_chars - removed_chars >= 0.5 * word_chars AS kept
FROM j
"""


@query("op6_quality_rules", QUALITY_SQL)
def quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = quality.quality(table(spark, sf_dir, "documents"))
    return judged.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "removed_chars", "base_failed", "kept")


@query("op8_packing")
def packing_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.bucketed(table(spark, sf_dir, "documents"), encode.tokenizer_path(WORD_BPE), END_ID)
    return packed.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op9_token_counts")
def token_count_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    counted = token_counts.count_tokens(table(spark, sf_dir, "documents"), encode.tokenizer_path(BYTE_BPE))
    return counted.withColumn("over_limit", F.col("n_tokens") > 1024)


@query("op10_sharding")
def sharding_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard(table(spark, sf_dir, "documents"), 24)


@query("op7_ngram_join")
def ngram_join_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.similar(table(spark, sf_dir, "documents")).select("doc_id", "class_id", "n_links", "keep", "copy_1", "copy_2")


@query("op2_line_dedup")
def line_dedup_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.removed_lines(table(spark, sf_dir, "documents"), min_words=line_dedup.EVERY_LINE)
    return found.select("doc_id", "n_lines", "n_removed", "removed")


LEAKS_SQL = """
WITH both_texts AS (
  SELECT 'd' AS side, doc_id AS id, coalesce(text, '') AS text FROM documents UNION ALL SELECT 'i', item_id, coalesce(text, '') FROM benchmark
), w AS (
  SELECT side, id, list_filter(string_split_regex(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), lambda x: x <> '') AS words
  FROM both_texts
), s AS (
  SELECT DISTINCT side, id, array_to_string(words[i : i + 4], ' ') AS shingle FROM (SELECT side, id, words, unnest(range(1, len(words) - 3)) AS i FROM w)
), n AS (
  SELECT id AS item_id, count(*) AS n_shingles FROM s WHERE side = 'i' GROUP BY id
), shared AS (
  SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared FROM s d JOIN s i ON d.shingle = i.shingle AND d.side = 'd' AND i.side = 'i' GROUP BY ALL
)
SELECT doc_id, item_id, n_shingles, n_shared, n_shared / n_shingles AS containment FROM shared JOIN n USING (item_id) WHERE n_shared >= 0.8 * n_shingles
"""


@query("op3_decontamination", LEAKS_SQL)
def leaks(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))
    return found.select("doc_id", "item_id", "n_shingles", "n_shared", "containment")


@query("op5_pii")
def personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pii.find(table(spark, sf_dir, "documents"))
    counts = [F.size(pii.of_kind("base", k)).cast("bigint").alias(f"n_{k}") for k in pii.KINDS]
    return found.select("doc_id", *counts, F.sha2(pii.joined(F.col("base")), 256).alias("base_sha256"), pii.joined(F.concat("base", "added")).alias("spans"), F.size("added").cast("bigint").alias("n_added"))


MIDDLE_SQL = """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, string_split(coalesce(text, ''), chr(10)) AS parts, sha256('7:' || coalesce(doc_id::VARCHAR, '')) AS digest FROM documents
), h AS (
  SELECT doc_id, t, parts, (len(parts) - CASE WHEN parts[len(parts)] = '' THEN 1 ELSE 0 END)::BIGINT AS n, ('0x' || substr(digest, 1, 8))::BIGINT AS h1,
    ('0x' || substr(digest, 9, 8))::BIGINT AS h2, ('0x' || substr(digest, 17, 8))::BIGINT AS h3, ('0x' || substr(digest, 25, 8))::BIGINT AS h4 FROM d
), k AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS k1, greatest(h1 % (n + 1), h2 % (n + 1)) AS k2,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form FROM h
), c AS (
  SELECT doc_id, n, form, t, CASE WHEN k1 = 0 THEN 0 WHEN k1 = n THEN length(t) ELSE length(array_to_string(parts[1:k1], chr(10))) + 1 END::BIGINT AS p,
    CASE WHEN k2 = 0 THEN 0 WHEN k2 = n THEN length(t) ELSE length(array_to_string(parts[1:k2], chr(10))) + 1 END::BIGINT AS m FROM k
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN p END AS prefix_chars, CASE WHEN form <> 'plain' THEN m - p END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || substr(t, 1, p) || '<S>' || substr(t, m + 1) || '<M>' || substr(t, p + 1, m - p)
    ELSE '<S>' || substr(t, m + 1) || '<P>' || substr(t, 1, p) || '<M>' || substr(t, p + 1, m - p) END) AS output_sha256, sha256(t) AS restored_sha256
FROM c
"""


@query("op11_fill_middle", MIDDLE_SQL)
def fill_middle_digest(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = fill_middle.transform(table(spark, sf_dir, "documents"), "lines", seed=7, rate=100, spm_rate=50)
    digests = F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_middle.restored(F.col("output"), F.col("form")), 256).alias("restored_sha256")
    return made.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *digests)


NEAR_SQL = """
WITH RECURSIVE d AS (
  SELECT row_number() OVER () AS r, doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\\x20\\x09-\\x0D]+'), lambda x: x <> '') AS words
  FROM documents
), s AS (
  SELECT DISTINCT r, array_to_string(words[i : i + 3], ' ') AS shingle FROM (SELECT r, words, unnest(range(1, greatest(len(words) - 2, 2))) AS i FROM d WHERE len(words) > 0)
), n AS (
  SELECT r, count(*) AS n, list(shingle ORDER BY shingle) AS shingles FROM s GROUP BY r
), classes AS (
  SELECT min(r) AS c, any_value(n) AS n, shingles, list(r) AS members FROM n GROUP BY shingles
), of_class AS (
  SELECT c, n, unnest(members) AS r FROM classes
), shared AS (
  SELECT a.c AS a, b.c AS b, count(*) AS k FROM (SELECT c, unnest(shingles) AS shingle FROM classes) a JOIN (SELECT c, unnest(shingles) AS shingle FROM classes) b ON a.shingle = b.shingle AND a.c <> b.c GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN classes x ON x.c = a JOIN classes y ON y.c = b WHERE 100 * k >= 80 * (x.n + y.n - k)
), reach(c, to_c) AS (
  SELECT c, c FROM classes UNION SELECT reach.c, links.b FROM reach JOIN links ON links.a = reach.to_c
), component AS (
  SELECT reach.c, min(doc_id) AS component_id FROM reach JOIN of_class ON of_class.c = to_c JOIN d USING (r) GROUP BY reach.c
)
SELECT doc_id, coalesce(n, 0)::BIGINT AS n_shingles, CASE WHEN n IS NULL THEN doc_id ELSE component_id END AS component_id,
  n IS NULL OR doc_id = component_id AS kept
FROM d LEFT JOIN of_class USING (r) LEFT JOIN component USING (c)
"""


@query("op12_near_dedup", NEAR_SQL)
def near_dedup_components(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.components(table(spark, sf_dir, "documents"))


TRIE_SQL = """
WITH t AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, md5(length(coalesce(role, ''))::VARCHAR || ':' || coalesce(role, '') || coalesce(text, ''))) AS i
  FROM conversations WHERE conv_id IS NOT NULL
), k AS (
  SELECT conv_id, i, md5(length(role)::VARCHAR || ':' || role || text) AS turn, octet_length(encode(text))::BIGINT AS bytes FROM t
), c AS (
  SELECT conv_id AS c, conv_id - conv_id % 5 AS base, xor(list_reduce(list_concat([4294967295::BIGINT], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda s, b: list_reduce(list_concat([xor(s, b)], [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]), lambda y, z: xor(y >> 1, 3988292384 * (y & 1)))), 4294967295) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM t)
), parts AS (
  SELECT c, 0 AS part, i, turn, bytes FROM c JOIN k ON k.conv_id = base AND i <= h
  UNION ALL SELECT c, 1, i, turn, bytes FROM c JOIN k ON k.conv_id = c AND i > h
), s AS (
  SELECT c, coalesce(turns, []) AS turns, coalesce(sizes, []) AS sizes FROM c LEFT JOIN (SELECT c, list(turn ORDER BY part, i) AS turns, list(bytes ORDER BY part, i) AS sizes FROM parts GROUP BY c) USING (c)
), p AS (
  SELECT c, d, array_to_string(turns[1:d], ',') AS node, CASE WHEN d > 0 THEN array_to_string(turns[1:d - 1], ',') END AS parent, turns[1:d] AS turns, CASE WHEN d = 0 THEN 0 ELSE sizes[d] END AS bytes, len(turns) = d AS ends
  FROM (SELECT c, turns, sizes, unnest(range(0, len(turns) + 1)) AS d FROM s)
), n AS (
  SELECT d, node, any_value(parent) AS parent, any_value(turns) AS turns, min(c) AS conv_id, count(*) AS n_convs, (count(*) - 1) * any_value(bytes) AS saved,
    sha256(coalesce(string_agg(CASE WHEN ends THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256
  FROM p GROUP BY d, node
), children AS (
  SELECT d - 1 AS d, parent AS node, count(*) AS n_children FROM n WHERE d > 0 GROUP BY ALL
), w AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children FROM n LEFT JOIN children USING (d, node)
), below AS (
  SELECT up AS d, array_to_string(turns[1:up], ',') AS node, sum((n_children = 0)::BIGINT)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens
  FROM (SELECT turns, n_children, saved, unnest(range(0, d + 1)) AS up FROM w) GROUP BY ALL
)
SELECT w.conv_id, w.d AS depth, above.conv_id AS parent_conv_id, w.n_convs, w.n_children, n_leaves, saved_tokens, w.ends_sha256
FROM w JOIN below USING (d, node) LEFT JOIN n above ON above.d = w.d - 1 AND above.node = w.parent
"""


@query("op13_prefix_trie", TRIE_SQL)
def prefix_trie_nodes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.trie(table(spark, sf_dir, "conversations"))
