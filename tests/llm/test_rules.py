"""Quality rules and URL filters."""

import os
import random

import duckdb
import pytest

from tidemark.llm import queries, quality, url_filter

from . import brute
from .conftest import CLASHES, SF, frame
from pyspark.sql import functions as F


def test_quality_metrics(odd_docs, odd_rows, no_docs):
    rows = quality.quality(odd_docs).collect()
    names = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed")
    assert sorted((str(r["doc_id"]), *[r[n] for n in names]) for r in rows) == sorted((str(d), *brute.quality(t)) for d, t, *_ in odd_rows)
    assert all(not r["kept"] for r in rows if r["base_failed"])
    assert quality.quality(no_docs).count() == 0


def test_repeats(llm):
    rng = random.Random(3)
    rows = [(i, " ".join(rng.choice("abcd") for _ in range(rng.randrange(0, 40))), "en", "a", 0) for i in range(200)]
    got = {r["doc_id"]: r["n_repeat_words"] for r in quality.quality(frame(llm, rows)).collect()}
    assert got == {d: brute.quality(t)[4] for d, t, *_ in rows}


def test_boilerplate(llm):
    rng = random.Random(4)
    own = lambda: " ".join(f"x{rng.randrange(10**6)}" for _ in range(60))
    rows = [(i, f"{own()}\nRead  more on page {i % 10}\n{own()}", "en", "a", 0) for i in range(30)]
    rows += [(100 + i, "Read more on page 3\n" * 40 + own(), "en", "a", 0) for i in range(2)]
    rows += [(200 + i, rows[0][1], "en", "b", 0) for i in range(30)]
    found = {r["doc_id"]: r for r in quality.quality(frame(llm, rows), min_docs=5, max_share=0.5, least_left=0.9).collect()}
    assert all("Read" not in found[i]["clean_text"] and found[i]["kept"] and found[i]["removed_chars"] == 15 for i in range(30))
    assert not any(found[100 + i]["kept"] for i in range(2))
    # Copies of one text are one text of their host, so nothing of it is boilerplate.
    assert all(found[200 + i]["clean_text"] == rows[0][1] and found[200 + i]["kept"] for i in range(30))


def test_boilerplate_of_a_large_host(llm):
    name = lambda i: "".join(chr(97 + i // 26**k % 26) for k in range(3))  # noqa: E731 - digits are all alike in a normalised line
    rows = [(i, f"text {name(i)} of its own\n{'banner' if i < 60 else 'rare' if i < 100 else f'q{name(i)}'} line", "en", "a", 0) for i in range(3000)]
    judge = lambda limit: {r["doc_id"]: r["clean_text"] for r in quality.quality(frame(llm, rows), max_docs=limit).collect()}
    one, other = judge(50), judge(1000)  # 60 texts are 2 % of the host
    assert {d for d in one if "banner" not in one[d] and d < 60} == set(range(60)) and all("rare" in one[d] for d in range(60, 100))
    assert other == {d: t for d, t, *_ in rows}


def test_kept_documents(odd_docs):
    kept = quality.kept_documents(odd_docs)
    assert kept.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert {r["doc_id"] for r in kept.collect()} >= {4, 5, 6, 10}


def urls():
    rng = random.Random(5)
    labels = ["a", "b", "com", "net", "example", "www", "", "é", "COM", "x-1"]
    out = [None, "", "no scheme", "http://", "http://com", "http://com/", "HTTP://A.Com/?x", "http://a.com#f", "http://é.com/ü?x", "http://u@a.com:80/p", "x://y://z/q", "http://a.\ncom/en/\nx"]
    out += ["http://" + ".".join(rng.choice(labels) for _ in range(rng.randrange(1, 5))) + rng.choice(["", "/", "/en", "/en/", "/en/x/y", "/e?q", "/é/"]) for _ in range(600)]
    return out + out[-100:]


def test_url_rules(llm):
    rules = [("com", "/", "allow"), ("a.com", "/en", "block"), ("b.a.com", "", "allow"), ("com", "/en/x", "block"), ("net", "/en/", "block"), ("net", "/en/", "allow"), ("example", None, "block"), (None, "/", "block"), ("", "/", "block"), ("www", "/", None), ("É.com", "/", "block"), ("é.com", "/é", "allow")]
    pages = [(i % 650, u) for i, u in enumerate(urls())]
    frame = llm.createDataFrame(pages, "page_id bigint, url string").select("*", *[F.lit("x").alias(c) for c in CLASHES])
    table = llm.createDataFrame(rules, "host string, path string, verdict string").withColumn("rule", F.lit(1))
    rows = url_filter.filter_urls(frame, table).collect()
    plain = {}
    for h, p, v in rules:
        if h and v:
            key = (h.replace("A-Z", ""), p or "")
            plain[key] = max(plain.get(key, ""), v)
    plain = [(h, p, v) for (h, p), v in plain.items()]
    want = []
    for i, u in pages:
        host, path = brute.url_parts(u)
        rule, verdict = brute.url_rule(host, path, plain)
        want.append((i, host, path, rule, verdict or "allow"))
    key = lambda r: tuple(map(str, r))
    assert sorted(map(tuple, rows), key=key) == sorted(want, key=key)


def test_no_urls(llm):
    pages = llm.createDataFrame([], "page_id bigint, url string")
    rules = llm.createDataFrame([], "host string, path string, verdict string")
    assert url_filter.filter_urls(pages, rules).count() == 0
    one = llm.createDataFrame([(1, "http://a.b/c")], "page_id bigint, url string")
    assert [tuple(r) for r in url_filter.filter_urls(one, rules, "block").collect()] == [(1, "a.b", "/c", None, "block")]


@pytest.mark.skipif(not os.path.isdir(SF), reason="test data not present")
@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(llm, name):
    connection = duckdb.connect()
    for table in ("documents", "pages", "benchmark"):
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    found = queries.QUERIES[name](llm, SF)
    answer = connection.execute(queries.ORACLES[name])
    columns = [c[0] for c in answer.description]
    assert sorted(found.columns) == sorted(columns)
    assert sorted(str(tuple(r)) for r in found.select(*columns).collect()) == sorted(map(str, answer.fetchall()))
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoop" not in plan and "Cartesian" not in plan
