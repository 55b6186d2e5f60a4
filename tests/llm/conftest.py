import random

import pytest
from pyspark.sql import functions as F

from tidemark.llm import common

SF = "/root/testdata/sf0.001"
# Names that the operators use inside: columns of the input must not meet them.
CLASHES = ["n", "key", "keys", "line", "size", "shard", "slot", "r1", "r2", "d1", "d2", "g", "row", "text_of", "digest", "before_size", "one", "_text", "_host", "_key", "_part", "part", "band", "value", "item", "stack", "rule", "host", "path", "verdict", "bitmap", "token", "ids", "start", "length"]


def sentence(rng, n, vocabulary=4000):
    return " ".join(f"w{rng.randrange(vocabulary)}" for _ in range(n))


@pytest.fixture(scope="session")
def llm(spark):
    return common.ready(spark)


@pytest.fixture(scope="session")
def odd_rows():
    """Nulls, empty and blank texts, ties, repeated rows, near and exact copies, a very long text, odd characters."""
    rng = random.Random(7)
    base = sentence(rng, 120)
    near = base.split()
    near[60] = "changed"
    rows = [
        (None, sentence(rng, 60)), (1, None), (2, ""), (3, " \n\t \n"), (4, base), (5, base), (5, base), (6, " ".join(near)), (6, sentence(rng, 80)),
        (7, "one two"), (8, "one two"), (9, sentence(rng, 30) + "\n" + base[:200] + "\n\n" + sentence(rng, 30)), (10, sentence(rng, 60_000)), (None, None),
        (11, "don't <|endoftext|> 日本 語 é\u0301 \u00a0 x\u3000 y  \r\n\r\nZ Ünï ΑΣ"), (-3, "\n".join([sentence(rng, 12)] * 4)), (12, "tel +1 (988) 555-2485, a.b@c.de and 10.0.0.255; 4984 2504 8966 9609"),
    ]
    return [(d, t, "en", s, 0) for (d, t), s in zip(rows, ["a", None] * len(rows), strict=False)]


def frame(spark, rows, clashing=True):
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, lang string, source string, n_chars bigint").repartition(3)
    return docs.select("*", *[F.lit("x").alias(c) for c in CLASHES]) if clashing else docs


@pytest.fixture(scope="session")
def odd_docs(llm, odd_rows):
    return frame(llm, odd_rows)


@pytest.fixture(scope="session")
def no_docs(llm):
    return frame(llm, [])


@pytest.fixture(scope="session")
def documents(llm):
    docs = llm.read.parquet(f"{SF}/documents.parquet")
    return docs, {r["doc_id"]: r["text"] for r in docs.collect()}
