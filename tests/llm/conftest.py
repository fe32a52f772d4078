"""Fixtures of the operator tests: small documents that hold the awkward cases."""

import random

import pytest
from pyspark.sql import types as T

DOCS = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType()), T.StructField("lang", T.StringType()),
                     T.StructField("source", T.StringType()), T.StructField("n_chars", T.LongType()),
                     # extra columns whose names also occur inside the operators
                     T.StructField("k1", T.StringType()), T.StructField("spans", T.StringType()), T.StructField("key", T.IntegerType()),
                     T.StructField("n", T.IntegerType()), T.StructField("score", T.StringType())])


def prose(seed: int, n: int, words=None) -> str:
    r = random.Random(seed)
    words = words or [f"w{i}" for i in range(400)]
    return " ".join(r.choice(words) for _ in range(n))


def rows(texts, start=0):
    return [(start + i, t, None, None, None, "x", "y", 1, 2, "z") for i, t in enumerate(texts)]


@pytest.fixture(scope="session")
def awkward():
    base = prose(1, 300)
    near = base.split()
    near[150] = "changed"
    passage = prose(2, 60)
    return [None, "", "   \n\t ", "one", "two words", base, base, " ".join(near), base.upper(),
            prose(3, 20_000),  # very long
            "x" * 50_000, "a " * 300, prose(4, 50) + " " + passage + " " + prose(5, 50), prose(6, 40) + "\n" + passage,
            "tabs\tand no-break 　spaces é ß 漢字 emoji 😀 \x00 nul", prose(7, 34), prose(8, 35), prose(8, 35)]


@pytest.fixture(scope="session")
def docs(spark, awkward):
    r = rows(awkward)
    r += [r[5], r[5], (None, "nameless text " + prose(9, 60), "en", None, None, None, None, None, None, None)]
    return spark.createDataFrame(r, DOCS)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], DOCS)
