from pathlib import Path

import pytest
from pyspark.sql import functions as F

HERE = str(Path(__file__).resolve().parents[2])
SF = "/root/testdata/sf0.001"


@pytest.fixture(autouse=True)
def workers_find_the_package(spark):
    spark.sparkContext.environment["PYTHONPATH"] = HERE


@pytest.fixture
def table(spark):
    return lambda name, sf=SF: spark.read.parquet(f"{sf}/{name}.parquet")


LONG = "the quick brown fox jumps over a lazy dog while " * 3000
ODD_TEXTS = [
    (1, None), (2, ""), (3, " \t\n "), (4, "one"), (5, "one"), (6, "one"), (None, "no id here"), (7, LONG), (8, LONG),
    (9, "é漢字 😀 ünï" * 40), (9, "a second text with the same id"), (10, "x" * 30000), (11, ".,;:!?" * 50),
]


@pytest.fixture
def odd_docs(spark):
    """Nulls, empty and long texts, repeated rows and ids, and columns named like inner ones."""
    docs = spark.createDataFrame(ODD_TEXTS, "doc_id bigint, text string")
    docs = docs.union(docs.filter("doc_id = 4"))
    names = ["score", "label", "rep", "bands", "c", "n", "band", "_text_", "list", "part", "shard"]
    return docs.select("*", *[F.lit(-1).alias(x) for x in names])


@pytest.fixture
def no_docs(spark):
    return spark.createDataFrame([], "doc_id bigint, text string, lang string")
