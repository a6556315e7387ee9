"""Plans: what shuffles, what stays in the JVM, what reaches the scan."""

import re

import pytest

import __spark_entry__ as entry
from folioworks.functions import grid as G
from folioworks.operators.cleaning import clean_pages
from folioworks.plans.catalog import QUERIES

SF = "/root/testdata/sf0.001"
PYTHON_NODES = ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "FlatMapGroupsInPandas", "PythonUDF")


def plan(df, final=False):
    if final:
        df.collect()
    text = df._jdf.queryExecution().executedPlan().toString()
    return text.split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def stored_pages(spark, tmp_path_factory):
    path = f"{tmp_path_factory.mktemp('pages')}/pages"
    QUERIES["page_table"](spark, SF).repartition(6).write.parquet(path)
    return path


def test_chain_moves_page_texts_once(spark, stored_pages):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        final = plan(clean_pages(spark.read.parquet(stored_pages)), final=True)
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    # no long document: their branches fall away at run time
    assert len(re.findall(r"Exchange hashpartitioning\(doc_id", final)) == 1
    assert "CartesianProduct" not in final and "NestedLoop" not in final


def test_long_documents_are_picked_in_the_scan(spark, stored_pages):
    text = plan(clean_pages(spark.read.parquet(stored_pages)))
    assert "PushedFilters: [GreaterThan(n_pages,256)" in text.replace("IsNotNull(n_pages), ", "").replace("IsNotNull(doc_id), ", "")


def test_probe_shuffles_no_text(spark, stored_pages):
    from folioworks.operators.routing import probe

    text = plan(probe(spark.read.parquet(stored_pages)))
    for exchange in re.findall(r"Exchange hashpartitioning.*\n.*", text):
        assert "text#" not in exchange
    assert text.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("rule", ["clean_tables", "md_cells", "html_tables"])
def test_table_rules_need_no_shuffle_of_their_own(spark, rule):
    from folioworks.operators import tables as T

    grids = "doc_id string, engine string, page_no int, table_idx int, grid " + G.GRID_TYPE
    pages = spark.createDataFrame([("d", 0, "| a |\n|---|\n| b |", "<table><tr><td>x</td></tr></table>")], "doc_id string, page_no int, text string, html string")
    made = {
        "clean_tables": lambda: T.score_tables(T.clean_tables(spark.createDataFrame([("d", "camelot", 0, 1, {"header": ["a"], "rows": [["b"]]})], grids))),
        "md_cells": lambda: T.to_cells(T.md_grids(T.md_tables(pages))),
        "html_tables": lambda: T.html_grids(pages),
    }[rule]()
    assert "Exchange" not in plan(made)


@pytest.mark.parametrize("name", [n for n in QUERIES if not n.startswith(("stream", "ingest", "language", "file_", "table_files"))])
def test_core_queries_stay_in_the_jvm(spark, name):
    text = plan(QUERIES[name](spark, SF))
    assert not [n for n in PYTHON_NODES if n in text]
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


def test_exact_dedup_sorts_no_texts(spark):
    text = plan(QUERIES["exact_dedup"](spark, SF))
    assert "SortAggregate" not in text and "HashAggregate" in text


def test_every_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(QUERIES) <= set(entry.oracle_sql())


def test_no_text_of_the_other_source_is_gathered(spark):
    """What is gathered are the pages of each document's own source, none of the other."""
    from folioworks.config import EngineConfig
    from folioworks.operators.routing import select_source
    from folioworks.plans.ingest import ingest, routes_of

    long = "x" * 100
    native = spark.createDataFrame([(f"n{i}", 0, 1, long) for i in range(50)] + [("scan", 0, 1, "")], "doc_id string, page_no int, n_pages int, text string")
    ocr = spark.createDataFrame([(f"n{i}", 0, 1, "other") for i in range(50)] + [("scan", 0, 1, "seen")], native.schema)
    chosen = select_source(routes_of(native, ocr_pages=ocr), native, ocr).collect()
    assert len(chosen) == 51 and {r["text"] for r in chosen} == {long, "seen"}
    df = ingest(native, EngineConfig(language="off", tables="off"), ocr)
    assert df.filter("doc_id = 'scan'").first()["text"] == "seen" and df.count() == 51
