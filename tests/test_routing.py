import itertools

from pyspark.sql import functions as F

from folioworks.operators import routing

SCHEMA = "doc_id string, page_no int, text string"


def df(spark, docs, schema=SCHEMA):
    return spark.createDataFrame([(d, i, t) for d, p in docs.items() for i, t in enumerate(p)], schema)


def test_strided_sample(spark):
    docs = {str(n): ["x" * 50] * n for n in (1, 11, 12, 13, 23, 24, 25, 40)}
    got = {}
    for r in routing.sample_pages(df(spark, docs)).collect():
        got.setdefault(r["doc_id"], set()).add(r["page_no"])
    for d in docs:
        n = int(d)
        assert got[d] == set(list(range(0, n, max(1, n // 12)))[:12])


def test_probe_and_route(spark):
    docs = {"a": ["x" * 41, "x" * 40, None], "b": ["x" * 41] * 2, "c": [""]}
    rows = {r["doc_id"]: r for r in routing.route(routing.probe(df(spark, docs))).collect()}
    assert (rows["a"]["text_pages"], rows["a"]["num_pages"], rows["a"]["router"]) == (1, 3, "ocr")
    assert [p["chars"] for p in rows["a"]["pages"]] == [41, 40, 0]
    assert rows["b"]["text_page_ratio"] == 1.0 and rows["b"]["router"] == "non_ocr"
    assert rows["c"]["router"] == "ocr"


def test_every_route_combination_has_one_outcome(spark):
    combos = [c for c in itertools.product(("off", "deepseek", "tesseract", "auto"), (True, False), ("ocr", "non_ocr"))]
    base = spark.createDataFrame(combos, "engine string, available boolean, router string")
    rows = routing.resolve_route(base, F.col("engine"), F.col("available")).collect()
    assert len(rows) == 16 and all(r["route_reason"] for r in rows)
    got = {(r["engine"], r["available"], r["router"]): (r["use_ocr"], r["route_reason"]) for r in rows}
    assert got["auto", False, "ocr"] == (False, "ocr_engine_missing")
    assert got["tesseract", True, "non_ocr"] == (True, "tesseract_unavailable_used_deepseek")
    assert got["off", True, "ocr"] == (False, "ocr_disabled_by_flag")


def test_fallback_takes_whole_documents(spark):
    first = df(spark, {"ok": ["a", "b"], "bad": ["a", None, "c"]}).unionByName(df(spark, {"short": ["only one"]}))
    second = df(spark, {"ok": ["A", "B"], "bad": ["A", "B", None], "short": ["A", "B"]})
    got = {}
    for r in routing.with_fallback(first, second).orderBy("page_no").collect():
        got.setdefault(r["doc_id"], []).append(r["text"])
    assert got == {"ok": ["a", "b"], "bad": ["A", "B", ""], "short": ["A", "B"]}


def test_source_choice_per_document(spark):
    native, ocr = df(spark, {"n": ["x" * 50], "s": [""], "t": [None, None]}), df(spark, {"s": ["scan"], "t": ["p", None]})
    routes = routing.resolve_route(routing.route(routing.probe(native)), "auto", True)
    rows = routing.select_source(routes, native, ocr).collect()
    assert sorted((r["doc_id"], r["page_no"], r["text"][:4], r["routed"]) for r in rows) == [
        ("n", 0, "xxxx", "non_ocr"), ("s", 0, "scan", "ocr"), ("t", 0, "p", "ocr"), ("t", 1, "", "ocr"),
    ]


def test_ocr_answer(spark):
    rows = [("", "m", "o"), (None, "", "o"), (" t\x1f", "m", ""), (None, None, None), ("　", "m", "")]
    d = spark.createDataFrame(rows, "a string, b string, c string")
    got = [r[0] for r in d.select(routing.ocr_text(F.col("a"), F.col("b"), F.col("c"))).collect()]
    assert got == ["m", "o", "t", "", ""]


def test_errors_are_set_apart(spark):
    pages = df(spark, {"a": ["x", None], "b": ["y"]})
    sound, errors = routing.split_errors(pages, F.col("text").isNull(), "page without text")
    assert [r["doc_id"] for r in sound.collect()] == ["b"]
    assert [(r["doc_id"], r["error"], r["bad_pages"]) for r in errors.collect()] == [("a", "page without text", 1)]
