import random

import pytest
from pyspark.sql import functions as F

from folioworks.functions import grid as G
from folioworks.functions import markup as M
from folioworks.operators import tables as T

# Invented tables: one with a row of heads and row names, one with plain cells only.
INVOICE = """<table><tbody><tr><th>Plant</th><th>Beds</th><th>Height</th><th>Yield</th></tr>
<tr><th>Runner bean</th><td>3</td><td>1.80m</td><td>12.50kg</td></tr>
<tr><th>Leek (late)</th><td>2</td><td>0.60m</td><td>7.25kg</td></tr>
<tr><th>Curly kale</th><td>4</td><td>0.75m</td><td>9.00kg</td></tr></tbody></table>"""
METRICS = "<table>" + "".join(
    "<tr>" + "".join(f"<td>{v}</td>" for v in row) + "</tr>"
    for row in [
        ("Harbour", "Spring", "Summer", "Autumn"), ("Ferries", "14k", "31k", "17k"), ("Trawlers", "6k", "4k", "8k"),
        ("Yachts", "2k", "9k", "3k"), ("Berths", "210", "260", "225"), ("Delays", "3%", "8%", "6%"),
    ]
) + "</table>"


def html_rows(spark, *pages):
    df = spark.createDataFrame([(f"d{i}", 0, h) for i, h in enumerate(pages)], "doc_id string, page_no int, html string")
    return T.html_grids(df)


def grids(df):
    rows = df.orderBy("doc_id", "page_no", "table_idx").collect()
    return [(r["grid"]["header"], r["grid"]["rows"]) for r in rows]


def test_recorded_scores(spark):
    scored = T.table_names(T.score_tables(T.clean_tables(html_rows(spark, INVOICE, METRICS))))
    best = {r["doc_id"]: (r["best_csv"], r["best_score"]) for r in T.best_table(scored).collect()}
    assert best == {"d0": ("table_html_01.csv", 8.0), "d1": ("table_html_01.csv", 20.0)}
    first = scored.orderBy("doc_id").first()
    assert first["original_header"] == ["Plant", "Beds", "Height", "Yield"]
    assert first["table_score"] == pytest.approx(9.6)


def test_html_spans_entities_and_heads(spark):
    page = (
        "<script>'<table><tr><td>no</td></tr></table>'</script><table><thead><tr><th>A<th colspan=2>B &amp; &lt;C&gt;</thead>"
        "<tr><td rowspan='2'>x&#8364;&#128512;<td>1<br>2<td> N/A </tr><tr><td colspan=2><i>w</i>ide</tr></table>"
        "<TABLE><TR><TD>1</TD></TR><TR><TD rowspan=2>2</TD><TD>&nbsp;</TD></TR></TABLE><table></table>"
        "<table><tr><th>a</th></tr><tr><th>b</th></tr><tr><td>1</td></tr>"
    )
    assert grids(html_rows(spark, page)) == [
        (["A", "B & <C>", "B & <C>"], [["x€😀", "1 2", None], ["x€😀", "wide", "wide"]]),
        (["0", "1"], [["1", None], ["2", None], ["2", None]]),
        ([], []),
        (["('a', 'b')"], [["1"]]),
    ]


def test_pipe_tables(spark):
    cases = {
        "": [], "plain text": [], "|a|b|": [], "|a|b|\n|---|---|": ["|a|b|\n|---|---|"],
        "|a|\n|-|\n|1|\nend": ["|a|\n|-|\n|1|"], "x\n |a|\n:-: \n\t|1|\n\n|2|": [" |a|\n:-: \n\t|1|"],
        "|a|\n|-|\n|1|\n|-|\n|2|": ["|a|\n|-|\n|1|\n|-|\n|2|"], "|a|\ntext\n|-|": [],
        "|a|\n|-|\nx\n|b|\n|:--|\n|2|": ["|a|\n|-|", "|b|\n|:--|\n|2|"], "|-|\n|-|\n|-|": ["|-|\n|-|\n|-|"],
        "|h|\r\n|-|\r\n|1|": ["|h|\n|-|\n|1|"],
    }
    rows = spark.createDataFrame([(t,) for t in cases], "t string").select("t", M.pipe_tables(F.col("t")).alias("got")).collect()
    assert {r["t"]: r["got"] for r in rows} == cases


def test_pipe_cells(spark):
    md = "| a | b \\| c |\n|---|:-:|\n| 1 | |\n|2|NA|z|"
    df = spark.createDataFrame([("d", 0, f"text\n{md}\nmore")], "doc_id string, page_no int, text string")
    found = T.md_grids(T.md_tables(df))
    assert found.first()["md"] == md
    assert grids(found) == [(["a", "b | c", ""], [["1", None, None], ["2", None, "z"]])]


def test_a_long_pipe_table_does_not_overflow(spark):
    text = "| a |\n|---|\n" + "| x |\n" * 100_000
    df = spark.createDataFrame([("d", 0, text)], "doc_id string, page_no int, text string")
    assert T.md_grids(T.md_tables(df)).select(F.size("grid.rows")).first()[0] == 100_000


def random_tables(n, seed):
    rng = random.Random(seed)
    cells = ["Name", "UPPER", "lower text", "1,5", "2.0", "7%", "1,234.5", "", " pad ", None, None, "Two Words", "x", "-3", "A\n B"]
    for _ in range(n):
        w, h = rng.randrange(1, 6), rng.randrange(1, 7)
        numeric = rng.random() < 0.5
        pool = ["1,5", "2", "3,25", None, "4%"] if numeric else cells
        yield [str(c) for c in range(w)], [
            [rng.choice(cells if r == 0 else pool) for _ in range(w)] if rng.random() > 0.15 else [None] * w for r in range(h)
        ]


BY_HAND = [
    # header, rows -> header, rows (or None where nothing is kept)
    ((["0", "1"], [["Name", "Size"], ["oak", "3,5"], ["elm", "4,25"]]), (["Name", "Size"], [["oak", "3.5"], ["elm", "4.25"]])),
    ((["0", "1"], [["name", "size"], ["oak", "3,5"], ["elm", "4,25"]]), (["0", "1"], [["name", "size"], ["oak", "3,5"], ["elm", "4,25"]])),
    ((["a", "b"], [[" x ", "y\t"], [None, None], ["z", "w"]]), (["a", "b"], [["x", "y"], ["z", "w"]])),
    ((["a", "b", "c"], [["x", None, "1"], ["y", None, "2"]]), (["a", "c"], [["x", "1"], ["y", "2"]])),
    ((["a", "b"], [["x", "1"]]), None),
    ((["a"], [["x"], ["y"], ["z"]]), None),
    ((["a", "b"], [["Head", "Two"], ["x", "1"]]), None),
    ((["a", "b"], [["Tall\n Tree", "Kind  Of"], ["x", "1"], ["y", "2"]]), (["Tall Tree", "Kind Of"], [["x", "1"], ["y", "2"]])),
    ((["a", "b"], [["Top", None], ["x", "1"], ["y", "2"]]), (["Top", ""], [["x", "1"], ["y", "2"]])),
    ((["a", "b"], [["Top", "Low"], ["1,5", "x,y"], ["2,5", "z"]]), (["Top", "Low"], [["1.5", "x,y"], ["2.5", "z"]])),
]


def test_clean_tables_by_hand(spark):
    schema = f"id int, grid {G.GRID_TYPE}"
    df = spark.createDataFrame([(i, {"header": h, "rows": r}) for i, ((h, r), _) in enumerate(BY_HAND)], schema)
    got = {r["id"]: r["g"] for r in df.select("id", G.clean(F.col("grid")).alias("g")).collect()}
    for i, (given, want) in enumerate(BY_HAND):
        g = got[i]
        assert (None if g is None else (g["header"], g["rows"])) == want, given


def test_clean_tables_and_scores(spark):
    samples = list(random_tables(700, 13))
    schema = f"id int, grid {G.GRID_TYPE}"
    df = spark.createDataFrame([(i, {"header": h, "rows": r}) for i, (h, r) in enumerate(samples)], schema)
    cleaned = df.select("id", G.clean(F.col("grid")).alias("g"))
    kept = 0
    for r in cleaned.select("id", "g", G.table_score(F.col("g")).alias("score"), G.csv_score(F.col("g")).alias("csv")).collect():
        g, (_, given) = r["g"], samples[r["id"]]
        if g is None:
            assert r["score"] == r["csv"] == 0.0
            continue
        kept += 1
        header, body = g["header"], g["rows"]
        assert len(header) >= 2 and len(body) >= 2 and all(len(x) == len(header) for x in body)
        assert all(any(v is not None for v in x) for x in body) and all(any(x[c] is not None for x in body) for c in range(len(header)))
        cells = {(v or "").strip().replace(",", ".") for x in given for v in x}
        assert {(v or "").replace(",", ".") for x in body for v in x} <= cells | {""}
        size = len(body) * len(header)
        empty = sum(v is None for x in body for v in x) / size
        na = sum(v is None or v == "" for x in body for v in x) / size
        assert r["csv"] == pytest.approx(size / (1 + 10 * na))
        assert r["score"] == pytest.approx(size / (1 + 10 * empty) * (1.2 if all(header) else 1.0))
    assert kept > 100


def test_csv_quoting(spark):
    df = spark.createDataFrame([({"header": ["a,b", 'q"'], "rows": [["x\ny", None], ["<&>", "p|q"]]},)], f"grid {G.GRID_TYPE}")
    r = df.select(G.render_csv(F.col("grid")).alias("c"), G.render_html(F.col("grid")).alias("h"), G.render_md(F.col("grid")).alias("m")).first()
    assert r["c"] == '"a,b","q"""\n"x\ny",\n<&>,p|q\n'
    assert "<td>&lt;&amp;&gt;</td>" in r["h"] and r["m"].endswith("| <&> | p\\|q |")


def test_cascade_and_meta(spark):
    g = {"header": ["A", "B"], "rows": [["1", "2"], ["3", None]]}
    rows = [
        ("a", "markdown", 0, 1), ("a", "camelot", 0, 1), ("b", "markdown", 1, 1), ("b", "camelot", 1, 1), ("b", "camelot", 0, 2),
        ("c", "docling", 2, 3), ("c", "docling", 0, 1), ("c", "camelot", 0, 1),
    ]
    cand = spark.createDataFrame([(*r, g) for r in rows], f"doc_id string, engine string, page_no int, table_idx int, grid {G.GRID_TYPE}")
    routes = spark.createDataFrame([("a", "ocr", 3), ("b", "non_ocr", 3), ("c", "ocr", 3), ("d", "ocr", 1)], "doc_id string, routed string, num_pages int")

    def engines(**kw):
        _, chosen = T.choose_engine(cand, routes, **kw)
        return {r["doc_id"]: (r["engine"], r["count"]) for r in chosen.collect()}

    assert engines() == {"a": ("markdown", 1), "b": ("camelot", 2), "c": ("docling", 2), "d": ("docling", 0)}
    assert engines(prompt="plain")["a"] == ("camelot", 1)
    assert engines(mode="camelot")["c"] == ("camelot", 1)
    assert engines(mode="docling")["a"] == ("docling", 0)
    assert engines(mode="off")["c"] == (None, 0)
    served, chosen = T.choose_engine(cand, routes)
    named = T.table_names(T.score_tables(served))
    meta = {r["doc_id"]: r["tables"] for r in T.table_meta(named, chosen, T.best_table(named)).collect()}
    assert [i["path_csv"] for i in meta["c"]["items"]] == ["table_01.csv", "table_03.csv"]
    assert meta["c"]["best_csv"] == "table_01.csv" and meta["c"]["best_score"] == 1.143
    assert meta["a"]["items"][0]["path_md"] == "page_0001_table_01.md" and meta["a"]["items"][0]["page"] == 1
    assert meta["d"]["count"] == 0 and meta["d"]["items"] == [] and meta["d"]["best_csv"] is None


def test_references_and_spans_of_html_cells(spark):
    page = (
        "<table><tr><th>Name</th><th>Sign</th></tr><tr><td>caf&eacute; &uuml;ber</td><td>&#x27;&#X1F600;&#00233;</td></tr>"
        "<tr><td>&amp;lt; &unknown; &NotEqualTilde;</td><td>&frac12;&nbsp;&#1114112;</td></tr></table>"
    )
    ((header, rows),) = grids(html_rows(spark, page))
    assert header == ["Name", "Sign"]
    assert rows == [["café über", "'😀é"], ["&lt; &unknown; ≂̸", "½\xa0&#1114112;"]]
    wide = "<table><tr><td colspan=12345>x</td></tr></table>"
    ((_, rows),) = grids(html_rows(spark, wide))
    assert len(rows[0]) == 1000


def test_tables_without_page_errors_and_camelot_items(spark):
    g = {"header": ["A", "B"], "rows": [["1", "2"], ["3", "4"]]}
    rows = [("a", "docling", None, 1), ("a", "docling", 2, 2), ("b", "camelot", 0, 1)]
    cand = spark.createDataFrame([(*r, g) for r in rows], f"doc_id string, engine string, page_no int, table_idx int, grid {G.GRID_TYPE}")
    routes = spark.createDataFrame([("a", "ocr", 300), ("b", "ocr", 1), ("c", "ocr", 1)], "doc_id string, routed string, num_pages int")
    served, chosen = T.choose_engine(cand, routes)
    named = T.table_names(T.score_tables(served))
    errors = spark.createDataFrame([("c", "docling", "ValueError: no layout"), ("b", "docling", "unused")], "doc_id string, engine string, error string")
    meta = T.table_meta(named, chosen, T.best_table(named), errors=errors).filter("part_no = 0")
    got = {r["doc_id"]: r["tables"] for r in meta.collect()}
    assert [(i["page"], i["path_csv"]) for i in got["a"]["items"]] == [(None, "table_01.csv"), (2, "table_02.csv")] and got["a"]["count"] == 2
    assert [(i["page"], i["path_html"], i["path_csv"]) for i in got["b"]["items"]] == [(1, None, "camelot_lattice_01.csv")]
    assert (got["c"]["error"], got["c"]["count"]) == ("ValueError: no layout", 0) and got["b"]["error"] is None


def test_nested_tables_are_each_whole(spark):
    page = (
        "<table><tr><td>a</td><td>b<table><tr><td>c</td></tr><tr><td>x<TABLE id=3><tr><td>deep</td></tr></TABLE  >y</td></tr></table> z</td></tr>"
        "<tr><td>d</td></tr><tr><td>e</td><td>f</td></tr></table></table><p>t</p>"
        "<table><tr><td>g<br>h<table><tr><td>i</td></tr>"
    )
    got = [rows for _, rows in grids(html_rows(spark, page))]
    assert got == [
        [["a", "bcxdeepy z"], ["d", None], ["e", "f"]], [["c"], ["xdeepy"]], [["deep"]], [["g hi"]], [["i"]],
    ]


def test_cascade_parses_only_what_is_still_unserved(spark):
    from folioworks.config import EngineConfig
    from folioworks.plans import ingest as plan

    g = {"header": ["0", "1"], "rows": [["Name", "B"], ["1", "2"], ["3", "4"]]}
    rows = [("layout", "docling", None, 0, 1), ("layout", "docling", "html", 0, 1), ("html", "docling", "html", 0, 1), ("scan", "camelot", "lattice", 0, 1), ("grid", "camelot", "lattice", 0, 1)]
    cand = spark.createDataFrame([(*r, g) for r in rows], f"doc_id string, engine string, flavor string, page_no int, table_idx int, grid {G.GRID_TYPE}")
    docs = {"layout": "ocr", "html": "ocr", "scan": "ocr", "grid": "non_ocr", "none": "ocr"}
    routes = spark.createDataFrame([(d, r, 2) for d, r in docs.items()], "doc_id string, routed string, n_pages int")
    md = "| A | B |\n|---|---|\n| 1 | 2 |"
    ocr = spark.createDataFrame([(d, i, 2, md if d != "none" else "no table") for d in docs for i in range(2)], "doc_id string, page_no int, n_pages int, text string")
    asked, parse, clean, cleaned = [], T.md_tables, T.clean_tables, []
    T.md_tables = lambda pages: (asked.extend((r.doc_id, r.page_no) for r in pages.collect()), parse(pages))[1]
    T.clean_tables = lambda t: (cleaned.append(sorted((r.doc_id, r.flavor) for r in t.collect())), clean(t))[1]
    try:
        served, chosen = plan.collect_tables(cand, ocr, routes, EngineConfig(block_pages=1))
    finally:
        T.md_tables, T.clean_tables = parse, clean
    assert sorted(asked) == [("none", 0), ("none", 1), ("scan", 0), ("scan", 1)]
    assert cleaned == [[("layout", None)], [("html", "html")], [("grid", "lattice")]]
    got = {r.doc_id: (r.engine, r["count"]) for r in chosen.collect()}
    assert got == {"layout": ("docling", 1), "html": ("docling", 1), "scan": ("markdown", 2), "grid": ("camelot", 1), "none": ("docling", 0)}
    assert sorted((r.doc_id, r.engine, r.page_no, r.block) for r in served.collect()) == [
        ("grid", "camelot", 0, 0), ("html", "docling", 0, 0), ("layout", "docling", 0, 0), ("scan", "markdown", 0, 0), ("scan", "markdown", 1, 1),
    ]
