import random

import pytest
from pyspark.sql import functions as F

from folioworks.config import EngineConfig
from folioworks.functions.text import token_count
from folioworks.operators import assembly, cleaning
from folioworks.operators.blocks import gather, only_long, prepare

LINES = [
    "ACME Corp", "  ACME   Corp ", "ACME  Corp", "", "   ", "short", "body line one", "body\tline  one", "footer text",
    "Confidential", "• item", "continued text here", "and so on-", "page 3", "17", "Another Body line.",
]


def random_docs(n, seed, most=7):
    rng = random.Random(seed)
    docs = {}
    for d in range(n):
        pages = []
        for _ in range(rng.randrange(1, most)):
            own = [rng.choice(LINES) for _ in range(rng.randrange(0, 8))]
            if rng.random() < 0.6:
                own = ["ACME Corp", *own, "footer text"]
            pages.append("\n".join(own))
        docs[f"d{d}"] = pages
    return docs


def page_df(spark, docs, counted=True):
    rows = [(d, i, len(p), t) for d, p in docs.items() for i, t in enumerate(p)]
    random.Random(0).shuffle(rows)
    df = spark.createDataFrame(rows, "doc_id string, page_no int, n_pages int, text string")
    return df if counted else df.drop("n_pages")


def by_doc(df, *columns):
    out = {}
    for r in df.orderBy("doc_id", "page_no").collect():
        out.setdefault(r["doc_id"], []).append(tuple(r[c] for c in columns))
    return out


def one(rows):
    return {d: [v[0] for v in p] for d, p in rows.items()}


HEADED = ["ACME Corp\nfirst body\n\nfooter text", "  ACME Corp \nsecond body\nfooter text", "ACME Corp\nthird body\nfooter text"]
FORMS = {
    # document: (pages, without edges, without boilerplate, cleaned)
    "headed": (HEADED, ["first body", "second body", "third body"], ["first body", "second body", "third body"], None),
    "two pages stay": (HEADED[:2], HEADED[:2], HEADED[:2], None),
    "middle repeats": (
        ["a long line here\nshared   middle\nb%d\nc%d\nother end %d" % (i, i, i) for i in range(4)],
        ["shared   middle\nb%d\nc%d\nother end %d" % (i, i, i) for i in range(4)],
        ["other end %d" % i for i in range(4)],
        ["other end %d" % i for i in range(4)],
    ),
    "rare header stays": (["Top\nalpha beta 1"] + ["gamma delta %d" % i for i in range(3)],) + (None,) * 3,
}


@pytest.mark.parametrize("block_pages", [256, 2, 1])
def test_strip_headers_footers(spark, block_pages):
    docs = {d: v[0] for d, v in FORMS.items()}
    got = one(by_doc(cleaning.strip_headers_footers(page_df(spark, docs), block_pages=block_pages), "text"))
    for d, (pages, bare, _, _) in FORMS.items():
        if d != "middle repeats":
            assert got[d] == (bare or pages), d
    assert all("long line" not in t for t in got["middle repeats"])


@pytest.mark.parametrize("block_pages", [256, 2])
def test_drop_boilerplate(spark, block_pages):
    docs = {
        "short go": ["tiny\na longer line %d" % i for i in range(3)],
        "common go": ["one   common line\nline of its own %d" % i for i in range(4)],
        "half stay away": ["seen on half\nown line %d" % i if i < 2 else "own line %d" % i for i in range(4)],
        "one page": ["tiny\ntiny"],
    }
    got = one(by_doc(cleaning.drop_boilerplate(page_df(spark, docs), block_pages=block_pages), "text"))
    assert got == {
        "short go": ["a longer line %d" % i for i in range(3)],
        "common go": ["line of its own %d" % i for i in range(4)],
        "half stay away": ["own line %d" % i for i in range(4)],
        "one page": ["tiny\ntiny"],
    }


@pytest.mark.parametrize("rule", [cleaning.strip_headers_footers, cleaning.drop_boilerplate])
def test_rules_do_not_depend_on_blocks(spark, rule):
    pages = page_df(spark, random_docs(120, 3))
    once = one(by_doc(rule(pages, block_pages=256), "text"))
    for block_pages in (1, 2, 5):
        assert one(by_doc(rule(pages, block_pages=block_pages), "text")) == once
    assert {d: len(p) for d, p in once.items()} == {d: len(p) for d, p in random_docs(120, 3).items()}


def test_chain_by_hand(spark):
    docs = {
        "broken": ["• item one\n[x] checked line", "a line that goes\non here-\nafterwards", "Page 2 of 3\n17\nSome words here"],
        "lone": ["word-\nbreak and\nmore\n12"],
    }
    got = by_doc(cleaning.clean_pages(page_df(spark, docs)), "slice", "text")
    assert [t for _, t in got["lone"]] == ["wordbreak and more\n"]
    assert got["lone"][0][0] == "wordbreak and more\n12"
    assert [t for _, t in got["broken"]] == ["- item one\n- [x] checked line", "a line that goes on hereafterwards", "\nSome words here"]


@pytest.mark.parametrize("counted", [True, False])
def test_chain_does_not_depend_on_blocks(spark, counted):
    docs = random_docs(120, 5, most=9)
    once = by_doc(cleaning.clean_pages(page_df(spark, docs), EngineConfig()), "slice", "text")
    for block_pages in (3, 1):
        cfg = EngineConfig(block_pages=block_pages)
        assert by_doc(cleaning.clean_pages(page_df(spark, docs, counted), cfg), "slice", "text") == once


@pytest.mark.parametrize("share", [0.45, 0.4, 0.5, 1 / 3, 0.07, 1.0])
def test_thresholds_are_those_of_the_division(spark, share):
    from folioworks.functions.repeats import enough

    rows = spark.range(1, 400).select("id", enough(F.col("id").cast("int"), share).alias("m")).collect()
    for r in rows:
        assert r["m"] / r["id"] >= share
        assert r["m"] == 1 or (r["m"] - 1) / r["id"] < share


@pytest.mark.parametrize("partitions", [1, 7, 64])
def test_order_of_rows_does_not_matter(spark, partitions):
    docs = random_docs(40, 9)
    df = page_df(spark, docs).repartition(partitions, F.xxhash64("text", "page_no"))
    got = by_doc(cleaning.clean_pages(df), "text")
    assert got == by_doc(cleaning.clean_pages(page_df(spark, docs).coalesce(1)), "text")


@pytest.mark.parametrize("span", [4096, 3])
def test_one_document_holds_most_pages(spark, span, monkeypatch):
    for fn in (assembly._with_earlier_parts, assembly._long_document_totals):
        monkeypatch.setattr(fn, "__defaults__", (span,))
    docs = random_docs(30, 11)
    rng = random.Random(2)
    docs["hot"] = ["\n".join(["ACME Corp", f"body number {rng.randrange(40)}", "tail-", "end", "footer text"]) for _ in range(700)]
    cfg = EngineConfig(block_pages=16)
    pages = page_df(spark, docs)
    parts = cleaning.clean_parts(gather(pages, 16), only_long(pages, 16), cfg)
    sizes = parts.select(F.max(F.size("pages"))).first()[0]
    assert sizes <= 16
    whole = assembly.concat_parts(parts, "", 16).orderBy("doc_id", "part_no").collect()
    texts, offsets, tokens = {}, {}, {}
    for r in whole:
        texts[r["doc_id"]] = texts.get(r["doc_id"], "") + r["text"]
        offsets.setdefault(r["doc_id"], []).extend(r["page_offsets"])
        tokens.setdefault(r["doc_id"], set()).add(r["token_count"])
    unsplit = one(by_doc(cleaning.clean_pages(page_df(spark, docs), EngineConfig(block_pages=1024)), "text"))
    counted = spark.createDataFrame(list(texts.items()), "doc_id string, text string").select("doc_id", token_count(F.col("text")).alias("n"))
    counts = {r["doc_id"]: r["n"] for r in counted.collect()}
    for d, clean in unsplit.items():
        assert texts[d] == "".join(clean)
        assert offsets[d] == [sum(map(len, clean[:i])) for i in range(len(clean))]
        assert tokens[d] == {counts[d]}


@pytest.mark.parametrize("sep", ["", "\n\n"])
@pytest.mark.parametrize("block_pages", [256, 2])
def test_offsets(spark, block_pages, sep):
    docs = random_docs(60, 13)
    got = one(by_doc(assembly.page_offsets(page_df(spark, docs), sep, block_pages), "page_offset"))
    want = {d: [sum(len(p) + len(sep) for p in pages[:i]) for i in range(len(pages))] for d, pages in docs.items()}
    assert got == want
    parts = cleaning.clean_parts(
        gather(page_df(spark, docs), block_pages), only_long(page_df(spark, docs), block_pages), EngineConfig(block_pages=block_pages)
    )
    texts = {}
    for r in assembly.concat_parts(parts, sep, block_pages).orderBy("doc_id", "part_no").collect():
        texts[r["doc_id"]] = texts.get(r["doc_id"], "") + r["text"]
    clean = one(by_doc(cleaning.clean_pages(page_df(spark, docs)), "text"))
    assert texts == {d: sep.join(p) for d, p in clean.items()}


def test_sparse_page_numbers_stay_in_range(spark):
    rows = [("a", 10 * i, 5, "ACME Corp\nline number %d\nfooter text" % i) for i in range(5)]
    df = spark.createDataFrame(rows, "doc_id string, page_no int, n_pages int, text string")
    assert prepare(df, 2).select(F.max("block")).first()[0] == 2
    got = one(by_doc(cleaning.clean_pages(df, EngineConfig(block_pages=2)), "text"))
    assert got["a"] == ["line number %d" % i for i in range(5)]


def test_report_counts(spark):
    docs = {"a": ["Top\nx\ny\nEnd"] * 4, "b": ["only\npage"]}
    edges = {r["line"]: (r["top_count"], r["bottom_count"]) for r in cleaning.repeated_edges(page_df(spark, docs)).collect()}
    assert edges == {"Top": (4, 0), "x": (4, 0), "y": (0, 4), "End": (0, 4)}
    boiler = cleaning.boilerplate_lines(page_df(spark, {"a": ["one line\none  line"] * 3})).collect()
    assert [(r["line"], r["page_count"], r["first_page"]) for r in boiler] == [("one line", 3, 0)]
