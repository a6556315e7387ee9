import json

import pytest
from pyspark.sql import functions as F

from folioworks.config import EngineConfig
from folioworks.operators import assembly, identity, paging
from folioworks.operators import tables as T
from folioworks.operators.language import fit_language_profiles, tag_language, with_seams
from folioworks.plans.ingest import ingest, ingest_run
from folioworks.sources import files, sinks

from test_tables import INVOICE, METRICS

INVOICE_TEXT = """INVOICE #777
Date: 2031-01-02
Vendor: Invented Goods Co.
Item
Qty
Widget A
2
$10.00
Service Fee
1
$50.00
Grand Total: $70.00"""
SCAN_TEXT = "SCANNED PAGE (COPY)\n\nThis is a simulated page.\nIts text is pixels only."


@pytest.fixture(scope="module")
def samples(spark):
    schema = "doc_id string, page_no int, text string"
    native = spark.createDataFrame([("invoice", 0, INVOICE_TEXT), ("grid", 0, "Metrics of the year, and all of them\nQ1\n1000\n1200\nend"), ("scan", 0, "")], schema)
    ocr = spark.createDataFrame([("scan", 0, SCAN_TEXT), ("grid", 0, "| not | used |\n|---|---|\n| a | b |")], schema)
    html = spark.createDataFrame([("invoice", 0, INVOICE), ("grid", 0, METRICS)], "doc_id string, page_no int, html string")
    return native, ocr, T.html_grids(html)


def test_samples_end_to_end(spark, samples):
    native, ocr, tables = samples
    rows = {r["doc_id"]: r for r in ingest(native, EngineConfig(language="off"), ocr, tables).collect()}
    invoice, grid, scan = rows["invoice"], rows["grid"], rows["scan"]
    # short documents keep their lines, but bare numbers go as page labels
    assert invoice["text"] == INVOICE_TEXT.replace("\n2\n", "\n\n").replace("\n1\n", "\n\n")
    assert invoice["page_slices"] == [INVOICE_TEXT]
    assert invoice["routed"] == "non_ocr" and invoice["language"] == "unknown" and invoice["page_offsets"] == [0]
    assert invoice["meta"]["tables"]["engine"] == "docling" and invoice["meta"]["tables"]["best_score"] == 8.0
    assert grid["meta"]["tables"]["best_score"] == 20.0
    assert grid["meta"]["tables"]["items"][0]["path_csv"] == "table_html_01.csv"
    assert scan["routed"] == "ocr" and scan["text"] == SCAN_TEXT and scan["meta"]["probe"]["text_page_ratio"] == 0.0
    assert scan["meta"]["tables"]["count"] == 0 and scan["meta"]["tables"]["engine"] == "docling"
    assert scan["meta"]["route_reason"] == "router_ocr"


def test_parts_of_long_documents_add_up(spark):
    from test_cleaning import page_df, random_docs

    docs = random_docs(40, 31, most=11)
    native = page_df(spark, docs)
    md = "| Head | Two |\n|---|---|\n| a | b |\n| c | d |\n"
    ocr = page_df(spark, {d: [f"{md}{t}" if i % 2 else t for i, t in enumerate(p)] for d, p in docs.items()})

    def run(block_pages):
        cfg = EngineConfig(language="off", block_pages=block_pages)
        whole = {}
        for r in ingest(native, cfg, ocr).orderBy("doc_id", "part_no").collect():
            w = whole.setdefault(r["doc_id"], {"text": "", "slices": [], "offsets": [], "items": [], "facts": set()})
            w["text"] += r["text"]
            w["slices"] += r["page_slices"]
            w["offsets"] += r["page_offsets"]
            w["items"] += [i["path_md"] for i in r["meta"]["tables"]["items"]]
            t = r["meta"]["tables"]
            w["facts"].add((r["routed"], r["meta"]["token_count"], t["engine"], t["count"], t["best_csv"], t["best_score"], r["meta"]["probe"]["num_pages"]))
        return whole

    once, split = run(256), run(2)
    assert split == once
    assert any(w["items"] for w in once.values()) and all(len(w["facts"]) == 1 for w in split.values())


def test_no_document_or_page_is_lost(spark):
    """OCR-only and native-only documents, and more OCR pages than native ones, at every block size."""
    line = "a native line that is long enough to count as text {}"
    schema = "doc_id string, page_no int, n_pages int, text string"
    native = [("both", 0, 1, ""), ("native", 0, 2, ""), ("native", 1, 2, "short"), ("text", 0, 1, line.format(0))]
    ocr = [("both", i, 300, f"scanned {i}.") for i in range(300)] + [("ocr", i, 3, f"seen {i}.") for i in range(3)] + [("text", 0, 1, "unused")]
    want = {
        "both": ("ocr", 300, "".join(f"scanned {i}." for i in range(300))), "ocr": ("ocr", 3, "seen 0.seen 1.seen 2."),
        "native": ("non_ocr", 2, "short"), "text": ("non_ocr", 1, line.format(0)),
    }
    for block_pages in (256, 7, 1):
        cfg = EngineConfig(language="off", tables="off", block_pages=block_pages, min_pages=1000, bare_numbers=False)
        rows = ingest(spark.createDataFrame(native, schema), cfg, spark.createDataFrame(ocr, schema)).collect()
        got = {}
        for r in sorted(rows, key=lambda r: (r["doc_id"], r["part_no"])):
            routed, pages, text = got.get(r["doc_id"], ("", 0, ""))
            got[r["doc_id"]] = (r["routed"], pages + len(r["page_slices"]), text + r["text"])
            assert r["n_parts"] == -(-want[r["doc_id"]][1] // block_pages)
        assert {d: (a, n) for d, (a, n, _) in got.items()} == {d: (a, n) for d, (a, n, _) in want.items()}
        assert {d: t for d, (_, _, t) in got.items() if d != "both"} == {d: t for d, (_, _, t) in want.items() if d != "both"}
        ratio = {r["doc_id"]: r["meta"]["probe"]["text_page_ratio"] for r in rows}
        assert ratio["ocr"] == 0.0 and ratio["text"] == 1.0
    off = ingest(spark.createDataFrame(native, schema), EngineConfig(language="off", ocr_engine="off", tables="off"), spark.createDataFrame(ocr, schema))
    assert {r["doc_id"]: (r["text"], r["routed"]) for r in off.collect()}["ocr"] == ("", "non_ocr")


def test_fingerprint_is_the_same_for_every_block_size(spark):
    from test_cleaning import page_df, random_docs

    pages = page_df(spark, random_docs(30, 41, most=9))
    run = lambda b: {r["doc_id"]: r["text_fingerprint"] for r in assembly.summary(ingest(pages, EngineConfig(language="off", block_pages=b)), fingerprint=True).collect()}
    once = run(256)
    assert len(set(once.values())) > 20 and run(2) == once and run(1) == once


def test_engine_flags(spark, samples):
    native, ocr, tables = samples
    rows = {r["doc_id"]: r for r in ingest(native, EngineConfig(language="off", ocr_engine="off", tables="off"), ocr, tables).collect()}
    assert rows["scan"]["text"] == "" and rows["scan"]["meta"]["route_reason"] == "ocr_disabled_by_flag"
    assert rows["invoice"]["meta"]["tables"]["engine"] is None
    forced = {r["doc_id"]: r for r in ingest(native, EngineConfig(language="off", ocr_engine="deepseek"), ocr).collect()}
    assert forced["grid"]["meta"]["tables"]["engine"] == "markdown" and forced["grid"]["meta"]["tables"]["count"] == 1
    with pytest.raises(ValueError):
        EngineConfig(tables="every")


def test_sinks(spark, samples, tmp_path):
    native, ocr, tables = samples
    out = ingest(native, EngineConfig(language="off"), ocr, tables)
    sinks.write_documents(out, f"{tmp_path}/docs")
    bundles = spark.read.parquet(f"{tmp_path}/docs")
    assert bundles.count() == 3
    assert [(f.name, f.dataType.typeName()) for f in bundles.schema] == [(f.name, f.dataType.typeName()) for f in out.schema]
    sinks.write_text(bundles, f"{tmp_path}/text")
    assert (tmp_path / "text/scan/text.txt").read_text() == SCAN_TEXT
    sinks.write_docmeta(bundles, f"{tmp_path}/meta")
    metas = {m["doc_id"]: m for m in (json.loads(r["value"]) for r in spark.read.text(f"{tmp_path}/meta").collect())}
    assert metas["invoice"]["meta"]["tables"]["items"][0]["path_md"] is None and metas["scan"]["page_offsets"] == [0]
    sinks.write_records(bundles, f"{tmp_path}/records")
    assert spark.read.json(f"{tmp_path}/records").filter("doc_id = 'scan'").first()["text"] == SCAN_TEXT
    summary = {r["doc_id"]: r for r in assembly.summary(bundles, "out/").collect()}
    assert summary["scan"]["out"] == "out/scan" and summary["scan"]["token_count"] == bundles.filter("doc_id = 'scan'").first()["meta"]["token_count"]


def test_bucketed_page_table_is_cleaned_without_shuffling_pages(spark, samples):
    native, _, _ = samples
    sinks.save_page_table(native, "page_store", 4)
    from folioworks.operators.blocks import gather

    stored = gather(spark.table("page_store"))
    plan = stored._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    assert {r["doc_id"]: r["pages"][0]["text"] for r in stored.collect()} == {r["doc_id"]: r["text"] for r in native.collect()}


def test_identity_and_paging(spark):
    docs = spark.createDataFrame([(3, "b", "one"), (1, "c", "one"), (2, "a", "two")], "n int, source string, text string")
    kept = identity.dedup_exact(identity.with_doc_id(docs, "text"), "n").collect()
    assert sorted((r["n"], r["source"], r["text"]) for r in kept) == [(1, "c", "one"), (2, "a", "two")]
    pages = paging.paginate(spark.createDataFrame([("d", "a\nb\nc\nd\n"), ("e", None)], "doc_id string, text string"), 2)
    assert sorted((r["doc_id"], r["page_no"], r["n_pages"], r["text"]) for r in pages.collect()) == [
        ("d", 0, 3, "a\nb"), ("d", 1, 3, "c\nd"), ("d", 2, 3, ""), ("e", 0, 1, ""),
    ]
    capped = paging.limit_pages(pages, 2)
    assert capped.count() == 3 and capped.agg(F.max("n_pages")).first()[0] == 2
    assert paging.limit_pages(pages, None) is pages


def test_files_and_extractor(spark, tmp_path):
    (tmp_path / "sub").mkdir()
    (tmp_path / "a.PDF").write_bytes(b"one|two")
    (tmp_path / "sub" / "b.pdf").write_bytes(b"bad")
    (tmp_path / "sub" / "d.pdf").write_bytes(b"none")
    (tmp_path / "c.txt").write_bytes(b"no")
    found = files.with_file_id(files.read_files(spark, str(tmp_path)))
    assert found.count() == 3

    def make():
        def extract(content):
            if content == b"bad":
                raise ValueError("broken file")
            if content == b"none":
                return []
            return content.decode().split("|")

        return extract

    pages, errors = files.split_extracted(files.extract_with(found, make))
    assert sorted((r["page_no"], r["n_pages"], r["text"]) for r in pages.collect()) == [(0, 0, ""), (0, 2, "one"), (1, 2, "two")]
    bundles = ingest(pages, EngineConfig(language="off")).collect()
    assert sorted((r["text"], r["meta"]["probe"]["num_pages"]) for r in bundles) == [("", 0), ("onetwo", 2)]
    assert [r["error"] for r in errors.collect()] == ["ValueError: broken file"]
    with pytest.raises(FileNotFoundError):
        files.read_files(spark, str(tmp_path / "sub"), ".docx")
    assert files.markdown_pages(pages, "plain").count() == 0


def test_rows_without_a_label_teach_nothing(spark):
    train = spark.createDataFrame([("a", "en", "the cat and the dog"), ("b", None, "zz yy xx"), ("c", None, "zz yy xx ww")], "doc_id string, lang string, text string")
    profiles = fit_language_profiles(train)
    assert profiles.languages == ["en"]
    assert tag_language(spark.createDataFrame([("x", "zz yy xx")], "doc_id string, text string"), profiles).first()["language"] == "en"
    with pytest.raises(ValueError):
        fit_language_profiles(train.union(spark.createDataFrame([("d", "de", "und")], train.schema)), max_languages=1)


def test_language(spark):
    text = {"en": "the cat and the dog ", "de": "der hund und die katze ", "fr": "le chat et le chien "}
    rows = [(f"{l}{i}", l, t * (i + 1)) for l, t in text.items() for i in range(3)]
    train = spark.createDataFrame(rows, "doc_id string, lang string, text string")
    profiles = fit_language_profiles(train)
    new = spark.createDataFrame([("x", "the dog"), ("y", "die katze"), ("y", "und"), ("z", "et le chat"), ("e", ""), ("n", None)], "doc_id string, text string")
    small = {r["doc_id"]: r["language"] for r in tag_language(new, profiles).collect()}
    assert small == {"x": "en", "y": "de", "z": "fr", "e": "de", "n": "de"}
    # the way beyond the broadcast limit gives the same
    assert {r["doc_id"]: r["language"] for r in tag_language(new, profiles, max_broadcast_bytes=0).collect()} == small
    with pytest.raises(ValueError):
        ingest(new.withColumn("page_no", F.lit(0)))
    tagged = ingest(new.withColumn("page_no", F.lit(0)).filter("text is not null and doc_id <> 'y'"), profiles=profiles)
    assert {r["doc_id"]: r["language"] for r in tagged.collect()}["z"] == "fr"


def test_texts_are_tagged_without_a_row_for_each_gram(spark, monkeypatch, capsys):
    import random

    import pyarrow as pa

    from folioworks.operators import language

    monkeypatch.setattr(language, "PIECE_CHARS", 50)
    rng = random.Random(3)
    signs = "abcÀÉßİ \U0001f600\U0001f601\0\n日本"
    texts = ["".join(rng.choice(signs) for _ in range(n)) for n in [0, 1, 2, 3, 4, *[rng.randrange(300) for _ in range(60)]]] + [None]
    found = [(first + r, g) for first, grams, row in language._packed_grams(pa.array(texts, pa.string()), 3) for g, r in zip(language._unpacked(grams, 3).to_pylist(), row.tolist())]
    assert sorted(found) == sorted((i, t[a : a + 3]) for i, t in enumerate(texts) for a in range(len(t or "") - 2))
    rows = [(i % 60, rng.choice(["x", "y", "z"]), t) for i, t in enumerate(texts)]
    train = spark.createDataFrame(rows, "doc_id long, lang string, text string").repartition(3)
    profiles = fit_language_profiles(train)
    grams = F.explode(language._grams("text", 3)).alias("gram")
    plain = train.select("lang", grams).groupBy("lang", "gram").agg(F.count("*").alias("cnt"))
    key = lambda df: sorted((r.lang, r.gram, r.cnt) for r in df.collect())
    assert key(language._counts(train, "text", "lang", 3)) == key(plain)
    new = train.select("doc_id", "text")
    tagged = tag_language(new, profiles)
    want = {r.doc_id: r.language for r in tag_language(new, profiles, max_broadcast_bytes=0).collect()}
    assert len(want) == 60 and {r.doc_id: r.language for r in tagged.collect()} == want
    tagged.explain("simple")
    assert "Generate" not in capsys.readouterr().out


def test_tags_do_not_depend_on_where_a_text_is_cut(spark):
    import random

    rng = random.Random(12)
    train = spark.createDataFrame([("a", "x", "abab baba ab ba"), ("b", "y", "abba baab aabb"), ("c", "z", "bbb aaa bbba")], "doc_id string, lang string, text string")
    profiles = fit_language_profiles(train)
    docs = {f"d{i}": "".join(rng.choice("ab ") for _ in range(rng.randrange(0, 40))) for i in range(80)}
    want = {r.doc_id: r.language for r in tag_language(spark.createDataFrame(list(docs.items()), "doc_id string, text string"), profiles).collect()}
    rows = []
    for d, t in docs.items():
        cuts = sorted(rng.randrange(len(t) + 1) for _ in range(rng.randrange(0, 30)))
        pieces = [t[a:b] for a, b in zip([0, *cuts], [*cuts, len(t)])]
        rows += [(d, i, len(pieces), p or rng.choice(["", None])) for i, p in enumerate(pieces)]
    parts = spark.createDataFrame(rows, "doc_id string, part_no int, n_parts int, text string").repartition(3)
    assert {r.doc_id: r.language for r in tag_language(parts, profiles).collect()} == want
    # spans of two parts give the same seams
    seams = lambda span: sorted(map(repr, with_seams(parts, 2, span).collect()))
    assert seams(2) == seams(4096)
    whole = {}
    for r in sorted(with_seams(parts, 2, 2).collect(), key=lambda r: (r.doc_id, r.part_no)):
        whole.setdefault(r.doc_id, []).extend(r.text[i : i + 3] for i in range(len(r.text) - 2))
    assert {d: sorted(g) for d, g in whole.items()} == {d: sorted(t[i : i + 3] for i in range(len(t) - 2)) for d, t in docs.items()}


def test_seams_are_rows_of_their_own(spark):
    rows = [("d", 0, 3, "abcd"), ("d", 1, 3, ""), ("d", 2, 3, "Ef"), ("e", 0, 1, "xyz")]
    got = with_seams(spark.createDataFrame(rows, "doc_id string, part_no int, n_parts int, text string"), 2)
    # the texts stay as they are, so they need not be moved to what stands before them
    assert sorted((r.doc_id, r.text) for r in got.collect()) == [("d", ""), ("d", "abcd"), ("d", "cdef"), ("d", "ef"), ("e", "xyz")]


def test_long_documents_are_cleaned_once(spark):
    rows = [(d, i, 5, f"head\na line that is long enough {i}\nfoot") for d in "ab" for i in range(5)]
    pages = spark.createDataFrame(rows, "doc_id string, page_no int, n_pages int, text string")
    cleaned = lambda df: df._jdf.queryExecution().optimizedPlan().toString().count("collect_list(")
    cut, whole = (ingest(pages, EngineConfig(language="off", block_pages=b)) for b in (2, 256))
    # pages are gathered for the probe; their texts were written once
    assert cleaned(cut) < cleaned(whole)
    joined = lambda df: {d: "".join(r.text for r in sorted(g, key=lambda r: r.part_no)) for d in "ab" for g in [[r for r in df if r.doc_id == d]]}
    cut, whole = cut.collect(), whole.collect()
    assert len(cut) == 6 and joined(cut) == joined(whole)
    assert {r.meta.token_count for r in cut} == {r.meta.token_count for r in whole}


def test_errors_stand_beside_the_results(spark):
    text = "a line that is long enough to be native text {}"
    pages = [(d, i, 2, text.format(i)) for d in "abc" for i in range(2)]
    df = spark.createDataFrame(pages, "doc_id string, page_no int, n_pages int, text string")
    failed = spark.createDataFrame([("b", "ValueError: broken"), ("x", "OSError: gone")], "doc_id string, error string")
    engine = spark.createDataFrame([("a", "docling", "no layout")], "doc_id string, engine string, error string")
    run = ingest_run(df, EngineConfig(language="off"), failures=failed, engine_errors=engine)
    rows = {r.doc_id: r for r in run.bundles.collect()}
    assert sorted(rows) == ["a", "c"] and rows["a"].meta.tables.error == "no layout" and rows["c"].meta.tables.error is None
    assert run.counts.get == {"documents": 2, "parts": 2, "tokens": sum(r.meta.token_count for r in rows.values()), "engine_errors": 1}
    errors = sorted(map(tuple, run.errors.collect()), key=repr)
    assert errors == [("a", "tables", "docling", "no layout"), ("b", "extract", None, "ValueError: broken"), ("x", "extract", None, "OSError: gone")]
    quiet = ingest_run(df, EngineConfig(language="off"))
    assert quiet.bundles.count() == 3 and quiet.errors.count() == 0


def test_texts_move_once_whatever_failed_and_however_long(spark, tmp_path):
    line = "A line of the page {} of this document, long enough to be a native one."
    rows = [(d, i, n, line.format(i)) for d, n in (("a", 3), ("b", 1), ("c", 7), ("bad", 1), ("long and bad", 5)) for i in range(n)]
    schema = "doc_id string, page_no int, n_pages int, text string"
    spark.createDataFrame(rows, schema).write.parquet(f"{tmp_path}/pages")
    pages = spark.read.parquet(f"{tmp_path}/pages")
    failed = spark.createDataFrame([("bad", "x"), ("long and bad", "y"), ("unknown", "z")], "doc_id string, error string")
    threshold = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        for block_pages in (256, 2):
            run = ingest_run(pages, EngineConfig(language="off", tables="off", block_pages=block_pages), failures=failed)
            plan = run.bundles._jdf.queryExecution().explainString(spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("simple"))
            moved = plan.count("partial_collect_list(struct(page_no")
            assert moved == 1, "the texts of short documents go through one exchange, with their parts"
            docs = {}
            for r in sorted(run.bundles.collect(), key=lambda r: (r.doc_id, r.part_no)):
                docs[r.doc_id] = docs.get(r.doc_id, "") + r.text
            assert docs == {d: "".join(line.format(i) for i in range(n)) for d, n in (("a", 3), ("b", 1), ("c", 7))}
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", threshold)


def test_pages_that_disagree_on_the_length_stay_one_document(spark):
    schema = "doc_id string, page_no int, n_pages int, text string"
    rows = [("a", 0, 1, "the first"), ("a", 1, 3, "the second"), ("a", 2, 3, "the third"), ("b", 0, 1, "other"), ("c", 0, None, "none")]
    got = ingest(spark.createDataFrame(rows, schema), EngineConfig(language="off", tables="off", block_pages=2)).collect()
    assert len({(r.doc_id, r.part_no) for r in got}) == len(got)
    assert {r.doc_id: r.text for r in got if r.part_no == 0} == {"a": "the firstthe second", "b": "other", "c": "none"}


def test_tables_in_few_files_are_spread_by_size(spark, tmp_path, monkeypatch):
    from folioworks.plans import inputs

    spark.range(5000).selectExpr("id AS doc_id", "sha2(string(id), 512) AS text").coalesce(1).write.parquet(f"{tmp_path}/one table/documents.parquet")
    assert inputs.tasks_for(1 << 30, 12) == 64 and inputs.tasks_for(6 << 30, 12) == 384 and inputs.tasks_for(1000, 12) == 12
    few = inputs.read_table(spark, f"{tmp_path}/one table", "documents", "doc_id")
    monkeypatch.setattr(inputs, "TASK_BYTES", 20_000)
    many = inputs.read_table(spark, f"{tmp_path}/one table", "documents", "doc_id")
    assert few.rdd.getNumPartitions() == spark.sparkContext.defaultParallelism < 10 < many.rdd.getNumPartitions()
    assert many.select("doc_id").distinct().count() == many.count() == 5000


def test_tags_are_the_same_with_and_without_a_table_of_places(spark, monkeypatch):
    from folioworks.operators import language

    known = spark.createDataFrame([("the cat and the hat", "en"), ("der Hund und die Katze", "de"), ("日本語の文", "ja")], "text string, lang string")
    texts = ["the hat", "die Katze 😀", "日本 the", "", None, "xq", "Ünknöwn ɐɐɐ", "a\x00b\x00c", "the cat " * 300_000]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id int, text string")
    profiles = fit_language_profiles(known)
    scores = lambda: sorted(map(tuple, language._score(df, "doc_id", "text", profiles).groupBy("doc_id").sum("grams", "s0", "s1", "s2").collect()))
    fast = scores()
    monkeypatch.setattr(language, "DENSE_GRAMS", 0)
    assert fast == scores() and len(fast) == len(texts)
