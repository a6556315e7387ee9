"""Long documents: what is written and moved of their texts, and lines counted by digest."""

import contextlib
import random
import string
import time
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from folioworks.config import EngineConfig
from folioworks.functions import repeats
from folioworks.operators import assembly, blocks, cleaning, routing
from folioworks.plans import ingest as plan
from folioworks.session import shared_dir

from test_cleaning import by_doc, page_df, random_docs

SCHEMA = "doc_id string, page_no int, n_pages int, text string"
CFG = EngineConfig(language="off", tables="off", block_pages=2)


def noise(rng, n):
    return "".join(rng.choices(string.ascii_letters + string.digits, k=n))


@pytest.fixture(scope="module")
def two_sources(spark):
    """Native and OCR pages of documents of two to seven pages that repeat nothing, and the bytes of either."""
    rng, rows = random.Random(5), []
    for d in range(150):
        n = 2 + d % 6
        rows += [(f"d{d}", p, n, "\n".join(noise(rng, 400) for _ in range(3)), "\n".join(noise(rng, 400) for _ in range(3))) for p in range(n)]
    native = spark.createDataFrame([r[:4] for r in rows], SCHEMA)
    ocr = spark.createDataFrame([(*r[:3], r[4]) for r in rows], SCHEMA)
    # of every other document the native pages hold no text
    blank = F.when(F.substring("doc_id", 2, 9).cast("int") % 2 == 0, F.col("text")).otherwise("")
    return native.withColumn("text", blank), ocr, sum(len(r[4]) for r in rows)


def shuffled(spark):
    """Bytes of the shuffle files there are."""
    found = [Path(str(d)) for d in spark.sparkContext._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().localDirs()]
    return {str(f): f.stat().st_size for top in found for f in top.rglob("shuffle_*.data")}


def added(spark, before):
    return sum(size for f, size in shuffled(spark).items() if f not in before)


def test_shuffles_of_the_parts_go_once_these_are_written(spark, two_sources):
    native, ocr, size = two_sources
    before = shuffled(spark)
    bundles = plan.ingest(native, CFG, ocr)
    until = time.time() + 20
    while (left := added(spark, before)) > 0.05 * size and time.time() < until:
        time.sleep(0.2)
    assert left <= 0.05 * size
    assert spark.conf.get("spark.sql.classic.shuffleDependency.fileCleanup.enabled", None) is None
    assert bundles.select("doc_id").distinct().count() == 150


def test_texts_of_parts_move_once_and_are_written_once(spark, two_sources, monkeypatch):
    native, ocr, size = two_sources
    for module in (plan, assembly):
        monkeypatch.setattr(module, "shuffles_deleted", contextlib.nullcontext, raising=False)
    before, top = shuffled(spark), Path(shared_dir(spark).removeprefix("file:"))
    kept = {f: f.stat().st_size for f in top.rglob("*.parquet")}
    plan.ingest(native, CFG, ocr)
    # half of the native texts and all of the OCR texts, and some digests: 1.5 times the size as a rule, 7.8 before
    assert added(spark, before) < 4 * size
    written = sum(f.stat().st_size for f in top.rglob("*.parquet") if f not in kept)
    assert written < 1.1 * size


def test_bundles_of_two_sources_do_not_depend_on_blocks(spark):
    """Also where native and OCR pages differ in number, and where pages disagree on it or come twice."""
    docs = random_docs(40, 77, most=12)
    edges = ["e" * 31, "é" * 16, "f" * 32, "a header of more bytes than a digest has"]
    docs |= {f"h{i}": [f"{e}\nthe body of page {p}, number {i}.\n{e}s at the foot" for p in range(9)] for i, e in enumerate(edges)}
    ocr = [(d, p, len(t), f"scan {p}\n{x}") for d, t in docs.items() for p, x in enumerate(t)]
    native = [(d, p, 1 if i % 3 == 0 else len(t), x if i % 2 else "") for i, (d, t) in enumerate(docs.items()) for p, x in enumerate(t[:1] if i % 3 == 0 else t)]

    def texts(more, b):
        cfg = EngineConfig(language="off", tables="off", block_pages=b)
        made = {}
        for r in plan.ingest(spark.createDataFrame(native + more, SCHEMA), cfg, spark.createDataFrame(ocr + more, SCHEMA)).orderBy("doc_id", "part_no").collect():
            w = made.setdefault(r["doc_id"], ["", [], [], set()])
            w[0], w[1], w[2] = w[0] + r["text"], w[1] + r["page_slices"], w[2] + r["page_offsets"]
            w[3].add((r["routed"], r["meta"]["token_count"]))
        return made

    whole = texts([], 256)
    assert texts([], 2) == whole
    assert not any(e in t for (t, *_), e in zip([whole[f"h{i}"] for i in range(4)], edges, strict=True))
    twice = [("again", p, 5, f"page {p} of a text that comes twice.") for p in range(5)] * 2
    assert texts(twice, 2) == texts(twice, 256)
    unlike = [("unlike", p, 9 if p else 1, f"page {p} of a text whose pages disagree.") for p in range(9)]
    assert {d: w for d, w in texts(unlike, 2).items() if d != "unlike"} == whole


def test_parts_of_both_sources_are_those_of_pages(spark):
    docs = random_docs(40, 31, most=9)
    native, ocr = page_df(spark, docs), page_df(spark, {d: [*t, "one more"] for d, t in docs.items() if d != min(docs)})
    native, ocr = (blocks.prepare(p, 2) for p in (native.filter(F.col("doc_id") != max(docs)), ocr))
    routes = spark.createDataFrame([(d, i % 2 == 0) for i, d in enumerate(sorted(docs)[3:])], "doc_id string, use_ocr boolean")
    want = blocks.gather(routing.select_source(routes, native, ocr, 2).drop("routed"), 2)
    counts = [routing.page_counts(p, 2).withColumn("use_ocr", F.lit(i == 1)) for i, p in enumerate((native, ocr))]
    lengths = counts[0].unionByName(counts[1])
    got = routing.select_parts(routes.join(lengths, ["doc_id", "use_ocr"]), native, ocr, 2)
    assert {tuple(map(str, r)) for r in got.select(want.columns).collect()} == {tuple(map(str, r)) for r in want.collect()}


def test_lines_are_found_again_by_their_digests(spark):
    docs = random_docs(60, 3, most=9) | {"long": [f"{'word ' * 20}\nbody {i} of the page\n{'é' * 40}" for i in range(9)]}
    pages = page_df(spark, docs)
    for count in (cleaning.repeated_edges, cleaning.boilerplate_lines):
        by_line = count(pages).withColumn("line", repeats.digest(F.col("line")))
        by_digest = count(pages, digests=True)
        assert sorted(map(str, by_digest.collect())) == sorted(map(str, by_line.collect()))
        assert by_digest.filter(F.octet_length("line") > 32).count() == 0 < by_digest.filter(F.octet_length("line") == 32).count()
    assert by_doc(cleaning.clean_pages(pages, EngineConfig(block_pages=2)), "text") == by_doc(cleaning.clean_pages(pages), "text")
