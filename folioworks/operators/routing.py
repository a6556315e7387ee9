"""Probe, route and choose the text source of each document."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks import fixed_values as fixed
from folioworks.functions.text import py_strip
from folioworks.operators.blocks import BLOCK_PAGES, attach, prepare, spread, with_page_counts
from folioworks.operators.paging import page_stats


def sample_pages(pages: DataFrame, max_pages: int = 12) -> DataFrame:
    """Every step-th page, ``max_pages`` at most, with step from the page count."""
    counted = with_page_counts(pages)
    step = F.greatest(F.lit(1), F.floor(F.col("n_pages") / max_pages)).cast("int")
    return counted.filter(
        (F.col("page_no") % step == 0) & (F.floor(F.col("page_no") / step) < max_pages)
    )


def probe(pages: DataFrame, max_pages: int = 12, text_chars: int = fixed.TEXT_PAGE_CHARS) -> DataFrame:
    """Text pages among the sampled ones. Texts are measured before any shuffle."""
    sampled = sample_pages(page_stats(pages), max_pages)
    info = F.struct(F.col("page_no").alias("index"), "chars", "images")
    return (
        sampled.groupBy("doc_id")
        .agg(
            F.max("n_pages").alias("num_pages"),
            F.count_if(F.col("chars") > text_chars).cast("int").alias("text_pages"),
            F.count(F.lit(1)).alias("_sampled"),
            # at most max_pages entries per document
            F.sort_array(F.collect_list(info)).alias("pages"),
        )
        .select(
            "doc_id",
            "num_pages",
            "text_pages",
            (F.col("text_pages") / F.greatest(F.lit(1), "_sampled")).alias("text_page_ratio"),
            "pages",
        )
    )


def route(probed: DataFrame, min_ratio: float = 0.55) -> DataFrame:
    """``router``: ocr where too few pages have text."""
    return probed.withColumn(
        "router", F.when(F.col("text_page_ratio") < min_ratio, "ocr").otherwise("non_ocr")
    )


def resolve_route(routed: DataFrame, engine: Column | str, available: Column | bool) -> DataFrame:
    """``use_ocr``, ``route_reason`` and ``routed`` under the engine flag.

    ``engine`` and ``available`` may be columns or plain values.
    """
    engine = F.lit(engine) if isinstance(engine, str) else engine
    available = F.lit(available) if isinstance(available, bool) else available

    def applies(rule) -> Column:
        flag, has_ocr, choice = rule[:3]
        test = engine == flag
        if has_ocr is not None:
            test &= available == has_ocr
        if choice is not None:
            test &= F.col("router") == choice
        return test

    def decided(at: int) -> Column:
        first, *others = fixed.ROUTE_RULES
        return reduce(lambda acc, r: acc.when(applies(r), r[at]), others, F.when(applies(first), first[at]))

    return routed.withColumns({"use_ocr": decided(3), "route_reason": decided(4)}).withColumn(
        "routed", F.when(F.col("use_ocr"), "ocr").otherwise("non_ocr")
    )


def page_counts(pages: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """``doc_id, n_pages`` of every document in a page table, from narrow rows."""
    return prepare(pages, block_pages).groupBy("doc_id").agg(F.max("n_pages").alias("n_pages"))


def select_source(
    routes: DataFrame, native_pages: DataFrame, ocr_pages: DataFrame, block_pages: int = BLOCK_PAGES
) -> DataFrame:
    """OCR pages of documents with ``use_ocr``, native pages of the others.

    ``routes`` has ``doc_id, use_ocr``. Each side is filtered by its own join on
    its own page counts, so a document may have more pages on one side than on
    the other, or none there, and no pages are read into both branches. Parts (see ``gather``) may be given
    instead of pages: they are as the join needs them, so no text is moved again.
    """

    def side(pages: DataFrame, wanted: Column, source: str) -> DataFrame:
        ready = prepare(pages, block_pages)
        docs = routes.filter(wanted).select("doc_id").join(page_counts(ready, block_pages), "doc_id")
        kept = attach(ready, docs, "left_semi", block_pages)
        if "pages" in ready.columns:
            return kept.withColumn("routed", F.lit(source))
        return kept.select(
            "doc_id", "page_no", "n_pages", F.coalesce("text", F.lit("")).alias("text"), F.lit(source).alias("routed")
        )

    return side(native_pages, ~F.col("use_ocr"), "non_ocr").unionByName(
        side(ocr_pages, F.col("use_ocr"), "ocr")
    )


def select_parts(
    docs: DataFrame, native_pages: DataFrame, ocr_pages: DataFrame, block_pages: int = BLOCK_PAGES
) -> DataFrame:
    """The parts (see ``gather``) of what ``select_source`` gives.

    ``docs`` has ``doc_id, use_ocr, n_pages``, the latter of the document's source. Pages of both tables go
    through one exchange and meet in the row of their part, where the source is chosen. The parts stay where
    they lie, and filters on them do not reach below it: what reads them several times reads the same exchange.
    """

    def tagged(pages: DataFrame, ocr: bool) -> DataFrame:
        text = F.coalesce("text", F.lit("")).alias("text")
        return prepare(pages, block_pages).select("doc_id", "block", "n_pages", "page_no", text, F.lit(ocr).alias("_ocr"))

    def side(ocr: Column, name: str) -> list[Column]:
        page = F.when(ocr, F.struct("page_no", "text"))
        return [F.max(F.when(ocr, F.col("n_pages"))).alias(f"{name}_n"), F.sort_array(F.collect_list(page)).alias(name)]

    # by name, else how the tables happen to lie may have one branch of a plan exchange other rows than the next
    lying = tagged(native_pages, False).unionByName(tagged(ocr_pages, True)).repartition("doc_id", "block")
    both = lying.groupBy("doc_id", "block").agg(
        *side(~F.col("_ocr"), "_native"), *side(F.col("_ocr"), "_seen")
    )
    chosen = both.join(spread(docs.select("doc_id", "use_ocr", "n_pages"), block_pages).drop("n_pages"), ["doc_id", "block"])
    return chosen.select(
        "doc_id",
        "block",
        F.when(F.col("use_ocr"), F.col("_seen_n")).otherwise(F.col("_native_n")).alias("n_pages"),
        F.when(F.col("use_ocr"), F.col("_seen")).otherwise(F.col("_native")).alias("pages"),
    ).filter(F.size("pages") > 0)


def with_fallback(primary: DataFrame, fallback: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """All pages of a document from the fallback if any primary page failed.

    A failed page has a null text, or has no row although ``fallback`` (which
    has one row per expected page) has one. Failed fallback pages become ''.
    """
    expected = prepare(fallback, block_pages).select(
        "doc_id", "block", "page_no", "n_pages", F.col("text").alias("_second")
    )
    both = expected.join(
        primary.select("doc_id", "page_no", F.col("text").alias("_first")), ["doc_id", "page_no"], "left"
    )
    failed = (
        both.filter(F.col("_first").isNull()).groupBy("doc_id").agg(F.max("n_pages").alias("n_pages"))
    )
    marked = attach(both, failed.withColumn("_failed", F.lit(True)), "left", block_pages)
    use_second = F.coalesce("_failed", F.lit(False))
    return marked.select(
        "doc_id",
        "page_no",
        "n_pages",
        F.when(use_second, F.coalesce("_second", F.lit(""))).otherwise(F.col("_first")).alias("text"),
        F.when(use_second, "fallback").otherwise("primary").alias("engine"),
    )


def ocr_text(text: Column, markdown: Column, output: Column) -> Column:
    """The first of the three that is not empty, stripped."""
    empty = F.lit("")
    return py_strip(
        F.coalesce(F.nullif(text, empty), F.nullif(markdown, empty), F.nullif(output, empty), empty)
    )


def split_errors(pages: DataFrame, failed: Column, message: str, block_pages: int = BLOCK_PAGES) -> tuple[DataFrame, DataFrame]:
    """(pages of sound documents, one error row per failing document)."""
    ready = prepare(pages, block_pages)
    bad = ready.filter(failed).groupBy("doc_id").agg(
        F.max("n_pages").alias("n_pages"), F.count(F.lit(1)).alias("bad_pages")
    )
    sound = attach(ready, bad, "left_anti", block_pages)
    return sound.drop("block"), bad.select("doc_id", F.lit(message).alias("error"), "bad_pages")
