"""Keeping long documents apart: the (doc_id, block) key.

A page table has ``doc_id, page_no`` (0-based) and, where known, ``n_pages``.
One document may hold any share of all pages, so nothing here groups pages by
``doc_id`` alone. Pages fall into blocks of ``block_pages`` pages, and pages
that meet in one row share ``(doc_id, block)``: that is a *part*. Usual
documents are one part. What long documents need to know across their parts is
a small fact per document: it is aggregated with map-side combine and comes
back to the parts on that same key, one copy per part.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BLOCK_PAGES = 256


def block_of(page_no: Column, n_pages: Column, block_pages: int = BLOCK_PAGES) -> Column:
    """Block of a page; numbers beyond n_pages stay in the last block."""
    own = F.floor(page_no / block_pages)
    return F.least(own, F.floor((n_pages - 1) / block_pages)).cast("int")


def with_block(pages: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    return pages.withColumn("block", block_of(F.col("page_no"), F.col("n_pages"), block_pages))


def with_page_counts(pages: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Add ``n_pages``. Free where the page table already stores it."""
    if "n_pages" in pages.columns:
        return pages
    own = F.floor(F.col("page_no") / block_pages)
    counts = pages.groupBy("doc_id").agg(
        F.count(F.lit(1)).cast("int").alias("n_pages"), F.max(own).alias("_last")
    )
    per_block = counts.select(
        "doc_id", "n_pages", F.explode(F.sequence(F.lit(0).cast("bigint"), "_last")).alias("_own")
    )
    return pages.withColumn("_own", own).join(per_block, ["doc_id", "_own"]).drop("_own")


def prepare(pages: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Pages with ``n_pages`` and ``block``."""
    if "block" in pages.columns:
        return pages
    return with_block(with_page_counts(pages, block_pages), block_pages)


def gather(pages: DataFrame, block_pages: int = BLOCK_PAGES, value: str = "text") -> DataFrame:
    """Parts: ``doc_id, block, n_pages, pages array<struct<page_no, text>>``.

    The one exchange page texts go through. A page table bucketed by
    (doc_id, block) does without it. A part has at most ``block_pages`` pages.
    Another column than the text may be gathered as ``value``.
    """
    filled = F.coalesce("text", F.lit("")) if value == "text" else F.col(value)
    page = F.struct("page_no", filled.alias(value))
    return (
        prepare(pages, block_pages)
        .groupBy("doc_id", "block")
        .agg(F.max("n_pages").alias("n_pages"), F.sort_array(F.collect_list(page)).alias("pages"))
    )


def only_long(pages: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Pages of documents with more than one part."""
    return prepare(pages, block_pages).filter(F.col("n_pages") > block_pages)


def spread(facts: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """One copy of a document's facts (with ``n_pages``) per block of it."""
    last = F.greatest(F.lit(0), F.floor((F.col("n_pages") - 1) / block_pages)).cast("int")
    return facts.withColumn("block", F.explode(F.sequence(F.lit(0), last)))


def attach(rows: DataFrame, facts: DataFrame, how: str = "left", block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Bring per-document facts (with ``n_pages``) to parts or prepared pages."""
    return rows.join(spread(facts, block_pages).drop("n_pages"), ["doc_id", "block"], how)
