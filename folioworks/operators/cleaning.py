"""Repeated lines of a document: headers, footers and boilerplate.

Documents of one part are decided inside their row. For longer ones the counts
run over all parts first, by grouped aggregates with map-side combine; what they
move of a line is its digest, and each part finds its own lines again by that.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.config import EngineConfig
from folioworks.functions import repeats
from folioworks.functions.text import (
    let,
    lines,
    normalize_marks,
    remove_page_labels,
    weld,
)
from folioworks.operators.blocks import BLOCK_PAGES, attach, gather, only_long, prepare


def repeated_edges(
    pages: DataFrame,
    top_k: int = 2,
    bottom_k: int = 2,
    share: float = 0.45,
    min_pages: int = 3,
    block_pages: int = BLOCK_PAGES,
    digests: bool = False,
) -> DataFrame:
    """Lines that open or close enough pages of their document.

    Occurrences are counted, tops and bottoms apart. The counts fold together
    before the shuffle, so one header on a million pages travels as a few rows.
    With ``digests``, ``line`` is what ``repeats.digest`` gives, and no text is moved.
    """

    def marked(ls: Column, top: int) -> Column:
        key = repeats.digest if digests else lambda l: l
        return F.transform(ls, lambda l: F.struct(key(l).alias("line"), F.lit(top).alias("top")))

    edges = let(
        repeats.stripped_lines(F.col("text")),
        lambda ls: F.concat(marked(repeats.top_lines(ls, top_k), 1), marked(repeats.bottom_lines(ls, bottom_k), 0)),
    )
    # explode_outer, since explode would have the optimizer evaluate the array
    # a second time to filter empty ones out
    rows = (
        prepare(pages, block_pages)
        .filter(F.col("n_pages") >= min_pages)
        .select("doc_id", "n_pages", F.explode_outer(edges).alias("e"))
        .filter(F.col("e").isNotNull())
    )
    counts = rows.groupBy("doc_id", "n_pages", F.col("e.line").alias("line")).agg(
        F.sum("e.top").alias("top_count"), F.sum(1 - F.col("e.top")).alias("bottom_count")
    )
    return counts.filter(F.greatest("top_count", "bottom_count") / F.col("n_pages") >= share)


def boilerplate_lines(
    pages: DataFrame,
    min_len: int = 6,
    share: float = 0.5,
    min_pages: int = 3,
    block_pages: int = BLOCK_PAGES,
    digests: bool = False,
) -> DataFrame:
    """Lines on a large share of the pages of their document, counted once per page.

    With ``digests``, ``line`` is what ``repeats.digest`` gives, and no text is moved.
    """
    keys = F.array_distinct(repeats.long_lines(lines(F.col("text")), min_len))
    if digests:
        keys = F.transform(keys, repeats.digest)
    rows = (
        prepare(pages, block_pages)
        .filter(F.col("n_pages") >= min_pages)
        .select("doc_id", "n_pages", "page_no", F.explode_outer(keys).alias("line"))
        .filter(F.col("line").isNotNull())
    )
    counts = rows.groupBy("doc_id", "n_pages", "line").agg(
        F.count(F.lit(1)).alias("page_count"), F.min("page_no").alias("first_page")
    )
    return counts.filter(F.col("page_count") / F.col("n_pages") >= share)


def _per_document(found: DataFrame, name: str) -> DataFrame:
    """Lines found (or their digests) as one array per document.

    Bounded: at most (top_k + bottom_k) / share edge lines, and boilerplate of
    no more text than 1 / share pages.
    """
    return found.groupBy("doc_id", "n_pages").agg(F.collect_list("line").alias(name))


def _lines_of_pages() -> Column:
    return F.transform("pages", lambda p: F.struct(p["page_no"].alias("page_no"), lines(p["text"]).alias("ls")))


def _no_digests() -> Column:
    return F.array().cast("array<binary>")


def _by_length(known: Column, here: Column, cfg: EngineConfig, long: bool | None) -> Column:
    """Lines to drop: those known of a long document, those found here of another. ``long`` says it of all rows."""
    if long is None:
        return F.when(F.col("n_pages") > cfg.block_pages, known).otherwise(here)
    return known if long else here


def _drop_edges(pages: Column, cfg: EngineConfig, long: bool | None = None) -> Column:
    """Pages of lines without edge lines; ``_edges`` holds digests of those of long documents."""
    n = F.col("n_pages")
    here = repeats.repeated_edges(pages["ls"], n, cfg.edge_top, cfg.edge_bottom, cfg.edge_share)
    stripped = F.flatten(F.transform(pages["ls"], lambda ls: F.transform(ls, repeats.strip_line)))
    edges = _by_length(repeats.known(stripped, F.coalesce("_edges", _no_digests())), here, cfg, long)
    return let(
        edges,
        lambda e: F.transform(
            pages,
            lambda p: F.struct(p["page_no"].alias("page_no"), repeats.without_edges(p["ls"], e).alias("ls")),
        ),
    )


def _drop_boiler(pages: Column, cfg: EngineConfig, long: bool | None = None) -> Column:
    """Pages of long lines without boilerplate; ``_boiler`` holds digests of that of long documents."""

    def kept(keyed: Column) -> Column:
        here = repeats.repeated_lines(keyed["ls"], F.col("n_pages"), cfg.boiler_share)
        known = repeats.known(F.flatten(keyed["ls"]), F.coalesce("_boiler", _no_digests()))
        boiler = _by_length(known, here, cfg, long)
        return let(
            boiler,
            lambda b: F.transform(
                keyed, lambda p: F.struct(p["page_no"].alias("page_no"), repeats.without(p["ls"], b).alias("ls"))
            ),
        )

    keys = F.transform(
        pages,
        lambda p: F.struct(p["page_no"].alias("page_no"), repeats.long_lines(p["ls"], cfg.boiler_min_len).alias("ls")),
    )
    return let(keys, kept)


def _joined(pages: Column) -> Column:
    return F.transform(
        pages, lambda p: F.struct(p["page_no"].alias("page_no"), F.array_join(p["ls"], "\n").alias("text"))
    )


def _where_enough_pages(changed: Column, cfg: EngineConfig) -> Column:
    return F.when(F.col("n_pages") >= cfg.min_pages, changed).otherwise(F.col("pages"))


def _with_edges(parts: DataFrame, long_pages: DataFrame, cfg: EngineConfig) -> DataFrame:
    found = repeated_edges(long_pages, cfg.edge_top, cfg.edge_bottom, cfg.edge_share, cfg.min_pages, cfg.block_pages, True)
    return attach(parts, _per_document(found, "_edges"), "left", cfg.block_pages)


def strip_parts(
    parts: DataFrame, long_pages: DataFrame, cfg: EngineConfig = EngineConfig(), long: bool | None = None
) -> DataFrame:
    """Header and footer removal on parts. ``long``: whether all are of long documents, or none; None if it is not known."""
    bare = let(_lines_of_pages(), lambda pages: _joined(_drop_edges(pages, cfg, long)))
    return _with_edges(parts, long_pages, cfg).withColumn("pages", _where_enough_pages(bare, cfg)).drop("_edges")


def clean_parts(
    parts: DataFrame, long_pages: DataFrame | None, cfg: EngineConfig = EngineConfig(), long_parts: DataFrame | None = None
) -> DataFrame:
    """The whole chain on parts: headers and footers, boilerplate, paragraphs,
    list marks, page labels.

    Pages become ``struct<page_no, slice, text>``: ``slice`` is the page before
    label removal, ``text`` after it. ``long_pages`` are the pages of documents
    with more than one part; only they are counted over parts. None says that there is no such document.
    ``long_parts`` are the same pages if they are gathered already; then there are no other documents.
    """
    long = False if long_pages is None else True if long_parts is not None else None
    if long_pages is None:
        marked = parts.withColumns({"_edges": _no_digests(), "_boiler": _no_digests()})
    else:
        if long_parts is None:
            long_parts = gather(long_pages, cfg.block_pages)
        bare_long = inline_pages(strip_parts(long_parts, long_pages, cfg, long))
        boiler = _per_document(
            boilerplate_lines(bare_long, cfg.boiler_min_len, cfg.boiler_share, cfg.min_pages, cfg.block_pages, True), "_boiler"
        )
        marked = attach(_with_edges(parts, long_pages, cfg), boiler, "left", cfg.block_pages)
    body = let(
        _lines_of_pages(), lambda pages: _joined(let(_drop_edges(pages, cfg, long), lambda p: _drop_boiler(p, cfg, long)))
    )

    def finished(p: Column) -> Column:
        return let(
            normalize_marks(weld(p["text"], cfg.max_join_len)),
            lambda s: F.struct(
                p["page_no"].alias("page_no"), s.alias("slice"), remove_page_labels(s, cfg.bare_numbers).alias("text")
            ),
        )

    return marked.select(
        *[c for c in parts.columns if c != "pages"], F.transform(_where_enough_pages(body, cfg), finished).alias("pages")
    )


def inline_pages(parts: DataFrame) -> DataFrame:
    """Parts back to page rows. A part is never empty, so the outer form gives
    the same rows, and the optimizer does not evaluate the array a second time
    to filter empty ones out."""
    return parts.select("doc_id", "block", "n_pages", F.inline_outer("pages"))


def strip_headers_footers(
    pages: DataFrame,
    top_k: int = 2,
    bottom_k: int = 2,
    share: float = 0.45,
    min_pages: int = 3,
    block_pages: int = BLOCK_PAGES,
) -> DataFrame:
    """Drop blank lines and every line equal to a repeated edge line."""
    cfg = EngineConfig(
        edge_top=top_k, edge_bottom=bottom_k, edge_share=share, min_pages=min_pages, block_pages=block_pages
    )
    return inline_pages(strip_parts(gather(pages, block_pages), only_long(pages, block_pages), cfg))


def drop_boilerplate(
    pages: DataFrame,
    min_len: int = 6,
    share: float = 0.5,
    min_pages: int = 3,
    block_pages: int = BLOCK_PAGES,
) -> DataFrame:
    """Keep normalised lines that are long enough and not boilerplate."""
    cfg = EngineConfig(boiler_min_len=min_len, boiler_share=share, min_pages=min_pages, block_pages=block_pages)
    found = boilerplate_lines(only_long(pages, block_pages), min_len, share, min_pages, block_pages, True)
    marked = attach(gather(pages, block_pages), _per_document(found, "_boiler"), "left", block_pages)
    body = let(_lines_of_pages(), lambda pages: _joined(_drop_boiler(pages, cfg)))
    return inline_pages(marked.withColumn("pages", _where_enough_pages(body, cfg)))


def clean_pages(pages: DataFrame, cfg: EngineConfig = EngineConfig()) -> DataFrame:
    """The whole chain, page rows to page rows with ``slice`` and ``text``."""
    return inline_pages(clean_parts(gather(pages, cfg.block_pages), only_long(pages, cfg.block_pages), cfg))
