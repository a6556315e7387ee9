"""The end-to-end run."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F

from folioworks.config import EngineConfig
from folioworks.functions.grid import GRID_TYPE
from folioworks.operators import assembly, routing
from folioworks.operators import tables as T
from folioworks.operators.blocks import attach, gather, only_long, prepare
from folioworks.operators.cleaning import clean_parts, inline_pages
from folioworks.operators.language import LanguageProfiles, tag_language
from folioworks.session import materialize, shuffles_deleted


def routes_of(
    pages: DataFrame, cfg: EngineConfig = EngineConfig(), has_ocr: bool = True, ocr_pages: DataFrame | None = None
) -> DataFrame:
    """One row per document: probe figures, router choice, final route and pages of its source.

    With ``ocr_pages``, documents that have OCR pages only are there too, with
    no text page among none, and OCR is available to those documents that have
    OCR pages. Without, ``has_ocr`` says so for all. ``n_pages`` counts the
    pages of the chosen source.
    """
    probed = routing.probe(pages, cfg.max_pages_probe)
    if ocr_pages is None:
        chosen = routing.route(probed, cfg.min_text_page_ratio)
        return routing.resolve_route(chosen, cfg.ocr_engine, cfg.ocr_available and has_ocr).withColumn(
            "n_pages", F.col("num_pages")
        )
    counts = routing.page_counts(ocr_pages, cfg.block_pages).withColumnRenamed("n_pages", "_ocr_pages")
    every = probed.join(counts, "doc_id", "full").withColumns(
        {
            "num_pages": F.coalesce("num_pages", F.lit(0)),
            "text_pages": F.coalesce("text_pages", F.lit(0)),
            "text_page_ratio": F.coalesce("text_page_ratio", F.lit(0.0)),
            "pages": F.coalesce("pages", F.array().cast(probed.schema["pages"].dataType)),
        }
    )
    chosen = routing.route(every, cfg.min_text_page_ratio)
    available = F.col("_ocr_pages").isNotNull() & F.lit(cfg.ocr_available and has_ocr)
    resolved = routing.resolve_route(chosen, cfg.ocr_engine, available)
    return resolved.withColumn("n_pages", F.when(F.col("use_ocr"), F.col("_ocr_pages")).otherwise(F.col("num_pages"))).drop("_ocr_pages")


def table_stages(candidates: DataFrame | None, ocr_pages: DataFrame | None, cfg: EngineConfig) -> list[T.Stage]:
    """The engines that the options allow, in their order.

    Structured tables of the layout engine come before tables of its HTML, then pipe tables of OCR
    markdown, then the grid engine. Tables of the layout engines are cleaned; markdown tables stay as written.
    """
    b = cfg.block_pages

    def of_engine(engine: str, html: bool | None = None):
        given = candidates.filter(F.col("engine") == engine)
        if html is not None:
            flavor = F.col("flavor") if "flavor" in candidates.columns else F.lit(None).cast("string")
            is_html = F.coalesce(flavor == "html", F.lit(False))
            given = given.filter(is_html if html else ~is_html)
        return lambda docs: T.clean_tables(T.placed(given, docs, b)).drop("original_header")

    def markdown(docs: DataFrame) -> DataFrame:
        asked = attach(prepare(ocr_pages, b), docs, "left_semi", b)
        return T.placed(T.md_grids(T.md_tables(asked)).drop("md"), docs, b)

    given = candidates is not None
    layout = [T.Stage("docling", of_engine("docling", html)) for html in (False, True)] if given else []
    grid = [T.Stage("camelot", of_engine("camelot"))] if given else []
    parsed = ocr_pages is not None and cfg.prompt_mode == "markdown"
    pipes = [T.Stage("markdown", markdown, ocr_only=True)] if parsed else []
    return {"off": [], "docling": layout, "camelot": grid, "auto": layout + pipes + grid}[cfg.tables]


def collect_tables(
    candidates: DataFrame | None, ocr_pages: DataFrame | None, routes: DataFrame, cfg: EngineConfig
) -> tuple[DataFrame, DataFrame] | None:
    """(tables of the chosen engine, engine and count per document), or None if there is nothing to look at."""
    stages = table_stages(candidates, ocr_pages, cfg)
    if not stages:
        return None
    return T.cascade(routes, stages, "camelot" if cfg.tables == "camelot" else "docling")


def _texts(
    native: DataFrame, ocr: DataFrame | None, routes: DataFrame, failures: DataFrame | None, cfg: EngineConfig
) -> list[tuple[DataFrame, DataFrame]]:
    """Clean texts (see ``assembly.concat_parts``) and the routes of their documents; prepared pages are given.

    Documents of one part are cleaned in the row that gathered them: of their texts nothing is written or
    moved again. Long documents go apart, and their texts are written once. Where the pages of a document
    disagree on its length, all go together as long ones do.
    """
    b = cfg.block_pages

    def sound(parts: DataFrame) -> DataFrame:
        # of a long document the first part goes here, the others find no route
        if failures is None or ocr is not None:
            return parts
        # a plain literal would be folded out of the join's keys, and then the texts would move again
        bad = failures.groupBy("doc_id").agg(F.min(F.lit(0)).alias("block"))
        return parts.join(bad, ["doc_id", "block"], "left_anti")

    is_long = F.coalesce(F.col("n_pages") > b, F.lit(False))
    lengths = [_lengths(native, is_long)]
    if ocr is not None:
        lengths.append(_lengths(ocr, is_long))
        tagged = [of_table.withColumn("use_ocr", F.lit(i == 1)) for i, of_table in enumerate(lengths)]
        with shuffles_deleted(native.sparkSession):
            held = materialize(reduce(DataFrame.unionByName, tagged))
        lengths = [held]
        # pages of each document's source; where these disagree, what follows does not read it
        docs = routes.select("doc_id", "use_ocr").join(held.select("doc_id", "use_ocr", "n_pages"), ["doc_id", "use_ocr"])

    def gathered(kind: Column) -> DataFrame:
        if ocr is None:
            return gather(native.filter(kind), b)
        return routing.select_parts(docs.filter(kind), native.filter(kind), ocr.filter(kind), b)

    def in_pages() -> DataFrame:
        source = native if ocr is None else prepare(routing.select_source(routes, native, ocr, b).drop("routed"), b)
        parts = clean_parts(sound(gather(source, b)), only_long(source, b), cfg)
        return assembly.concat_parts(parts, cfg.page_sep, b, write=True)

    def in_parts(kind: Column) -> DataFrame:
        # lines are counted over the parts, too, so that all branches read the same exchange
        parts = gathered(kind)
        cleaned = clean_parts(sound(parts), inline_pages(parts), cfg, parts)
        return assembly.concat_parts(cleaned, cfg.page_sep, b, write=True)

    def in_rows(kind: Column) -> DataFrame:
        return assembly.concat_parts(clean_parts(sound(gathered(kind)), None, cfg), cfg.page_sep, b, long=False)

    some_long, some_short, mixed = _long_documents(lengths)
    if mixed:
        return [(in_pages(), routes)]
    if some_long and not some_short:
        return [(in_parts(is_long), routes)]
    if not some_long:
        return [(in_rows(~is_long), routes)]
    return [(in_rows(~is_long), routes.filter(~is_long)), (in_parts(is_long), routes.filter(is_long))]


def _lengths(pages: DataFrame, is_long: Column) -> DataFrame:
    """What the pages of each document say of its length: the most, and whether some or all say that it is long."""
    most, least = F.max("n_pages"), F.min("n_pages")
    return pages.groupBy("doc_id").agg(
        most.alias("n_pages"), F.max(is_long).alias("some"), F.min(is_long).alias("all"), (least < most).alias("unlike")
    )


def _long_documents(lengths: list[DataFrame]) -> tuple[bool, bool, bool]:
    """Whether there are long documents, others, and long ones whose pages disagree on their length."""
    found = []
    for of_doc in lengths:
        mixed = F.col("some") & (~F.col("all") | F.col("unlike"))
        kinds = of_doc.agg(F.max("some").alias("long"), F.max(~F.col("all")).alias("short"), F.max(mixed).alias("mixed"))
        with shuffles_deleted(of_doc.sparkSession):
            found.append(kinds.first())
    return tuple(any(r[kind] for r in found) for kind in ("long", "short", "mixed"))


def ingest(
    pages: DataFrame,
    cfg: EngineConfig = EngineConfig(),
    ocr_pages: DataFrame | None = None,
    tables: DataFrame | None = None,
    profiles: LanguageProfiles | None = None,
    engine_errors: DataFrame | None = None,
    failures: DataFrame | None = None,
) -> DataFrame:
    """Bundles of all documents of a page table.

    ``ocr_pages`` is the page table an OCR engine made, ``tables`` the raw
    tables of layout engines, ``profiles`` a fitted language model, ``engine_errors``
    (doc_id, engine, error) what table engines failed with. Documents
    are those of either page table, without those of ``failures`` (doc_id). Routes are settled
    from narrow rows first, and of the gathered parts only those of each document's source are cleaned.
    """
    if cfg.language == "auto" and profiles is None:
        raise ValueError('language="auto" needs profiles: fit them, or set language="off"')
    routes = routes_of(pages, cfg, ocr_pages is not None, ocr_pages)
    if failures is not None:
        # a document without a route has no bundle, whatever its pages
        routes = routes.join(failures.select("doc_id").distinct(), "doc_id", "left_anti")
    b = cfg.block_pages
    if ocr_pages is not None:
        # read by several branches: routes are a narrow row per document
        with shuffles_deleted(routes.sparkSession):
            routes = materialize(routes)
    texts = _texts(prepare(pages, b), prepare(ocr_pages, b) if ocr_pages is not None else None, routes, failures, cfg)
    languages = None
    if profiles is not None and cfg.language == "auto":
        # read twice from here on: for the tags and for the bundle
        parts = materialize(reduce(DataFrame.unionByName, [t for t, _ in texts]))
        languages = tag_language(parts, profiles)
        texts = [(parts, routes)]
    meta = None
    chosen = collect_tables(tables, ocr_pages, routes, cfg)
    if chosen is None and engine_errors is not None and cfg.tables != "off":
        chosen = T.cascade(routes, [], "camelot" if cfg.tables == "camelot" else "docling")
    if chosen is not None:
        served, engines = chosen
        if served is None:
            nothing = {"page_no": "int", "table_idx": "int", "engine": "string", "block": "int", "n_pages": "int", "grid": GRID_TYPE}
            served = routes.select("doc_id", *[F.lit(None).cast(t).alias(c) for c, t in nothing.items()]).limit(0)
        scored = T.table_names(T.score_tables(served))
        meta = T.table_meta(scored, engines, T.best_table(scored), cfg.block_pages, engine_errors)
    bundles = [assembly.bundle(parts, docs, languages, meta, b) for parts, docs in texts]
    return reduce(DataFrame.unionByName, bundles)


@dataclass(frozen=True)
class Run:
    """Bundles, the errors beside them, and counts that are there once the bundles were written."""

    bundles: DataFrame
    errors: DataFrame
    counts: Observation


def ingest_run(
    pages: DataFrame,
    cfg: EngineConfig = EngineConfig(),
    ocr_pages: DataFrame | None = None,
    tables: DataFrame | None = None,
    profiles: LanguageProfiles | None = None,
    failures: DataFrame | None = None,
    engine_errors: DataFrame | None = None,
) -> Run:
    """``ingest`` with an error channel.

    Documents of ``failures`` (doc_id, error), such as ``extract_with`` gives, are left out of the
    bundles with all their pages and stand in ``errors`` (doc_id, stage, engine, error), as do the
    ``engine_errors`` of the table engines, whose documents go on. ``counts`` is observed while the
    bundles are written, without another pass: documents, parts, tokens, and documents with an engine error.
    """
    bundles = ingest(pages, cfg, ocr_pages, tables, profiles, engine_errors, failures)
    first = F.col("part_no") == 0
    counts = Observation()
    bundles = bundles.observe(
        counts,
        F.count_if(first).alias("documents"),
        F.count(F.lit(1)).alias("parts"),
        F.sum(F.when(first, F.col("meta.token_count"))).alias("tokens"),
        F.count_if(first & F.col("meta.tables.error").isNotNull()).alias("engine_errors"),
    )
    nothing = F.lit(None).cast("string")
    told = [
        failures.select("doc_id", F.lit("extract").alias("stage"), nothing.alias("engine"), "error") if failures is not None else None,
        engine_errors.select("doc_id", F.lit("tables").alias("stage"), "engine", "error") if engine_errors is not None else None,
    ]
    told = [t for t in told if t is not None]
    none = pages.select("doc_id", nothing.alias("stage"), nothing.alias("engine"), nothing.alias("error")).limit(0)
    return Run(bundles, reduce(DataFrame.unionByName, told) if told else none, counts)
