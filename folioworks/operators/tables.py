"""Tables as rows: ``doc_id, engine, page_no, table_idx, grid`` (+ ``n_pages``)."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks import fixed_values as fixed
from folioworks.functions import grid as G
from folioworks.functions import markup as M
from folioworks.operators.assembly import empty_table_meta
from folioworks.operators.blocks import BLOCK_PAGES, spread, with_block
from folioworks.session import materialize


def _page_keys(pages: DataFrame) -> list[str]:
    return [c for c in ("doc_id", "page_no", "n_pages") if c in pages.columns]


def _unnest(df: DataFrame, keys: list[str], array: Column, at: str, name: str) -> DataFrame:
    """posexplode that evaluates its array once: the plain form has the
    optimizer filter empty arrays out first, at the cost of a second evaluation."""
    return df.select(*keys, F.posexplode_outer(array).alias(at, name)).filter(F.col(at).isNotNull())


def md_tables(pages: DataFrame) -> DataFrame:
    """Pipe tables of markdown pages, numbered from 1 in page order."""
    keys = _page_keys(pages)
    found = _unnest(pages, keys, M.pipe_tables(F.coalesce("text", F.lit(""))), "_at", "md")
    return found.select(*keys, F.lit("markdown").alias("engine"), (F.col("_at") + 1).alias("table_idx"), "md")


def md_grids(tables: DataFrame) -> DataFrame:
    return tables.withColumn("grid", M.pipe_grid(F.col("md")))


def html_grids(pages: DataFrame, html: str = "html") -> DataFrame:
    """<table> elements of HTML pages, numbered from 1 in page order."""
    keys = _page_keys(pages)
    found = _unnest(pages, keys, M.html_tables(F.col(html)), "_at", "_html")
    return found.select(
        *keys,
        F.lit("docling").alias("engine"),
        F.lit("html").alias("flavor"),
        (F.col("_at") + 1).alias("table_idx"),
        M.html_grid(F.col("_html")).alias("grid"),
    )


def to_cells(tables: DataFrame, grid: str = "grid") -> DataFrame:
    """Long form, one row per cell. Header names are row -1."""
    keys = [c for c in tables.columns if c not in (grid, "md", "n_pages", "original_header")]
    rows = F.concat(F.array(F.col(grid)["header"]), F.col(grid)["rows"])
    by_row = _unnest(tables, keys, rows, "_row", "_values")
    cells = _unnest(by_row, [*keys, "_row"], F.col("_values"), "col_idx", "value")
    return cells.select(*keys, (F.col("_row") - 1).alias("row_idx"), "col_idx", "value")


def clean_tables(tables: DataFrame, min_rows: int = 2, min_cols: int = 2) -> DataFrame:
    """Clean grids; too small ones go. The old header stays in original_header."""
    return (
        tables.withColumns(
            {"original_header": F.col("grid")["header"], "grid": G.clean(F.col("grid"), min_rows, min_cols)}
        )
        .filter(F.col("grid").isNotNull())
    )


def score_tables(tables: DataFrame) -> DataFrame:
    """Both scores; ``csv_score`` is the one reported."""
    return tables.withColumns(
        {"table_score": G.table_score(F.col("grid")), "csv_score": G.csv_score(F.col("grid"))}
    )


def table_names(tables: DataFrame) -> DataFrame:
    """File stems by engine; numbers are raw positions, so skipped tables leave gaps."""
    index = F.col("table_idx")
    flavor = F.col("flavor") if "flavor" in tables.columns else F.lit(None).cast("string")
    engine = F.col("engine")
    return tables.withColumn(
        "name",
        F.when(engine == "markdown", F.format_string("page_%04d_table_%02d", F.col("page_no") + 1, index))
        .when(engine == "camelot", F.format_string("camelot_%s_%02d", F.coalesce(flavor, F.lit("lattice")), index))
        .when(flavor == "html", F.format_string("table_html_%02d", index))
        .otherwise(F.format_string("table_%02d", index)),
    )


def union_passes(lattice: DataFrame, stream: DataFrame) -> DataFrame:
    """Tables of both passes, the first before the second."""
    return lattice.withColumns({"flavor": F.lit("lattice"), "pass_no": F.lit(1)}).unionByName(
        stream.withColumns({"flavor": F.lit("stream"), "pass_no": F.lit(2)}), allowMissingColumns=True
    )


def choose_engine(
    candidates: DataFrame,
    routes: DataFrame,
    mode: str = "auto",
    prompt: str = "markdown",
    block_pages: int = BLOCK_PAGES,
) -> tuple[DataFrame, DataFrame]:
    """``cascade`` over tables that are there already: (tables of the first engine that found any, one row per document).

    Markdown tables count for documents read by OCR, under the markdown prompt.
    """

    engines = {"off": [], "auto": [e for e in fixed.TABLE_ENGINES if e != "markdown" or prompt == "markdown"]}.get(mode, [mode])
    # read by every stage, and to be parsed or cleaned once
    table = materialize(candidates) if engines else candidates

    def of_engine(engine: str) -> Stage:
        given = table.filter(F.col("engine") == engine)
        return Stage(engine, lambda docs: placed(given, docs, block_pages), ocr_only=engine == "markdown")

    default = {"off": None, "camelot": "camelot"}.get(mode, "docling")
    served, chosen = cascade(routes, [of_engine(e) for e in engines], default, write=False)
    return candidates.limit(0) if served is None else served, chosen


@dataclass(frozen=True)
class Stage:
    """One step of a cascade: ``find`` gives the tables of the documents (doc_id, n_pages) that it is asked for."""

    engine: str
    find: Callable[[DataFrame], DataFrame]
    ocr_only: bool = False


def placed(tables: DataFrame, docs: DataFrame, block_pages: int = BLOCK_PAGES) -> DataFrame:
    """Tables of ``docs`` (doc_id, n_pages) with the block that they belong to; one without a page number is in the first."""
    own = F.coalesce(F.floor(F.col("page_no") / block_pages).cast("int"), F.lit(0))
    last = F.greatest(F.lit(0), F.floor((F.col("n_pages") - 1) / block_pages)).cast("int")
    joined = tables.drop("n_pages", "block").join(docs.select("doc_id", "n_pages"), "doc_id")
    return joined.withColumn("block", F.least(own, last))


def cascade(
    routes: DataFrame, stages: list[Stage], default: str | None = "docling", write: bool = True
) -> tuple[DataFrame | None, DataFrame]:
    """(tables of the first stage that found any, one row per document with its engine and count).

    Every stage is asked for the documents that none before it served, so nothing is parsed for the
    others. What a stage finds is written once, unless ``write`` is off, for stages that only read a
    table. Documents without any table get the ``default`` engine.
    """
    pages = F.col("n_pages") if "n_pages" in routes.columns else F.col("num_pages")
    docs = rest = routes.select("doc_id", "routed", pages.alias("n_pages"))
    served, counted = [], []
    for stage in stages:
        asked = rest.filter(F.col("routed") == "ocr") if stage.ocr_only else rest
        found = stage.find(asked.select("doc_id", "n_pages")).withColumn("engine", F.lit(stage.engine))
        found = materialize(found) if write else found
        counts = found.groupBy("doc_id").agg(F.count(F.lit(1)).alias("count"))
        served.append(found)
        counted.append(counts.withColumn("engine", F.lit(stage.engine)))
        rest = rest.join(counts.select("doc_id"), "doc_id", "left_anti")
    if not served:
        none = docs.select("doc_id", "n_pages", F.lit(default).cast("string").alias("engine"), F.lit(0).cast("bigint").alias("count"))
        return None, none
    tables = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), served)
    best = reduce(DataFrame.unionByName, counted)
    chosen = docs.join(best, "doc_id", "left").select(
        "doc_id", "n_pages", F.coalesce("engine", F.lit(default)).alias("engine"), F.coalesce("count", F.lit(0)).cast("bigint").alias("count")
    )
    return tables, chosen


def _item_order(tables: DataFrame) -> list[str]:
    return [c for c in ("pass_no", "page_no", "table_idx") if c in tables.columns]


def best_table(scored: DataFrame) -> DataFrame:
    """The best table of each document: highest score, first among equals.

    A minimum over a small struct, so it folds before the shuffle.
    """
    order = F.struct((-F.col("csv_score")).alias("cost"), *_item_order(scored), "name")
    return (
        scored.filter(F.col("csv_score") > 0)
        .groupBy("doc_id")
        .agg(F.min(order).alias("_best"))
        .select(
            "doc_id",
            F.concat("_best.name", F.lit(".csv")).alias("best_csv"),
            F.bround(-F.col("_best.cost"), 3).alias("best_score"),
        )
    )


def table_meta(
    named: DataFrame,
    chosen: DataFrame,
    best: DataFrame,
    block_pages: int = BLOCK_PAGES,
    errors: DataFrame | None = None,
) -> DataFrame:
    """``tables`` per document part: engine, count, items in order, best table.

    The items of a long document are listed in the part of their page. Pages
    are counted from 1, or as the layout engine numbers them; a table without a
    page keeps none. ``errors`` (doc_id, engine, error) tells of engines that
    failed: the error stands with the engine that it struck, if no other engine
    found tables.
    """
    if errors is not None:
        struck = errors.groupBy("doc_id", "engine").agg(F.min("error").alias("_error"))
        chosen = chosen.join(struck, ["doc_id", "engine"], "left").withColumn("_error", F.when(F.col("count") == 0, F.col("_error")))
    else:
        chosen = chosen.withColumn("_error", F.lit(None).cast("string"))
    stem = F.col("name")
    is_md, is_grid = F.col("engine") == "markdown", F.col("engine") == "camelot"
    item = F.struct(
        F.when(is_md | is_grid, F.col("page_no") + 1).otherwise(F.col("page_no")).cast("int").alias("page"),
        F.when(~is_md & ~is_grid, F.concat(stem, F.lit(".html"))).alias("path_html"),
        F.concat(stem, F.lit(".csv")).alias("path_csv"),
        F.when(is_md, F.concat(stem, F.lit(".md"))).alias("path_md"),
    )
    blocked = named if "block" in named.columns else with_block(named, block_pages)
    items = blocked.groupBy("doc_id", "block").agg(
        F.sort_array(F.collect_list(F.struct(*_item_order(named), item.alias("item")))).alias("_items")
    )
    docs = spread(chosen.join(best, "doc_id", "left"), block_pages)
    return docs.join(items, ["doc_id", "block"], "left").select(
        "doc_id",
        F.col("block").alias("part_no"),
        F.struct(
            "engine",
            F.col("_error").alias("error"),
            F.col("count").cast("bigint").alias("count"),
            F.coalesce("_items.item", empty_table_meta()["items"]).alias("items"),
            "best_csv",
            "best_score",
        ).alias("tables"),
    )
