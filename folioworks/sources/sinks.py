"""Batch sinks."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.config import EngineConfig
from folioworks.functions import grid as G
from folioworks.operators.assembly import page_files, to_docmeta
from folioworks.operators.blocks import BLOCK_PAGES, prepare
from folioworks.sources.exact import write_files


def write_documents(bundles: DataFrame, path: str) -> None:
    """Bundles as parquet: the form to keep a large corpus in."""
    bundles.write.mode("overwrite").parquet(path)


def _text_name(name: str, parts: Column) -> Column:
    """``name`` of a document of one part; ``stem-00000.ext`` and so on of a longer one."""
    stem, ext = name.rsplit(".", 1)
    part = F.format_string(f"{stem}-%05d.{ext}", F.col("part_no"))
    return F.concat_ws("/", F.col("doc_id").cast("string"), F.when(parts > 1, part).otherwise(F.lit(name)))


def text_files(bundles: DataFrame) -> DataFrame:
    """``<doc_id>/text.txt`` with exactly the text; a long document has one file per part."""
    return bundles.select(_text_name("text.txt", F.col("n_parts")).alias("name"), F.col("text").alias("content"))


def docmeta_files(bundles: DataFrame) -> DataFrame:
    """``<doc_id>/docmeta.json``."""
    made = to_docmeta(bundles).join(bundles.select("doc_id", "part_no", "n_parts"), ["doc_id", "part_no"])
    return made.select(_text_name("docmeta.json", F.col("n_parts")).alias("name"), F.col("docmeta").alias("content"))


def page_text_files(pages: DataFrame) -> DataFrame:
    """``<doc_id>/page_text/0001.txt`` and so on."""
    return page_files(pages).select(F.concat_ws("/", F.col("doc_id").cast("string"), F.lit("page_text"), "name").alias("name"), F.col("text").alias("content"))


def table_files(named: DataFrame) -> DataFrame:
    """``<doc_id>/tables/<name>`` as csv, html and md; tables of several pages have the page in their folder."""
    folder = F.concat_ws("/", F.col("doc_id").cast("string"), F.lit("tables"))
    kinds = F.array(*[F.struct(F.lit(k).alias("kind"), F.col(k).alias("content")) for k in ("csv", "html", "md")])
    files = render_tables(named).select(folder.alias("folder"), "page_no", "name", F.explode(kinds).alias("f"))
    page = F.when(F.col("name").startswith("table_") & F.col("page_no").isNotNull(), F.format_string("page_%04d", F.col("page_no") + 1))
    return files.select(F.concat(F.concat_ws("/", "folder", page, "name"), F.lit("."), "f.kind").alias("name"), F.col("f.content").alias("content"))


def export(bundles: DataFrame, path: str, cfg: EngineConfig = EngineConfig(), tables: DataFrame | None = None) -> None:
    """The files of a run, byte for byte: texts and metadata, and what ``cfg`` asks for besides.

    ``save_pages`` adds the page texts, ``keep_records`` the full records as JSON lines in ``records``.
    """
    files = text_files(bundles).unionByName(docmeta_files(bundles))
    if cfg.save_pages:
        slices = bundles.select("doc_id", "part_no", F.posexplode("page_slices").alias("at", "text"))
        pages = slices.select("doc_id", (F.col("part_no") * cfg.block_pages + F.col("at")).alias("page_no"), "text")
        files = files.unionByName(page_text_files(pages))
    if tables is not None:
        files = files.unionByName(table_files(tables))
    write_files(files, f"{path}/files")
    if cfg.keep_records:
        write_records(bundles, f"{path}/records")


def write_text(bundles: DataFrame, path: str) -> None:
    """Texts as files that hold exactly the text (for exports; else write_documents)."""
    write_files(text_files(bundles), path)


def write_pages(pages: DataFrame, path: str) -> None:
    """Page texts with their file names, as a table."""
    page_files(pages).write.mode("overwrite").parquet(path)


def write_docmeta(bundles: DataFrame, path: str) -> None:
    """Metadata records, one JSON object per line."""
    to_docmeta(bundles).select(F.col("docmeta").alias("value")).write.mode("overwrite").text(path)


def write_records(bundles: DataFrame, path: str) -> None:
    """Full records as JSON lines."""
    bundles.write.mode("overwrite").option("ignoreNullFields", False).json(path)


def render_tables(named: DataFrame) -> DataFrame:
    """CSV, HTML and markdown text of each named table."""
    return named.select(
        "doc_id",
        "page_no",
        "name",
        G.render_csv(F.col("grid")).alias("csv"),
        G.render_html(F.col("grid")).alias("html"),
        G.render_md(F.col("grid")).alias("md"),
    )


def write_tables(named: DataFrame, path: str) -> None:
    render_tables(named).write.mode("overwrite").parquet(path)


def save_page_table(pages: DataFrame, table: str, buckets: int, block_pages: int = BLOCK_PAGES) -> None:
    """A page table bucketed by (doc_id, block): gathering it shuffles no page text."""
    (
        prepare(pages, block_pages)
        .write.mode("overwrite")
        .bucketBy(buckets, "doc_id", "block")
        .sortBy("doc_id", "block")
        .saveAsTable(table)
    )
