"""Page tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.functions.text import let


def paginate(docs: DataFrame, lines_per_page: int, text: str = "text") -> DataFrame:
    """Cut texts into pages of some lines each; null is one empty page.

    Each text is cut inside its own row, so this needs no shuffle.
    Gives the other columns of ``docs`` plus ``page_no, n_pages, text``.
    """
    k = lines_per_page
    pages = let(
        F.split(F.coalesce(F.col(text), F.lit("")), "\n", -1),
        lambda ls: F.transform(
            F.sequence(F.lit(0), F.floor((F.size(ls) - 1) / k).cast("int")),
            lambda p: F.array_join(F.slice(ls, p * k + 1, k), "\n"),
        ),
    )
    others = [c for c in docs.columns if c != text]
    cut = docs.select(*others, pages.alias("_pages"))
    # outer, since a plain explode has the optimizer evaluate the array once more
    # to filter empty ones out; there is always a page here
    return cut.select(
        *others, F.size("_pages").alias("n_pages"), F.posexplode_outer("_pages").alias("page_no", "text")
    )


def limit_pages(pages: DataFrame, n: int | None) -> DataFrame:
    """The first n pages of each document; None keeps all."""
    if n is None:
        return pages
    kept = pages.filter(F.col("page_no") < n)
    if "n_pages" in pages.columns:
        kept = kept.withColumn("n_pages", F.least("n_pages", F.lit(n)))
    return kept.drop("block")


def page_stats(pages: DataFrame) -> DataFrame:
    """Characters (and images, where the table has them) per page."""
    images = F.col("images") if "images" in pages.columns else F.lit(0)
    keys = ["doc_id", "page_no"] + (["n_pages"] if "n_pages" in pages.columns else [])
    return pages.select(
        *keys, F.length(F.coalesce("text", F.lit(""))).alias("chars"), images.cast("int").alias("images")
    )
