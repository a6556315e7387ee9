"""From clean pages to documents: offsets, parts, bundles, summaries."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioworks.functions.text import token_count
from folioworks.operators.blocks import BLOCK_PAGES, gather, spread
from folioworks.session import materialize, shuffles_deleted


def _offsets(sizes: Column) -> Column:
    """Running sum before each entry."""
    start = F.struct(F.array().cast("array<bigint>").alias("out"), F.lit(0).cast("bigint").alias("at"))
    return F.aggregate(
        sizes,
        start,
        lambda acc, n: F.struct(
            F.concat(acc["out"], F.array(acc["at"])).alias("out"), (acc["at"] + n).alias("at")
        ),
        lambda acc: acc["out"],
    )


SPAN_PARTS = 4096


def _with_earlier_parts(parts: DataFrame, span: int = SPAN_PARTS) -> DataFrame:
    """What each part of a long document needs to know of the parts before it.

    From narrow rows ``doc_id, block, _chars, _closes`` (null for an empty
    part): ``_start``, where the part starts, and ``_before``, the last
    ``_closes`` ahead of it. Parts fall into spans, so that a window holds at
    most ``span`` parts, or one row per span.
    """
    spanned = parts.withColumn("_span", F.floor(F.col("block") / span))

    def earlier(*keys: str, order: str):
        return Window.partitionBy(*keys).orderBy(order).rowsBetween(Window.unboundedPreceding, -1)

    in_doc = earlier("doc_id", order="_span")
    spans = (
        spanned.groupBy("doc_id", "_span")
        .agg(
            F.sum("_chars").alias("_chars"),
            F.max_by("_closes", F.when(F.col("_closes").isNotNull(), F.col("block"))).alias("_closes"),
        )
        .select(
            "doc_id",
            "_span",
            F.coalesce(F.sum("_chars").over(in_doc), F.lit(0)).alias("_base"),
            F.last("_closes", ignorenulls=True).over(in_doc).alias("_carried"),
        )
    )
    in_span = earlier("doc_id", "_span", order="block")
    placed = spanned.withColumns(
        {
            "_start": F.coalesce(F.sum("_chars").over(in_span), F.lit(0)),
            "_before": F.last("_closes", ignorenulls=True).over(in_span),
        }
    )
    return placed.join(spans, ["doc_id", "_span"]).withColumns(
        {"_start": F.col("_start") + F.col("_base"), "_before": F.coalesce("_before", "_carried")}
    ).drop("_base", "_carried")


def page_offsets(pages: DataFrame, sep: str = "", block_pages: int = BLOCK_PAGES) -> DataFrame:
    """``page_offset``: where each page starts in the joined text.

    Running sums stay within a part; the sizes of earlier parts are summed over
    one row per part. Only lengths are shuffled, not texts.
    """
    sized = pages.withColumn("size", F.length(F.coalesce("text", F.lit(""))) + len(sep)).drop("text")
    parts = gather(sized, block_pages, "size").withColumn("_sizes", F.col("pages.size"))
    chars = F.aggregate("_sizes", F.lit(0).cast("bigint"), lambda a, b: a + b)
    long_parts = parts.filter(F.col("n_pages") > block_pages)
    starts = _with_earlier_parts(
        long_parts.select("doc_id", "block", chars.alias("_chars"), F.lit(None).cast("boolean").alias("_closes"))
    ).select("doc_id", "block", "_start")
    placed = parts.withColumn("_offsets", _offsets(F.col("_sizes"))).join(starts, ["doc_id", "block"], "left")
    rows = placed.select(
        "doc_id", "n_pages", "_start", F.inline_outer(F.arrays_zip(F.col("pages.page_no").alias("page_no"), F.col("_offsets").alias("at")))
    )
    return rows.select(
        "doc_id", "page_no", "n_pages", (F.col("at") + F.coalesce("_start", F.lit(0))).cast("bigint").alias("page_offset")
    )


def concat_parts(parts: DataFrame, sep: str = "", block_pages: int = BLOCK_PAGES, write: bool = False, long: bool = True) -> DataFrame:
    """Clean parts as text: one row per document, or per part of a long one.

    A document of up to ``block_pages`` pages is one row with ``part_no`` 0 and
    the whole text. ``page_offsets`` and ``token_count`` count over the whole
    document in every part; parts join by plain concatenation. ``write`` has the texts
    written once: what long documents need of all their parts is read several times, and
    each time the texts would be cleaned again. A page whose text is its slice is written once.
    ``long`` says whether there may be such documents.
    """
    last_block = F.floor((F.col("n_pages") - 1) / block_pages)
    tail = F.when(F.col("block") < last_block, F.lit(sep)).otherwise(F.lit(""))

    def joined(texts: Column) -> Column:
        return F.concat(F.array_join(texts, sep), tail).alias("text")

    own = F.transform("pages", lambda p: F.when(p["text"] != p["slice"], p["text"]))
    texts = parts.select(
        "doc_id",
        "n_pages",
        "block",
        (last_block + 1).cast("int").alias("n_parts"),
        joined(F.col("pages.text")),
        F.col("pages.slice").alias("page_slices"),
        *([own.alias("_own")] if write else []),
        _offsets(F.transform("pages", lambda p: F.length(p["text"]) + len(sep))).alias("_offsets"),
    ).withColumn("_tokens", token_count(F.col("text")))
    texts = texts.withColumns(_part_facts())
    if write:
        with shuffles_deleted(texts.sparkSession):
            texts = materialize(texts.drop("text"), compression="zstd")
        text = joined(F.zip_with("page_slices", "_own", lambda slice, own: F.coalesce(own, slice)))
        texts = texts.withColumn("text", text).drop("_own")
    if long:
        totals = _long_document_totals(texts.filter(F.col("n_pages") > block_pages))
        texts = texts.join(totals, ["doc_id", "block"], "left")
    else:
        texts = texts.withColumns({c: F.lit(None).cast("bigint") for c in ("_start", "_doc_tokens")})
    return texts.select(
        "doc_id",
        "n_pages",
        F.col("block").alias("part_no"),
        "n_parts",
        "text",
        "page_slices",
        F.transform("_offsets", lambda o: o + F.coalesce("_start", F.lit(0))).alias("page_offsets"),
        F.coalesce("_doc_tokens", "_tokens").cast("bigint").alias("token_count"),
    )


def _part_facts() -> dict[str, Column]:
    """Characters of a part, and whether it opens and closes with a word character (null if empty)."""
    word, filled = "[A-Za-z0-9_]", F.col("text") != ""
    return {
        "_chars": F.length("text"),
        "_opens": F.when(filled, F.col("text").rlike(rf"\A{word}")),
        "_closes": F.when(filled, F.col("text").rlike(rf"{word}\z")),
    }


def _long_document_totals(parts: DataFrame, span: int = SPAN_PARTS) -> DataFrame:
    """Start of each part and token count of the document, for long ones.

    A word run over the seam of two parts is one token, not two. Works on one
    narrow row per part.
    """
    facts = parts if "_chars" in parts.columns else parts.withColumns(_part_facts())
    placed = _with_earlier_parts(facts.select("doc_id", "block", "_chars", "_tokens", "_opens", "_closes"), span)
    own = F.col("_tokens") - F.when(F.col("_opens") & F.col("_before"), 1).otherwise(0)
    totals = placed.groupBy("doc_id").agg(F.sum(own).alias("_doc_tokens"), F.max("_span").alias("_last"))
    per_span = totals.select("doc_id", "_doc_tokens", F.explode(F.sequence(F.lit(0).cast("bigint"), "_last")).alias("_span"))
    return placed.join(per_span, ["doc_id", "_span"]).select("doc_id", "block", "_start", "_doc_tokens")


def empty_table_meta() -> Column:
    item = "struct<page:int,path_html:string,path_csv:string,path_md:string>"
    return F.struct(
        F.lit(None).cast("string").alias("engine"),
        F.lit(None).cast("string").alias("error"),
        F.lit(0).cast("bigint").alias("count"),
        F.array().cast(f"array<{item}>").alias("items"),
        F.lit(None).cast("string").alias("best_csv"),
        F.lit(None).cast("double").alias("best_score"),
    )


def bundle(
    parts: DataFrame,
    routes: DataFrame,
    languages: DataFrame | None = None,
    tables: DataFrame | None = None,
    block_pages: int = BLOCK_PAGES,
) -> DataFrame:
    """One nested record per document (per part of a long one).

    A document of ``routes`` without any page comes out empty. ``routes``:
    doc_id, n_pages (of the chosen source), num_pages, text_pages, text_page_ratio, routed,
    route_reason. ``languages``: doc_id, language. ``tables``: doc_id, part_no,
    tables (see ``operators.tables.table_meta``).
    """
    facts = routes.select(
        "doc_id",
        "n_pages",
        F.struct("num_pages", "text_page_ratio", F.col("text_pages").alias("text_pages_sampled")).alias("_probe"),
        "route_reason",
        "router",
        F.col("routed").alias("_routed"),
    )
    if languages is not None:
        facts = facts.join(languages.select("doc_id", "language"), "doc_id", "left")
    else:
        facts = facts.withColumn("language", F.lit("unknown"))
    per_part = spread(facts, block_pages).withColumnRenamed("block", "part_no").drop("n_pages")
    joined = per_part.join(parts, ["doc_id", "part_no"], "left")
    if tables is not None:
        joined = joined.join(tables.select("doc_id", "part_no", "tables"), ["doc_id", "part_no"], "left")
    else:
        joined = joined.withColumn("tables", empty_table_meta())
    return joined.select(
        "doc_id",
        "part_no",
        F.coalesce("n_parts", F.lit(1)).alias("n_parts"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce("page_slices", F.array().cast("array<string>")).alias("page_slices"),
        F.coalesce("page_offsets", F.array().cast("array<bigint>")).alias("page_offsets"),
        F.col("_routed").alias("routed"),
        F.coalesce("language", F.lit("unknown")).alias("language"),
        F.struct(
            F.col("_probe").alias("probe"),
            "route_reason",
            "router",
            F.coalesce("token_count", F.lit(0).cast("bigint")).alias("token_count"),
            F.coalesce("tables", empty_table_meta()).alias("tables"),
        ).alias("meta"),
    )


def text_fingerprint() -> Column:
    """What the pages of a bundle row add to the fingerprint of its document.

    Each page gives 60 bits of SHA-256 over its place in the document's text and
    the text from there to the next page; the sum over all pages of a document
    is the same for every ``block_pages`` and every order.
    """
    first = F.get("page_offsets", F.lit(0))
    ends = F.concat(F.slice("page_offsets", 2, F.size("page_offsets")), F.array(first + F.length("text")))
    spans = F.filter(F.arrays_zip(F.col("page_offsets").alias("a"), ends.alias("b")), lambda s: s["a"].isNotNull())

    def bits(s: Column) -> Column:
        piece = F.substr(F.col("text"), (s["a"] - first + 1).cast("int"), (s["b"] - s["a"]).cast("int"))
        place = F.concat(s["a"].cast("string"), F.lit(":"), piece)
        return F.conv(F.substring(F.sha2(place, 256), 1, 15), 16, 10).cast("decimal(38,0)")

    zero = F.lit(0).cast("decimal(38,0)")
    return F.aggregate(F.transform(spans, bits), zero, lambda a, v: (a + v).cast("decimal(38,0)"))


def summary(bundles: DataFrame, out: str = "", *more: Column, fingerprint: bool = False) -> DataFrame:
    """One row per document; facts of the document stand in its first part.

    ``more`` are further columns to take from the first part. ``fingerprint``
    adds one of the whole text, summed over all parts.
    """
    base = f"{out.rstrip('/')}/" if out else ""
    first = bundles.filter(F.col("part_no") == 0).select(
        "doc_id",
        F.concat(F.lit(base), "doc_id").alias("out"),
        "routed",
        "language",
        F.col("meta.token_count").alias("token_count"),
        *more,
    )
    if not fingerprint:
        return first
    marks = bundles.groupBy("doc_id").agg(F.sum(text_fingerprint()).cast("string").alias("text_fingerprint"))
    return first.join(marks, "doc_id")


def to_docmeta(bundles: DataFrame) -> DataFrame:
    """The metadata record as JSON text; nulls are written."""
    record = F.struct("doc_id", "part_no", "routed", "language", "page_offsets", "meta")
    return bundles.select(
        "doc_id", "part_no", F.to_json(record, {"ignoreNullFields": "false"}).alias("docmeta")
    )


def page_files(pages: DataFrame) -> DataFrame:
    """Saved page texts with their 1-based names."""
    text = "slice" if "slice" in pages.columns else "text"
    return pages.select(
        "doc_id", F.format_string("%04d.txt", F.col("page_no") + 1).alias("name"), F.col(text).alias("text")
    )
