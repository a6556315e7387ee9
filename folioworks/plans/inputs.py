"""Inputs of the registered queries: page tables derived from the given tables.

The given texts have no page furniture, so it is added by expressions that the
reference SQL repeats word for word. Every table is used whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.operators.paging import paginate
from folioworks.session import file_size

LINES_PER_PAGE = 3
PARTS_PER_PAGE = 250
#: Bytes of a given file that one task takes, about; texts grow several times over when they are unpacked and decorated.
TASK_BYTES = 16 << 20


def read_table(spark: SparkSession, sf_dir: str, name: str, key: str) -> DataFrame:
    """A given table. One with fewer files than cores is spread by ``key``, with no more than some ``TASK_BYTES`` to a task."""
    df = spark.read.parquet(f"{sf_dir}/{name}.parquet")
    cores, files = spark.sparkContext.defaultParallelism, df.inputFiles()
    return df if len(files) >= cores else df.repartition(tasks_for(sum(file_size(spark, f) for f in files), cores), key)


def tasks_for(size: int, cores: int) -> int:
    return max(cores, -(-size // TASK_BYTES))


def documents(spark: SparkSession, sf_dir: str, *columns: str) -> DataFrame:
    return read_table(spark, sf_dir, "documents", "doc_id").select("doc_id", *columns)


def text_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents cut into pages of three lines."""
    return paginate(documents(spark, sf_dir, "source", "text"), LINES_PER_PAGE)


def decorate(pages: DataFrame) -> DataFrame:
    """Pages with header, footer, list marks, labels and broken lines."""
    text = F.col("text")
    body = F.replace(text, F.lit(" the "), F.lit(" the\n"))
    body = F.replace(body, F.lit("tion "), F.lit("ti-\non "))
    number = F.col("page_no").cast("string")
    return pages.withColumn(
        "text",
        F.concat_ws(
            "\n",
            F.concat(F.lit("ACME Quarterly "), "source"),
            body,
            F.concat(F.lit("• item "), number),
            F.lit("[x] done"),
            F.lit("[ ] todo"),
            F.concat(F.lit("Page "), (F.col("page_no") + 1).cast("string"), F.lit(" of "), F.col("n_pages").cast("string")),
            number,
            F.lit(""),
            F.lit(""),
            F.lit(""),
            F.lit("Confidential do not distribute"),
        ),
    )


def decorated_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decorate(text_pages(spark, sf_dir)).select("doc_id", "page_no", "n_pages", "text")


def scanned(number: Column, text: Column) -> Column:
    """Native text as a scan shows it: none, or next to none on every other page."""
    return (
        F.when(number % 4 == 0, "")
        .when((number % 4 == 1) & (F.col("page_no") % 2 == 0), "x")
        .otherwise(text)
    )


def routed_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages with native text and the texts two OCR engines gave."""
    text, doc = F.col("text"), F.col("doc_id")
    return text_pages(spark, sf_dir).select(
        "doc_id",
        "page_no",
        "n_pages",
        scanned(doc, text).alias("native_text"),
        F.when((doc % 7 == 0) & (F.col("page_no") == 1), F.lit(None).cast("string"))
        .when(doc % 5 == 0, "")
        .otherwise(text)
        .alias("ocr_text"),
        F.when(doc % 5 == 0, text).alias("ocr_markdown"),
        F.lit("").alias("ocr_output"),
        F.when(doc % 11 == 0, F.lit(None).cast("string")).otherwise(text).alias("checked_text"),
        text.alias("fallback_text"),
    )


def native_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return routed_pages(spark, sf_dir).select("doc_id", "page_no", "n_pages", F.col("native_text").alias("text"))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Parts with the texts of their table cells; a page holds 250 keys of one brand."""
    price = F.col("p_retailprice").cast("decimal(12,2)").cast("string")
    return read_table(spark, sf_dir, "part", "p_partkey").select(
        F.col("p_brand").alias("doc_id"),
        F.floor(F.col("p_partkey") / PARTS_PER_PAGE).cast("int").alias("page_no"),
        "p_partkey",
        "p_name",
        "p_type",
        F.when(F.col("p_partkey") % 6 != 0, F.col("p_size").cast("string")).alias("size"),
        F.replace(price, F.lit("."), F.lit(",")).alias("price"),
    )


def _by_page(parts: DataFrame, row: Column) -> DataFrame:
    """Rows of each page in key order; a page has at most 250."""
    return (
        parts.groupBy("doc_id", "page_no")
        .agg(F.sort_array(F.collect_list(F.struct("p_partkey", row.alias("row")))).alias("_rows"))
        .select("doc_id", "page_no", F.col("_rows.row").alias("rows"))
    )


def pipe_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markdown pages with three pipe tables each, one of them without body."""
    cells = [F.col("p_name"), F.col("p_type"), F.coalesce("size", F.lit("")), F.col("price"), F.lit("")]
    row = F.concat(F.lit("| "), F.concat_ws(" | ", *cells), F.lit(" |"))
    pages = _by_page(_parts(spark, sf_dir), row)
    text = F.concat_ws(
        "\n",
        F.concat(F.lit("Catalogue of "), "doc_id"),
        F.lit(""),
        F.lit("| Name | Type | Size | Price | Note |"),
        F.lit("|---|---|---:|---|---|"),
        F.array_join("rows", "\n"),
        F.lit("Text between tables"),
        F.lit("| Brand | Page |"),
        F.lit("|:--|:-:|"),
        F.lit("More text"),
        F.lit("| Brand | Rows |"),
        F.lit("|---|---|"),
        F.concat(F.lit("| "), "doc_id", F.lit(" | "), F.size("rows").cast("string"), F.lit(" |")),
    )
    return pages.select("doc_id", "page_no", text.alias("text"))


def html_table_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML pages with a headed table and a table with one cell down all rows."""
    name = F.col("p_name")
    row = F.struct(
        F.concat(
            F.lit("<tr><td> <b>"), name, F.lit("</b></td><td>"), "p_type", F.lit("<br/>&amp; more</td><td>"),
            F.coalesce("size", F.lit("N/A")), F.lit("</td></tr>"),
        ).alias("full"),
        F.concat(F.lit("<td>"), name, F.lit("</td></tr>")).alias("short"),
    )
    pages = _by_page(_parts(spark, sf_dir), row)
    count = F.size("rows").cast("string")
    html = F.concat(
        F.lit("<html><body><!-- <table><tr><td>hidden</td></tr></table> --><h1>"), F.col("doc_id"),
        F.lit('</h1><table class="a">\n<tr><th>Name</th><th>Type &lt;x&gt;</th><th>Size</th></tr>\n'),
        F.array_join(F.col("rows.full"), "\n"),
        F.lit('</table><p>between</p><TABLE><tr><td rowspan="'), count, F.lit('">'), F.col("doc_id"), F.lit("</td>"),
        F.array_join(F.col("rows.short"), "<tr>"),
        F.lit("</TABLE></body></html>"),
    )
    return pages.select("doc_id", "page_no", html.alias("html"))


def nested_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """HTML pages with a table inside a cell of another one, and a third after both."""
    row = F.concat(F.lit("<tr><td>"), "p_name", F.lit("</td><td>"), "p_type", F.lit("</td></tr>"))
    html = F.concat(
        F.lit("<table><tr><th>Key</th><th>Held</th></tr><tr><td>"), F.col("doc_id"),
        F.lit("</td><td>before <TABLE class='in'>"), F.array_join("rows", ""), F.lit("</TABLE > after</td></tr><tr><td>last</td><td>"),
        F.size("rows").cast("string"), F.lit("</td></tr></table><p>between</p><table><tr><td>"), F.col("page_no").cast("string"), F.lit("</td></tr>"),
    )
    return _by_page(_parts(spark, sf_dir), row).select("doc_id", "page_no", html.alias("html"))


def raw_grids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tables as a layout engine gives them: blank rows, stray spaces, decimal commas.

    Pages 0, 3, 6, ... open with a header row; on pages 2, 5, 8, ... no word of
    the first row is capitalised. Table 2 of a page is too small to keep.
    """
    page = F.col("page_no")
    kind = F.when(page % 3 == 2, F.lower("p_type")).otherwise(F.col("p_type"))
    nothing = F.lit(None).cast("string")
    row = F.array(F.concat(F.lit("  "), "p_name", F.lit("\t")), kind, F.col("size"), F.col("price"), nothing)
    pages = _by_page(_parts(spark, sf_dir), row)
    blank = F.array(F.array_repeat(nothing, 5))
    head = F.array(F.array(*[F.lit(v) for v in ("  Name ", "Type", "Size \n (mm)", "Price")], nothing))
    no_rows = F.array().cast("array<array<string>>")
    main = F.struct(
        F.lit(1).alias("table_idx"),
        F.struct(
            F.array(*[F.lit(str(i)) for i in range(5)]).alias("header"),
            F.concat(blank, F.when(page % 3 == 0, head).otherwise(no_rows), "rows").alias("rows"),
        ).alias("grid"),
    )
    small = F.struct(
        F.lit(2).alias("table_idx"),
        F.struct(
            F.array(F.lit("0"), F.lit("1")).alias("header"),
            F.array(F.array(F.col("doc_id"), F.size("rows").cast("string"))).alias("rows"),
        ).alias("grid"),
    )
    return pages.select("doc_id", "page_no", F.explode(F.array(main, small)).alias("t")).select(
        "doc_id", "page_no", "t.table_idx", "t.grid"
    )
