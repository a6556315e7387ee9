"""Batch sources: files, HTML and markdown page tables, user extractors."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.operators.identity import content_id
from folioworks.sources.source import FileBytes, listed, open_system


def _any_case(suffix: str) -> str:
    return "".join(f"[{c.lower()}{c.upper()}]" if c.isalpha() else c for c in suffix)


def read_files(spark: SparkSession, root: str, suffix: str = ".pdf") -> DataFrame:
    """Files below ``root`` with the suffix, in any case, with their bytes.

    Listing alone does not read the contents. No file at all is an error.
    Files of 2 GiB and more are beyond the binaryFile source; ``discover`` takes them.
    """
    files = (
        spark.read.format("binaryFile")
        .option("recursiveFileLookup", True)
        .option("pathGlobFilter", f"*{_any_case(suffix)}")
        .load(root)
    )
    if files.select("path").isEmpty():
        raise FileNotFoundError(f"no *{suffix} files in {root}")
    return files


def discover(spark: SparkSession, root: str, suffix: str = ".pdf", **options) -> DataFrame:
    """path, name, length, modified, sha256 and ``doc_id`` of the files below ``root``, of any size.

    Hashes are taken in pieces by the tasks, so no file is held whole. No file at all is an error.
    """
    if not listed(root, suffix):
        raise FileNotFoundError(f"no *{suffix} files in {root}")
    spark.dataSource.register(FileBytes)
    found = spark.read.format("file_bytes").options(path=root, suffix=suffix, **options).load()
    return found.withColumn("doc_id", F.substring("sha256", 1, 16))


def stream_files(spark: SparkSession, root: str, log: str, suffix: str = ".pdf", **options) -> DataFrame:
    """The same of arriving files, as a stream. ``log`` is the folder in which it keeps what it has seen; see ``source``."""
    spark.dataSource.register(FileBytes)
    found = spark.readStream.format("file_bytes").options(path=root, suffix=suffix, log=log, **options).load()
    return found.withColumn("doc_id", F.substring("sha256", 1, 16))


def file_ranges(spark: SparkSession, root: str, suffix: str = "", **options) -> DataFrame:
    """path, name, length, offset, content: the bytes of the files in pieces of ``chunkBytes``."""
    spark.dataSource.register(FileBytes)
    return spark.read.format("file_bytes").options(path=root, suffix=suffix, mode="ranges", **options).load()


def with_file_id(files: DataFrame) -> DataFrame:
    return files.withColumn("doc_id", content_id("content"))


def html_pages(df: DataFrame, doc_id: str, html: str) -> DataFrame:
    """HTML documents as one-page documents."""
    return df.select(
        F.col(doc_id).alias("doc_id"),
        F.lit(0).alias("page_no"),
        F.lit(1).alias("n_pages"),
        F.coalesce(html, F.lit("")).alias("html"),
    )


def markdown_pages(pages: DataFrame, mode: str) -> DataFrame:
    """OCR pages as markdown; none unless the prompt asked for markdown."""
    return pages if mode == "markdown" else pages.filter(F.lit(False))


#: Page rows that an extractor task hands on at once, at most.
PIECE_ROWS = 1000
PAGE_SCHEMA = "doc_id string, page_no int, n_pages int, text string, error string"


def extract_with(files: DataFrame, make_extractor: Callable[[], Callable[[bytes], list]]) -> DataFrame:
    """Page rows from file contents by a user's extractor.

    ``files`` has ``doc_id, content``. ``make_extractor`` is called once per
    task, so a model is loaded once there. A document it fails on gives one row
    with ``error`` and no text, and one without pages a row with ``n_pages`` 0
    and an empty text; all others go on. Pages leave a task in pieces of
    ``PIECE_ROWS``. A batch holds whole files: for large ones set
    ``spark.sql.execution.arrow.maxRecordsPerBatch`` to what a task can hold.
    """

    def run(batches: Iterator) -> Iterator:
        import pandas as pd

        def frame(rows: list) -> pd.DataFrame:
            out = pd.DataFrame(rows, columns=["doc_id", "page_no", "n_pages", "text", "error"])
            return out.astype({"page_no": "Int32", "n_pages": "Int32"})

        extract = make_extractor()
        for batch in batches:
            rows = []
            for doc_id, content in zip(batch["doc_id"], batch["content"]):
                try:
                    texts = list(extract(bytes(content)))
                    pages = [(doc_id, i, len(texts), t or "", None) for i, t in enumerate(texts)]
                    rows += pages or [(doc_id, 0, 0, "", None)]
                except Exception as e:  # one document's failure is data
                    rows.append((doc_id, None, None, None, f"{type(e).__name__}: {e}"))
                while len(rows) >= PIECE_ROWS:
                    yield frame(rows[:PIECE_ROWS])
                    rows = rows[PIECE_ROWS:]
            yield frame(rows)

    return files.select("doc_id", "content").mapInPandas(run, PAGE_SCHEMA)


#: Bytes of page texts that a task hands on at once, about.
PIECE_BYTES = 8 << 20
FILE_PAGES = "doc_id string, page_no int, text string, error string"


def extract_files(found: DataFrame, make_extractor: Callable[[], Callable[[object], Iterator[str]]]) -> DataFrame:
    """Page rows (FILE_PAGES) from files of any size by a user's extractor.

    ``found`` has ``doc_id`` and ``path``, as ``discover`` gives them; its rows are short whatever the
    size of the files. ``make_extractor`` is called once per task and returns a function from an open
    binary file to its pages, which may yield them one by one: neither the file nor its pages are
    held whole. Pages leave the task in pieces of ``PIECE_BYTES``. A document it fails on gives a row with
    ``error`` and no page number, after the pages read so far; ``ingest_run`` leaves such documents out.
    A file without pages gives one empty page.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        extract = make_extractor()
        schema = pa.schema([("doc_id", pa.string()), ("page_no", pa.int32()), ("text", pa.string()), ("error", pa.string())])

        def piece(rows: list) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [()] * 4
            return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)

        def pages(doc_id: str, path: str) -> Iterator[tuple]:
            at = 0
            try:
                system, place = open_system(path)
                with system.open_input_file(place) as f:
                    for text in extract(f):
                        yield doc_id, at, text or "", None
                        at += 1
            except Exception as e:  # one document's failure is data
                yield doc_id, None, None, f"{type(e).__name__}: {e}"
            else:
                if not at:
                    yield doc_id, 0, "", None

        for batch in batches:
            rows, held = [], 0
            for doc_id, path in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                for row in pages(doc_id, path):
                    rows.append(row)
                    held += 64 + 4 * len(row[2] or "")
                    if held >= PIECE_BYTES:
                        yield piece(rows)
                        rows, held = [], 0
            yield piece(rows)

    return found.select(F.col("doc_id").cast("string").alias("doc_id"), "path").mapInArrow(run, FILE_PAGES)


def split_extracted(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(page table, error table) of ``extract_with`` or ``extract_files``."""
    failed = F.col("error").isNotNull()
    return rows.filter(~failed).drop("error"), rows.filter(failed).select("doc_id", "error")
