"""Pages that arrive one by one, put together when all of a part have come.

State is kept per part of a document, (doc_id, part_no): the texts of the pages seen, the
number of pages that the document says it has, and the number of forms put out. A part comes
out in the batch that brings its last page, whatever the order and however long that takes. A
page that arrives again with another text, or after the part was given up on, brings it
out again with a higher ``version``; the same page again changes nothing. Nothing is
ever late: no watermark is needed. A new page rewrites the state
of that page only, in RocksDB, outside the executors' heaps; timers run on the clock of the cluster.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from folioworks.operators.blocks import BLOCK_PAGES

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PARTS = (
    "doc_id string, part_no int, version int, complete boolean, n_pages int, page_nos array<int>, page_texts array<string>"
)
DAY = 24 * 3600 * 1000


class PartAssembler(StatefulProcessor):
    """One part: a map of its pages; the document's number of pages, pages held, forms put out, the timer, and whether a form is out.

    After ``give_up`` milliseconds without a page an incomplete part comes out as it is;
    ``forget`` milliseconds after a form came out its state goes.
    """

    def __init__(self, block_pages: int, give_up: int, forget: int):
        self.block_pages, self.give_up, self.forget = block_pages, give_up, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.pages = handle.getMapState("pages", "page_no int", "text string")
        self.facts = handle.getValueState("facts", "n_pages int, held int, version int, timer bigint, given boolean")

    def _facts(self) -> list:
        return list(self.facts.get()) if self.facts.exists() else [None, 0, 0, None, False]

    def _keep(self, n: int | None, held: int, version: int, old_timer: int | None, given: bool, now: int) -> None:
        if old_timer is not None:
            self.handle.deleteTimer(old_timer)
        timer = now + (self.forget if given else self.give_up)
        self.handle.registerTimer(timer)
        self.facts.update((n, held, version, timer, given))

    def _form(self, key: tuple, n: int | None, version: int, complete: bool) -> Row:
        held = sorted((k[0], v[0]) for k, v in self.pages.iterator())
        return Row(
            doc_id=key[0], part_no=key[1], version=version, complete=complete, n_pages=n,
            page_nos=[p for p, _ in held], page_texts=[t for _, t in held],
        )

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:  # noqa: N802, N803
        n, held, version, timer, _ = self._facts()
        changed = False
        for row in rows:
            if row.n_pages is not None and (n is None or row.n_pages > n):
                n, changed = row.n_pages, True
            if row.page_no is None:
                continue
            known, text = self.pages.containsKey((row.page_no,)), row.text or ""
            if not known or self.pages.getValue((row.page_no,))[0] != text:
                self.pages.updateValue((row.page_no,), (text,))
                held, changed = held + (not known), True
        if not changed:
            return
        # Of the last part, what is left over; a page beyond the number given counts as one more.
        whole = n is not None and held >= max(0, min(self.block_pages, n - key[1] * self.block_pages))
        version += whole
        self._keep(n, held, version, timer, whole, timerValues.getCurrentProcessingTimeInMs())
        if whole:
            yield self._form(key, n, version, True)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:  # noqa: N802, N803
        n, held, version, _, given = self._facts()
        if given:
            self.pages.clear()
            self.facts.clear()
            return
        self._keep(n, held, version + 1, None, True, timerValues.getCurrentProcessingTimeInMs())
        yield self._form(key, n, version + 1, False)

    def close(self) -> None:
        pass


def assemble_pages(pages: DataFrame, block_pages: int = BLOCK_PAGES, give_up: int = 30 * DAY, forget: int = 30 * DAY) -> DataFrame:
    """Parts (PARTS) of a stream of pages ``doc_id, page_no, n_pages, text``, each when it is whole.

    ``n_pages`` may be null on some pages: the largest number that any page of the part gives holds.
    A part without any number comes out after ``give_up`` milliseconds of silence. ``doc_id`` is read as text.
    Timers need batches to fire in, so a query that runs all the time puts empty ones in; one that
    should end when all is read (``stream.drain``) switches them off. Sets the state store of the session.
    """
    pages.sparkSession.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    rows = pages.select(
        F.col("doc_id").cast("string").alias("doc_id"),
        F.coalesce(F.floor(F.col("page_no") / block_pages), F.lit(0)).cast("int").alias("part_no"),
        F.col("page_no").cast("int").alias("page_no"),
        F.col("n_pages").cast("int").alias("n_pages"),
        "text",
    ).filter("page_no IS NULL OR page_no >= 0")
    keyed = rows.groupBy("doc_id", "part_no")
    return keyed.transformWithState(PartAssembler(block_pages, give_up, forget), PARTS, "Append", "ProcessingTime")


def latest_parts(spark: SparkSession, path: str) -> DataFrame:
    """The last form of each part that a stream of ``assemble_pages`` has written to ``path``."""
    rows = spark.read.schema(PARTS).parquet(path)
    last = rows.groupBy("doc_id", "part_no").agg(F.max("version").alias("version"))
    return rows.join(last, ["doc_id", "part_no", "version"], "left_semi")
