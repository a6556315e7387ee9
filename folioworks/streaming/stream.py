"""The file loop as Structured Streaming."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.config import EngineConfig
from folioworks.operators.identity import content_id
from folioworks.operators.language import LanguageProfiles
from folioworks.plans.ingest import ingest
from folioworks.session import scratch_path
from folioworks.streaming.keyed import upsert_batches

SALTS = 32


def stream_docs(
    spark: SparkSession, path: str, schema, files_per_trigger: int = 1000, glob: str | None = None, max_file_age: str = "365d"
) -> DataFrame:
    """Arriving parquet files of documents, with ``doc_id`` and ``arrived``.

    ``arrived`` is the time of the micro-batch that first sees a row, which never
    runs behind the watermark: a file with an old time stamp is not late. Spark
    passes over files that are ``max_file_age`` older than the newest one it has
    seen, and remembers the names of those that are younger.
    """
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).option("maxFileAge", max_file_age)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    docs = reader.parquet(path)
    return docs.select(
        *[c for c in docs.columns if c != "doc_id"],
        *([F.col("doc_id").alias("source_id")] if "doc_id" in docs.columns else []),
        content_id("text").alias("doc_id"),
        F.current_timestamp().alias("arrived"),
    )


def dedup_stream(docs: DataFrame, spread_by: str, delay: str = "1 day", salts: int = SALTS) -> DataFrame:
    """First arrival of each content id; repeats within the watermark are dropped.

    Repeats are dropped per salt first, so copies of one content spread over
    ``salts`` tasks and at most ``salts`` rows per id meet in the second step.
    """
    salted = docs.withWatermark("arrived", delay).withColumn(
        "_salt", F.pmod(F.xxhash64(spread_by), F.lit(salts)).cast("int")
    )
    return (
        salted.dropDuplicatesWithinWatermark(["doc_id", "_salt"])
        .drop("_salt")
        .dropDuplicatesWithinWatermark(["doc_id"])
    )


def upsert_batch(path: str, cfg: EngineConfig = EngineConfig(), prepare=None, profiles: LanguageProfiles | None = None):
    """A foreachBatch function: the batch pipeline, its bundles kept by document (see ``keyed``).

    ``prepare`` turns the arrived rows into a page table; ``profiles`` are needed where languages are tagged.
    """
    return upsert_batches(path, lambda batch: ingest(prepare(batch) if prepare else batch, cfg, profiles=profiles))


def drain(stream: DataFrame, path: str, checkpoint: str) -> DataFrame:
    """Run an append stream over all that is there now; read back its output.

    A stream with timers on the clock would go on with empty batches for ever, so there are none:
    timers fire in the batches that have rows.
    """
    conf = stream.sparkSession.conf
    empty = conf.get("spark.sql.streaming.noDataMicroBatches.enabled")
    conf.set("spark.sql.streaming.noDataMicroBatches.enabled", "false")
    writer = stream.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint)
    try:
        query = writer.outputMode("append").trigger(availableNow=True).start()
        query.awaitTermination()
    finally:
        conf.set("spark.sql.streaming.noDataMicroBatches.enabled", empty)
    return stream.sparkSession.read.schema(stream.schema).parquet(path)


def drain_new(stream: DataFrame) -> DataFrame:
    """``drain`` into a new folder below the session's shared folder."""
    base = scratch_path(stream.sparkSession, "stream")
    return drain(stream, f"{base}/out", f"{base}/state")


def run_batches(stream: DataFrame, write: Callable[[DataFrame, int], None], checkpoint: str) -> None:
    """Hand all that is there now to ``write``, batch by batch."""
    query = stream.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
