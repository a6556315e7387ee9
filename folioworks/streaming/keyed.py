"""Output kept by document: a batch replaces the documents that it brings, and readers see live files only.

The output is a parquet table partitioned by ``bucket``, a hash of doc_id. A batch touches the
buckets of its documents: their rows are read (other partitions are pruned), those of the batch's
documents go, the new ones are added, and the buckets are written anew. So
a bucket is compacted whenever it is touched, and no file of an earlier form is left.

The merged buckets are first written beside the table, as folders that then take the place of the old ones; no row is
written a second time for that. Should the exchange of the folders break
off, the next batch finishes it from there before anything else, so a bucket is never lost
between deletion and renaming. Merging the same batch again gives the same table.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from folioworks.session import entries, exists, put_in_place, remove

BUCKETS = 64
#: Parts of a document that share a file; a long document spreads over several tasks.
PARTS_PER_FILE = 64
#: Documents of a batch that every executor may hold, to drop their earlier rows where these lie.
HELD_IDS = 2_000_000
#: Rows are written once and read much more often.
CODEC = "zstd"


def bucket_of(doc_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(doc_id.cast("string")), F.lit(buckets)).cast("int")


def _write(rows: DataFrame, held: int, path: str) -> None:
    """Rows by bucket, ``held`` of which there are."""
    spread = F.floor(F.coalesce(F.col("part_no"), F.lit(0)) / PARTS_PER_FILE) if "part_no" in rows.columns else F.lit(0)
    writer = rows.repartition(max(1, held), "bucket", spread).write.mode("overwrite").option("compression", CODEC)
    writer.option("partitionOverwriteMode", "static").partitionBy("bucket").parquet(path)


def _exchange(spark: SparkSession, path: str) -> None:
    """Put the merged buckets, if a whole merge is there, in their places and drop the copy."""
    merged = f"{path}/_merge"
    if not exists(spark, f"{merged}/_SUCCESS"):
        return
    held = entries(spark, merged)
    if any(name.startswith("part-") for name in held):
        # rows that are not in folders by bucket yet
        rows = spark.read.parquet(merged)
        _write(rows, rows.select("bucket").distinct().count(), f"{path}/_merge_by_bucket")
        remove(spark, merged)
        put_in_place(spark, f"{path}/_merge_by_bucket", merged)
        held = entries(spark, merged)
    for name in held:
        if name.startswith("bucket="):
            put_in_place(spark, f"{merged}/{name}", f"{path}/table/{name}")
    remove(spark, merged)


def upsert(batch: DataFrame, path: str, buckets: int = BUCKETS) -> None:
    """Put the rows of ``batch`` in the place of all earlier rows of their ``doc_id``s.

    The batch is read twice where there are earlier rows, so it should be a table then. An empty batch changes nothing.
    """
    spark = batch.sparkSession
    _exchange(spark, path)
    new = batch.withColumn("bucket", bucket_of(F.col("doc_id"), buckets))
    if not exists(spark, f"{path}/table"):
        _write(new, buckets, f"{path}/_merge")
        _exchange(spark, path)
        return
    facts = new.agg(F.collect_set("bucket").alias("touched"), F.count(F.lit(1)).alias("rows")).first()
    touched = facts["touched"]  # ``buckets`` at most
    if not touched:
        return
    old = spark.read.parquet(f"{path}/table").filter(F.col("bucket").isin(touched))
    ids = new.select("bucket", "doc_id").distinct()
    # of few enough documents every executor may know the ids: then no earlier row moves for the join
    ids = F.broadcast(ids) if facts["rows"] <= HELD_IDS else ids
    kept = old.join(ids, ["bucket", "doc_id"], "left_anti")
    _write(kept.unionByName(new, allowMissingColumns=True), len(touched), f"{path}/_merge")
    _exchange(spark, path)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """All documents in the form of the last batch that brought them. A query by doc_id may add its ``bucket_of``."""
    return spark.read.parquet(f"{path}/table").drop("bucket")


def upsert_batches(path: str, make: Callable[[DataFrame], DataFrame], buckets: int = BUCKETS) -> Callable[[DataFrame, int], None]:
    """A foreachBatch function: ``make`` turns the arrived rows into rows with ``doc_id``; they replace the earlier ones.

    A batch that is run again, also under another number or checkpoint, leaves the table as it is.
    """

    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        _exchange(spark, path)
        if not exists(spark, f"{path}/table"):
            upsert(make(batch), path, buckets)
            return
        staged = f"{path}/_batch"
        make(batch).write.mode("overwrite").option("compression", CODEC).parquet(staged)
        upsert(spark.read.parquet(staged), path, buckets)
        remove(spark, staged)

    return write
