"""Sharding by jump consistent hashing, under the law ``key``: doc_id and the number of shards decide.

No ring table is kept: the shard of a key follows from a few steps of a linear
congruential sequence that the key seeds. With one shard more, a row either stays where
it is or goes to the new shard. Rows are numbered inside a shard without gaps: counts of
(shard, part) give each part its first slot, so no shard is numbered in one task.

Defined results: a null text has no bytes (size 1, crc32 0); rows without ``doc_id`` have
the key 0. Rows that share a doc_id share a shard; equal rows take neighbouring slots. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioworks.session import materialize

SHARDS = 16
#: Parts of a shard that are numbered apart; SHARDS * PARTS bounds the table of first slots.
PARTS = 1024
_STEP = np.uint64(2862933555777941757)


def jump(keys: np.ndarray, shards: int) -> np.ndarray:
    """The shard, 0 to ``shards`` - 1, of each unsigned 64-bit key."""
    state = keys.astype(np.uint64)
    shard = np.zeros(len(state), dtype=np.int64)
    candidate = np.zeros(len(state), dtype=np.int64)
    moving = np.arange(len(state))
    while len(moving):
        shard[moving] = candidate[moving]
        state[moving] = state[moving] * _STEP + np.uint64(1)
        scale = float(1 << 31) / ((state[moving] >> np.uint64(33)).astype(np.float64) + 1)
        candidate[moving] = ((shard[moving] + 1) * scale).astype(np.int64)
        moving = moving[candidate[moving] < shards]
    return shard


def place(docs: DataFrame, shards: int = SHARDS) -> DataFrame:
    """doc_id, size, text_crc32, shard, slot and grown_shard (the shard with one more) of every row."""
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = docs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        (F.octet_length(text) + 1).cast("bigint").alias("size"),
        F.crc32(text.cast("binary")).cast("bigint").alias("text_crc32"),
    )

    def run(batches):
        for batch in batches:
            keys = np.asarray(pa.compute.fill_null(batch.column(0), 0)).astype(np.int64).view(np.uint64)
            made = [pa.array(jump(keys, shards).astype(np.int32)), pa.array(jump(keys, shards + 1).astype(np.int32))]
            yield pa.RecordBatch.from_arrays([*batch.columns, *made], names=["doc_id", "size", "text_crc32", "shard", "grown_shard"])

    schema = "doc_id bigint, size bigint, text_crc32 bigint, shard int, grown_shard int"
    part = F.pmod(F.xxhash64("doc_id", "text_crc32", "size"), F.lit(PARTS)).cast("int")
    placed = materialize(rows.mapInArrow(run, schema).withColumn("part", part))
    counts = placed.groupBy("shard", "part").agg(F.count("*").alias("n"))
    before = Window.partitionBy("shard").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    first = counts.select("shard", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("first_slot"))
    inside = Window.partitionBy("shard", "part").orderBy("doc_id", "text_crc32", "size")
    numbered = placed.withColumn("row", F.row_number().over(inside)).join(F.broadcast(first), ["shard", "part"])
    return numbered.select(
        "doc_id", "size", "text_crc32", "shard", (F.col("first_slot") + F.col("row") - 1).alias("slot"), "grown_shard"
    )


def op4_sharding(spark, sf_dir: str) -> DataFrame:
    placed = place(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return placed.select("doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", "grown_shard")
