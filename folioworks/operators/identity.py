"""Content ids and exact duplicates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def content_id(content: Column | str) -> Column:
    """First 16 hex digits of the SHA-256 of the content; null is as empty."""
    data = (F.col(content) if isinstance(content, str) else content).cast("binary")
    return F.substring(F.sha2(F.coalesce(data, F.lit("").cast("binary")), 256), 1, 16)


def with_doc_id(df: DataFrame, content: str, name: str = "doc_id") -> DataFrame:
    return df.withColumn(name, content_id(content))


def dedup_exact(df: DataFrame, key: str, doc_id: str = "doc_id") -> DataFrame:
    """One row per content id: the one with the smallest ``key``.

    The smallest keys are a hash aggregate over narrow rows, in which copies
    fold together before the shuffle however many there are of one content;
    rows are then picked by content id and key. ``key`` names a row: of rows
    that share both, all stay. A null key counts only where a content has no other.
    """
    least = df.groupBy(doc_id).agg(F.min(key).alias("_key"))
    same = df[doc_id].eqNullSafe(least[doc_id]) & df[key].eqNullSafe(least["_key"])
    return df.join(least, same, "left_semi").select(doc_id, *[c for c in df.columns if c != doc_id])
