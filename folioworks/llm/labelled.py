"""Bounded samples of labelled texts, for the classifiers."""

from __future__ import annotations

import pickle
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioworks.llm.words import Tokens, mix, ngrams, slices


def held_out(doc_id: Column) -> Column:
    """Rows whose labels are never learned from: crc32 of the id as text, modulo 3, is 1."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 3 == 1, F.lit(False))


def sample(docs: DataFrame, labels: DataFrame, label: str, rows: int) -> DataFrame:
    """At most ``rows`` labelled texts: doc_id, text, label.

    Taken are the ids of lowest hash among the labelled ones that are not held out; each
    class gets half of the places. Repeated rows count once, ids that are labelled 0 and 1 not at
    all. Should ids have several texts, those of lowest hash fill the places of the class.
    ``rows`` bounds what is broadcast and what one task fits.
    """
    usable = labels.filter(F.col(label).isin(0, 1) & F.col("doc_id").isNotNull() & ~held_out(F.col("doc_id")))
    each = usable.groupBy("doc_id").agg(F.min(label).alias("label"), F.max(label).alias("most")).filter("label = most")
    ids = [each.filter(F.col("label") == v).select("doc_id", F.lit(v).cast("bigint").alias("label"), F.xxhash64("doc_id").alias("_order")) for v in (0, 1)]
    ids = [x.orderBy("_order", "doc_id").limit(rows // 2).select("doc_id", "label") for x in ids]
    texts = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    found = texts.join(F.broadcast(ids[0].union(ids[1])), "doc_id").dropDuplicates(["doc_id", "text"])
    # Spark keeps the first rows of each task only before it moves them.
    place = F.row_number().over(Window.partitionBy("label").orderBy(F.xxhash64("doc_id", "text"), "doc_id", "text"))
    return found.withColumn("_place_", place).filter(F.col("_place_") <= rows // 2).select("doc_id", "text", "label")


def fit_in_task(found: DataFrame, learn: Callable[[list[str], np.ndarray], object]) -> object:
    """``learn(texts, labels)`` on a bounded sample, inside one task; only the model reaches the driver.

    The texts come in the order of their ids, so the model doesn't depend on partitions.
    """

    def run(batches):
        rows = sorted((r["doc_id"], r["text"], r["label"]) for batch in batches for r in batch.to_pylist())
        model = learn([text for _, text, _ in rows], np.array([label for _, _, label in rows], dtype=np.int64))
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(model)], pa.binary())], names=["model"])

    made = found.repartition(1).mapInArrow(run, "model binary").first()
    return pickle.loads(made.model) if made else learn([], np.zeros(0, dtype=np.int64))


def without_copies(texts: list[str]) -> np.ndarray:
    """Numbers of the texts that are no near copy of an earlier one.

    A near copy shares one of four minima over hashes of its three-word runs. A group
    of copies would otherwise count as many independent texts.
    """
    seen: set[tuple[int, int]] = set()
    kept = []
    for first, part in slices(pa.array(texts, pa.string())):
        tokens = Tokens(part)
        grams, of = ngrams(tokens.hashes(), tokens.doc, tokens.first, 3)
        lowest = np.full((len(part), 4), np.iinfo(np.uint64).max, dtype=np.uint64)
        for k in range(4):
            np.minimum.at(lowest[:, k], of, mix(grams ^ np.uint64(k + 1)))
        for i, row in enumerate(lowest.tolist()):
            marks = set(enumerate(row))
            if not marks & seen:
                kept.append(first + i)
            seen |= marks
    return np.array(kept, dtype=np.int64)
