"""Resampling towards a target: bucketed word runs, likelihood gains, Gumbel top-k without replacement.

1. ``Features`` finds the words of some texts and the runs of one and two words. A run's
   bucket is the CRC-32 of its bytes modulo ``buckets``. CRC-32 is linear over exclusive or,
   so the CRC of a span is the exclusive or of one table entry per byte, which byte value and
   distance from the end of the span decide (the position table), and of a constant for the
   length. All spans of a slice are folded by one ``bitwise_xor.reduceat``. Two-word spans
   overlap, so those that begin at even words are folded in one pass and the others in
   another. Spans longer than ``REACH`` bytes are folded block by block.
2. ``counts`` adds up the buckets of all texts of a table: every task sends one row for each
   of its buckets. ``gains`` makes 1000 * ln of the smoothed likelihood ratio of each bucket.
3. A text's weight is the floored mean of the gains of its features; its score is the weight
   plus Gumbel noise that the seed and doc_id decide. The highest scores are the draw.
4. Ranks come from one sort over the cluster: each part is numbered by itself and begins
   where the parts before it end.

Defined results: null and empty texts have no features and weight 0. A null ``doc_id`` counts
as an empty id in the noise and goes last among equal scores. Repeated rows are rows of their
own: each counts, and equal scores of one doc_id have ranks one after the other, by n_features
and weight. An empty table gives an empty result, an empty target smoothed gains. Other columns
are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioworks.llm.crc_sql import CRC_CTES
from folioworks.llm.words import row_batches, slices
from folioworks.session import materialize

BUCKETS = 10_000
#: Words that a text needs to be drawn, share of those texts that is drawn, and the seed.
LEAST_WORDS, PERCENT, SEED = 20, 25, 7
#: Distances from the end of a span that the position table covers.
REACH = 256

# -- fixed value: the reflected polynomial of CRC-32
POLYNOMIAL = 0xEDB88320

_ONES = np.uint32(0xFFFFFFFF)
_WORD = np.zeros(256, dtype=bool)
_WORD[0x30:0x3A] = _WORD[0x61:0x7B] = _WORD[0x80:] = True


def _zero_byte(register: np.ndarray, single: np.ndarray) -> np.ndarray:
    """The CRC register after one more zero byte."""
    return (register >> np.uint32(8)) ^ single[register & np.uint32(255)]


def _position_table() -> tuple[np.ndarray, np.ndarray]:
    """What a byte adds at each distance from the end (row REACH: nothing), and the constants of lengths 0 to REACH."""
    single = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        single = np.where(single & np.uint32(1), (single >> np.uint32(1)) ^ np.uint32(POLYNOMIAL), single >> np.uint32(1))
    table = np.zeros((REACH + 1, 256), dtype=np.uint32)
    constant = np.full(REACH + 1, _ONES, dtype=np.uint32)
    table[0] = single
    for d in range(1, REACH):
        table[d] = _zero_byte(table[d - 1], single)
    for n in range(REACH):
        constant[n + 1] = _zero_byte(constant[n : n + 1], single)[0]
    return table, constant


TABLE, CONSTANT = _position_table()
_FLAT = TABLE.ravel()


def _shifted(register: np.ndarray) -> np.ndarray:
    """The register after REACH zero bytes: its four bytes are the first of a block of that length."""
    total = np.zeros(len(register), dtype=np.uint32)
    for i in range(4):
        total ^= TABLE[REACH - 1 - i][(register >> np.uint32(8 * i)) & np.uint32(255)]
    return total


def span_crcs(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC-32 of each span of ``data``; spans ascend, hold a byte at least, and have one byte or more after them."""
    if not len(start):
        return np.zeros(0, dtype=np.uint32)
    length = end - start
    edges = np.column_stack([start, end]).ravel()
    # Up to the next span, bytes are measured from the end of this one; those after it add nothing.
    width = np.diff(np.r_[start, len(data)])
    distance = np.repeat(end, width) - np.arange(start[0] + 1, len(data) + 1)
    distance[(distance < 0) | (distance >= REACH)] = REACH
    added = _FLAT[(distance << 8) | data[start[0] :]]
    total = np.bitwise_xor.reduceat(added, edges - start[0])[::2] ^ CONSTANT[np.minimum(length, REACH)]
    # Long spans: a first block of what is over, then blocks of REACH bytes.
    for i in np.flatnonzero(length > REACH):
        over = int(length[i]) % REACH
        blocks = data[start[i] + over : end[i]].reshape(-1, REACH)
        each = np.bitwise_xor.reduce(TABLE[np.arange(REACH - 1, -1, -1)[None, :], blocks], axis=1)
        register = CONSTANT[over : over + 1].copy()
        if over:
            head = data[start[i] : start[i] + over]
            register ^= np.bitwise_xor.reduce(TABLE[np.arange(over - 1, -1, -1), head])
        for block in each:
            register = _shifted(register) ^ block
        total[i] = register[0]
    return total ^ _ONES


class Features:
    """Buckets of all runs of one and two words of some texts (UTF-8), and the texts they are in."""

    def __init__(self, texts: list[bytes], buckets: int = BUCKETS):
        raw = np.frombuffer((b"\n".join(texts) + b"\n").lower(), dtype=np.uint8)
        inside = np.zeros(len(raw) + 2, dtype=np.int8)
        inside[1:-1] = _WORD[raw]
        edges = np.flatnonzero(np.diff(inside))
        begins, ends = edges[::2], edges[1::2]
        limits = np.cumsum([len(t) + 1 for t in texts])
        owner = np.searchsorted(limits, begins, side="right")
        # The words with one space after each: a run of words is a span of these bytes.
        keep = inside[1:-1].astype(bool)
        keep[ends] = True
        data = np.where(_WORD[raw[keep]], raw[keep], np.uint8(0x20))
        size = ends - begins
        end = np.cumsum(size + 1) - 1
        start = end - size
        #: Number of words of each text.
        self.words = np.bincount(owner, minlength=len(texts))
        parts, of = [span_crcs(data, start, end)], [owner]
        for first in (0, 1):
            a, b = np.arange(first, len(start) - 1, 2), np.arange(first + 1, len(start), 2)
            crc = span_crcs(data, start[a], end[b])
            same = owner[a] == owner[b]
            parts.append(crc[same])
            of.append(owner[a][same])
        self.buckets = (np.concatenate(parts) % np.uint32(buckets)).astype(np.int64)
        self.owner = np.concatenate(of)


def counts(docs: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """bucket, n: features of all texts of ``docs`` (text)."""

    def run(batches):
        total = np.zeros(buckets, dtype=np.int64)
        for batch in row_batches(batches):
            for _, texts in slices(batch.column(0)):
                total += np.bincount(Features(texts, buckets).buckets, minlength=buckets)
        held = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(held), pa.array(total[held])], names=["bucket", "n"])

    each = docs.select("text").mapInArrow(run, "bucket bigint, n bigint")
    return each.groupBy("bucket").agg(F.sum("n").alias("n"))


def gains(docs: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> np.ndarray:
    """The gain of each bucket; ``buckets`` rows at most come to the driver from either table."""
    held = []
    for table in (target, docs):
        n = [0] * buckets
        for r in counts(table, buckets).collect():
            n[r.bucket] = r.n
        held.append(n)
    t_all, s_all = (float(sum(n) + buckets) for n in held)
    return np.array([math.floor(1000 * math.log((t + 1) * s_all / ((s + 1) * t_all))) for t, s in zip(*held, strict=True)], dtype=np.int64)


def weighted(docs: DataFrame, gain: np.ndarray) -> DataFrame:
    """doc_id, n_features, weight, n_words of every row of ``docs`` (doc_id, text)."""

    def run(batches):
        for batch in row_batches(batches):
            made = []
            for _, texts in slices(batch.column(1)):
                found = Features(texts, len(gain))
                n = np.bincount(found.owner, minlength=len(texts))
                total = np.zeros(len(texts), dtype=np.int64)
                np.add.at(total, found.owner, gain[found.buckets])
                made.append((n, total // np.maximum(n, 1), found.words))
            columns = [np.concatenate(x).astype(np.int64) for x in zip(*made, strict=True)] if made else [np.zeros(0, dtype=np.int64)] * 3
            yield pa.RecordBatch.from_arrays([batch.column(0), *map(pa.array, columns)], names=["doc_id", "n_features", "weight", "n_words"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n_features bigint, weight bigint, n_words bigint")


def noise(doc_id: Column, seed: int = SEED) -> Column:
    """1000 times a Gumbel variate, floored, that the seed and the id decide."""
    named = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(named.cast("binary"), 256), 1, 8), 16, 10).cast("bigint")
    return F.floor(F.lit(-1000.0) * F.log(-F.log((h + F.lit(0.5)) / F.lit(4294967296.0)))).cast("bigint")


def numbered(rows: DataFrame, *order: Column) -> DataFrame:
    """``rows`` with ``rank``, 1, 2, 3 … in the given order; equal rows have ranks one after the other.

    One range exchange sorts the rows. A row's place in its part and the lengths of the parts
    before it give its rank, so no task sees all rows; what is broadcast is one row per part.
    Copies of one row are told apart by their place in the input, and so may span several parts.
    """
    apart = rows.withColumn("_row_", F.monotonically_increasing_id())
    placed = apart.orderBy(*order, "_row_").drop("_row_").withColumn("_place_", F.monotonically_increasing_id())
    part = F.shiftright("_place_", 33).alias("_part_")
    placed = materialize(placed)
    sizes = placed.groupBy(part).agg(F.count("*").alias("_n_"))
    before = Window.orderBy("_part_").rowsBetween(Window.unboundedPreceding, -1)
    first = sizes.select("_part_", F.coalesce(F.sum("_n_").over(before), F.lit(0)).alias("_first_"))
    inside = F.col("_place_").bitwiseAND(F.lit((1 << 33) - 1))
    joined = placed.withColumn("_part_", part).join(F.broadcast(first), "_part_")
    return joined.select(*rows.columns, (F.col("_first_") + inside + 1).alias("rank"))


def resample(
    docs: DataFrame, target: DataFrame, buckets: int = BUCKETS, least_words: int = LEAST_WORDS, percent: int = PERCENT, seed: int = SEED
) -> DataFrame:
    """doc_id, n_features, weight, score, rank of every row of ``docs`` (doc_id, text); rank is null for rows not drawn.

    ``target`` (text) holds the texts whose distribution the draw should follow.
    """
    gain = gains(docs, target, buckets)
    scored = weighted(docs, gain).withColumn("score", F.col("weight") + noise(F.col("doc_id"), seed))
    scored = materialize(scored)
    can = F.col("n_words") >= least_words
    shown = ["doc_id", "n_features", "weight", "score"]
    drawn = scored.filter(can).count() * percent // 100
    ranked = numbered(scored.filter(can).select(shown), F.desc("score"), F.asc_nulls_last("doc_id"), F.asc("n_features"), F.asc("weight"))
    ranked = ranked.withColumn("rank", F.when(F.col("rank") <= drawn, F.col("rank")))
    return ranked.union(scored.filter(~can).select(*shown, F.lit(None).cast("bigint").alias("rank")))


def op13_resample(spark, sf_dir: str) -> DataFrame:
    return resample(spark.read.parquet(f"{sf_dir}/documents.parquet"), spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


OP13_SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (
  SELECT kind, id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda v: v <> '') AS w
  FROM (SELECT 0 AS kind, doc_id AS id, text FROM documents UNION ALL SELECT 1, item_id, text FROM benchmark)
),
features AS MATERIALIZED (
  SELECT kind, id, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) AS f FROM words
),""" + CRC_CTES + r""",
held AS MATERIALIZED (SELECT kind, id, c % 10000 AS bucket FROM features JOIN crc USING (f)),
totals AS (SELECT count(*) FILTER (kind = 0) AS s, count(*) FILTER (kind = 1) AS t FROM held),
gain AS MATERIALIZED (
  SELECT b AS bucket, floor(1000 * ln((t + 1)::DOUBLE * (SELECT s + 10000 FROM totals) / ((s + 1)::DOUBLE * (SELECT t + 10000 FROM totals))))::BIGINT AS g
  FROM (SELECT r.b, count(h.bucket) FILTER (kind = 0) AS s, count(h.bucket) FILTER (kind = 1) AS t FROM range(10000) r(b) LEFT JOIN held h ON h.bucket = r.b GROUP BY r.b)
),
weights AS (
  SELECT id AS doc_id, count(*) AS n, sum(g)::BIGINT AS total FROM held JOIN gain USING (bucket) WHERE kind = 0 GROUP BY id
),
scored AS (
  SELECT d.doc_id, coalesce(n, 0) AS n_features, coalesce(floor(total::DOUBLE / n)::BIGINT, 0) AS weight,
    coalesce(floor(total::DOUBLE / n)::BIGINT, 0) + floor(-1000 * ln(-ln((('0x' || sha256('7:' || d.doc_id)[1:8])::BIGINT + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score
  FROM documents d LEFT JOIN weights USING (doc_id)
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY n_features >= 39 ORDER BY score DESC, doc_id) AS r, count(*) OVER (PARTITION BY n_features >= 39) AS all_rows FROM scored
)
SELECT doc_id, n_features, weight, score, CASE WHEN n_features >= 39 AND r <= all_rows * 25 // 100 THEN r END AS rank FROM placed
"""
