"""Spelling variants: edits of each word probed against sharded blocked Bloom filters, hits joined to the vocabulary.

1. The vocabulary is a table of distinct words and their counts, made by one aggregation.
2. Its words enter blocked Bloom filters, one family for each length: the upper half of a
   word's hash picks a block of 512 bits, the lower half two of its eight 64-bit words and three
   bits in each. A shard is a run of ``SHARD_BLOCKS`` blocks (128 KB), built by one group.
3. Every word's deletions and replacements are generated in tasks and probed against the
   filters of their length. Hashes are polynomial, so an edit's hash follows from the word's
   own in a few operations and no string is made before a filter says yes. An insertion is
   the other word's deletion, and of two words that differ in one place only the one with the smaller
   character is replaced, so each pair is generated once.
4. At most ``PASS_BYTES`` of shards are broadcast at a time. A larger vocabulary takes
   several passes over its words, each with other shards; nothing is left out.
5. Only hits are shuffled, to an exact join with the vocabulary, which removes false hits.
6. A word's form is its near word of largest count, if that is ``ratio`` times its own; roots
   follow forms to the last by doubling, at most log2 of the longest chain times.

A word has at most 2 * length * alphabet near words, so no join key is hot; the counting of very
frequent words combines in the tasks first.

Defined results: null and empty texts have no words. A null ``doc_id`` counts as an empty id.
Repeated rows are rows of their own: their words count again. Ties go to the smaller word in
code-point order. Words of any length take part; those of ``LONGEST`` and more share their
filters. An empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.llm.crc_sql import CRC_CTES
from folioworks.llm.words import mix
from folioworks.session import materialize

LEAST_LENGTH, LEAST_COUNT, RATIO = 7, 2, 10
#: One in so many (document, word) pairs is counted as if a code point were missing.
SLIP = 31
#: Lengths from here on share the filters of one class.
LONGEST = 64
#: Words that a block is filled with, blocks of a shard, and bytes of shards in one pass.
BLOCK_WORDS, SHARD_BLOCKS, PASS_BYTES = 32, 1 << 11, 32 << 20
#: Edits that are hashed at once, and words that a task probes the edits of.
EDITS, TASK_WORDS = 1 << 21, 20_000

_BASE = 0xD6E8FEB86659FD93
_INVERSE = np.uint64(pow(_BASE, -1, 1 << 64))
_CHARACTER = mix(np.arange(1, 257, dtype=np.uint64))
_GOLDEN = 0x9E3779B97F4A7C15
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def counted(docs: DataFrame, least_length: int = LEAST_LENGTH, least_count: int = LEAST_COUNT, slip: int = SLIP) -> DataFrame:
    """word, n: the vocabulary of ``docs`` (doc_id, text), with the slips that ids and words decide."""
    named = F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")), F.lit(":"))
    found = F.regexp_extract_all("text", F.lit(f"[A-Za-zÀ-ÿ]{{{least_length},}}"), F.lit(0))
    runs = docs.select(named.alias("named"), F.explode_outer(found).alias("run")).filter("run IS NOT NULL")
    runs = runs.select("named", F.translate("run", _UPPER, _UPPER.lower()).alias("run"))
    runs = runs.select("run", F.length("run").alias("size"), F.crc32(F.concat("named", "run").cast("binary")).alias("h"))
    cut = (F.col("h") % F.col("size")).cast("int")
    shorter = F.concat(F.col("run").substr(F.lit(1), cut), F.col("run").substr(cut + 2, F.col("size")))
    words = runs.select(F.when(F.col("h") % slip == 0, shorter).otherwise(F.col("run")).alias("word"))
    words = words.filter(F.length("word") >= least_length)
    return words.groupBy("word").agg(F.count("*").alias("n")).filter(F.col("n") >= least_count)


def _by_length(words: pa.Array):
    """Of the words of each length: the length, their places, and their characters as rows of bytes."""
    texts = [w.encode("latin-1") for w in words.to_pylist()]
    lengths = np.fromiter(map(len, texts), dtype=np.int64, count=len(texts))
    for size in np.unique(lengths):
        places = np.flatnonzero(lengths == size)
        step = max(1, EDITS // (int(size) * 8))
        for i in range(0, len(places), step):
            some = places[i : i + step]
            yield int(size), some, np.frombuffer(b"".join(texts[p] for p in some), dtype=np.uint8).reshape(len(some), size)


def _powers(size: int) -> np.ndarray:
    steps = np.full(size, _BASE, dtype=np.uint64)
    steps[:1] = 1
    return np.multiply.accumulate(steps)


def keys_of(hashes: np.ndarray, size: int) -> np.ndarray:
    """What the filters take of a polynomial hash of a word of ``size`` characters."""
    return mix(hashes ^ np.uint64(size * _GOLDEN % (1 << 64)))


def _blocks(keys: np.ndarray, count: int) -> np.ndarray:
    """The block of each key, 0 to ``count`` - 1."""
    return (((keys >> np.uint64(32)) * np.uint64(count)) >> np.uint64(32)).astype(np.int64)


def _marks(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A word of the block, and three bits in it."""
    one = np.uint64(1)
    bits = (one << ((keys >> np.uint64(3)) & np.uint64(63))) | (one << ((keys >> np.uint64(9)) & np.uint64(63))) | (one << ((keys >> np.uint64(15)) & np.uint64(63)))
    return (keys & np.uint64(7)).astype(np.int64), bits


def _class(size: int) -> int:
    return min(size, LONGEST)


def shards(words: DataFrame, blocks: dict[int, int], of_shard: int = SHARD_BLOCKS) -> DataFrame:
    """class, shard, filter: the Bloom filters of ``words``; ``blocks`` has the number of blocks of each class, ``of_shard`` that of a shard."""

    def spread(batches):
        for batch in batches:
            for size, places, letters in _by_length(batch.column(0)):
                keys = keys_of((_CHARACTER[letters] * _powers(size)).sum(axis=1, dtype=np.uint64), size)
                shard = _blocks(keys, blocks[_class(size)]) // of_shard
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(len(places), _class(size))), pa.array(shard), pa.array(keys.view(np.int64))], names=["class", "shard", "key"]
                )

    def build(table: pa.Table) -> pa.Table:
        kind, shard = table["class"][0].as_py(), table["shard"][0].as_py()
        keys = np.asarray(table["key"]).view(np.uint64)
        bits = np.zeros(min(of_shard, blocks[kind] - shard * of_shard) * 8, dtype=np.uint64)
        at = (_blocks(keys, blocks[kind]) - shard * of_shard) * 8
        for part in (keys, mix(keys)):
            word, marks = _marks(part)
            np.bitwise_or.at(bits, at + word, marks)
        return pa.table({"class": [kind], "shard": [shard], "filter": pa.array([bits.tobytes()], pa.binary())})

    spread_out = words.select("word").mapInArrow(spread, "class bigint, shard bigint, key bigint")
    return spread_out.groupBy("class", "shard").applyInArrow(build, "class bigint, shard bigint, filter binary")


class Filters:
    """Some shards, and the question whether a key may be in them."""

    def __init__(self, blocks: dict[int, int], held: dict[tuple[int, int], bytes], of_shard: int = SHARD_BLOCKS):
        self.blocks, self.of_shard, self.bits, self.start = blocks, of_shard, {}, {}
        for kind in {k for k, _ in held}:
            mine = {s: np.frombuffer(b, dtype=np.uint64) for (k, s), b in held.items() if k == kind}
            start = np.full(-(-blocks[kind] // of_shard), -1, dtype=np.int64)
            at = 0
            for s, bits in mine.items():
                start[s], at = at, at + len(bits)
            self.start[kind], self.bits[kind] = start, np.concatenate(list(mine.values()))

    def hits(self, keys: np.ndarray, size: int) -> np.ndarray:
        """Places of the keys that shards held here say yes to."""
        kind = _class(size)
        if kind not in self.bits:
            return np.zeros(0, dtype=np.int64)
        block = _blocks(keys, self.blocks[kind])
        start = self.start[kind][block // self.of_shard]
        at = start + (block % self.of_shard) * 8
        bits = self.bits[kind]
        word, marks = _marks(keys)
        yes = np.flatnonzero((start >= 0) & ((bits[at + word] & marks) == marks))
        word, marks = _marks(mix(keys[yes]))
        return yes[(bits[at[yes] + word] & marks) == marks]


def _strings(rows: np.ndarray) -> pa.Array:
    """Rows of latin-1 bytes as strings."""
    text = rows.tobytes().decode("latin-1").encode()
    ends = np.cumsum(rows.shape[1] + (rows >= 0x80).sum(axis=1))
    offsets = np.concatenate([[0], ends]).astype(np.int32)
    return pa.StringArray.from_buffers(len(rows), pa.py_buffer(offsets), pa.py_buffer(text))


def hits(size: int, letters: np.ndarray, alphabet: np.ndarray, filters: Filters):
    """Places of words and their edits (rows of bytes) that the filters say yes to."""
    power = _powers(size)
    shares = _CHARACTER[letters] * power
    whole = shares.sum(axis=1, dtype=np.uint64)[:, None]
    before = np.cumsum(shares, axis=1, dtype=np.uint64) - shares
    # Of equal neighbouring characters only the last is deleted: the others give the same word.
    last = np.ones(letters.shape, dtype=bool)
    last[:, :-1] = letters[:, 1:] != letters[:, :-1]
    row, place = np.nonzero(last)
    shorter = before + (whole - before - shares) * _INVERSE
    found = filters.hits(keys_of(shorter[row, place], size - 1), size - 1)
    if len(found):
        row, place = row[found], place[found]
        keep = np.arange(size)[None, :] != place[:, None]
        yield row, letters[row][keep].reshape(len(row), size - 1)
    if _class(size) not in filters.bits:
        return
    rest = whole - shares
    for letter in alphabet:
        row, place = np.nonzero(letters < letter)
        found = filters.hits(keys_of(rest[row, place] + _CHARACTER[letter] * power[place], size), size)
        if len(found):
            row, place = row[found], place[found]
            edits = letters[row]
            edits[np.arange(len(row)), place] = letter
            yield row, edits


def neighbours(words: DataFrame, of_shard: int = SHARD_BLOCKS, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """word, n, near, near_n: each pair of ``words`` (word, n; distinct, of characters up to U+00FF) that differs by one edit, once."""
    spark = words.sparkSession
    size = F.length("word")
    sizes = {r.c: r.n for r in words.groupBy(F.least(size, F.lit(LONGEST)).alias("c")).agg(F.count("*").alias("n")).collect()}
    blocks = {c: -(-n // BLOCK_WORDS) for c, n in sizes.items()}
    letters = words.select(F.explode(F.split("word", "")).alias("x")).distinct().collect()  # 256 at most
    alphabet = np.array(sorted({ord(r.x) for r in letters if r.x}), dtype=np.uint8)
    schema = "word string, n bigint, near string"
    if not blocks:
        return spark.createDataFrame([], f"{schema}, near_n bigint")
    built = materialize(shards(words, blocks, of_shard))

    def probe(batches, shared):
        filters = Filters(blocks, shared.value, of_shard)
        for batch in batches:
            for size, places, rows in _by_length(batch.column(0)):
                for row, edits in hits(size, rows, alphabet, filters):
                    of = pa.array(places[row])
                    yield pa.RecordBatch.from_arrays([batch.column(0).take(of), batch.column(1).take(of), _strings(edits)], names=["word", "n", "near"])

    passes, room = [[]], pass_bytes
    for r in built.select("class", "shard", F.length("filter").alias("bytes")).orderBy("class", "shard").toLocalIterator():
        if r.bytes > room and passes[-1]:
            passes.append([])
            room = pass_bytes
        passes[-1].append((r["class"], r.shard))
        room -= r.bytes
    found = []
    for some in passes:
        (low, first), (high, last) = some[0], some[-1]
        held = built.filter(f"(class > {low} OR class = {low} AND shard >= {first}) AND (class < {high} OR class = {high} AND shard <= {last})")
        shared = spark.sparkContext.broadcast({(r["class"], r.shard): bytes(r.filter) for r in held.collect()})
        longest = F.lit(True) if high == LONGEST else size <= high + 1
        # A short word is few bytes but many edits, so tasks are cut by words.
        asked = words.filter((size >= low) & longest).select("word", "n").repartition(-(-sum(sizes.values()) // TASK_WORDS))
        found.append(asked.mapInArrow(lambda batches, shared=shared: probe(batches, shared), schema))
        if len(passes) > 1:
            found[-1] = materialize(found[-1])
            shared.unpersist()
    candidates = found[0]
    for more in found[1:]:
        candidates = candidates.union(more)
    return candidates.join(words.select(F.col("word").alias("near"), F.col("n").alias("near_n")), "near").select("word", "n", "near", "near_n")


def roots(forms: DataFrame) -> DataFrame:
    """word, root: where the chain of ``forms`` (word, form) that begins at each word ends. Chains have no rings."""
    found = materialize(forms.select("word", F.col("form").alias("root"), F.lit(True).alias("moved")))
    while not found.filter("moved").isEmpty():
        step = found.select(F.col("word").alias("root"), F.col("root").alias("further"))
        joined = found.join(step, "root", "left")
        found = materialize(joined.select("word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved")))
    return found.select("word", "root")


def variants(words: DataFrame, ratio: int = RATIO, of_shard: int = SHARD_BLOCKS, pass_bytes: int = PASS_BYTES) -> DataFrame:
    """word, form, root, n, n_near, form_n of every row of ``words`` (word, n)."""
    pairs = materialize(neighbours(words, of_shard, pass_bytes))
    other = pairs.select(F.col("near").alias("word"), F.col("near_n").alias("n"), F.col("word").alias("near"), F.col("n").alias("near_n"))
    both = pairs.union(other)
    counts = both.groupBy("word").agg(F.count("*").alias("n_near"))
    best = F.min(F.struct((-F.col("near_n")).alias("less"), F.col("near").alias("form")))
    forms = both.filter(F.col("near_n") >= ratio * F.col("n")).groupBy("word").agg(best.alias("best"))
    forms = materialize(forms.select("word", "best.form", (-F.col("best.less")).alias("form_n")))
    rows = words.select("word", "n").join(counts, "word", "left").join(forms.join(roots(forms), "word"), "word", "left")
    return rows.select("word", "form", F.coalesce("root", "word").alias("root"), "n", F.coalesce("n_near", F.lit(0)).cast("bigint").alias("n_near"), "form_n")


def op12_spelling(spark, sf_dir: str) -> DataFrame:
    return variants(materialize(counted(spark.read.parquet(f"{sf_dir}/documents.parquet"))))


OP12_SQL = """
WITH RECURSIVE runs AS MATERIALIZED (
  SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-zÀ-ÿ]+')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run FROM documents
),
long AS MATERIALIZED (SELECT doc_id || ':' || run AS f, run FROM runs WHERE length(run) >= 7),
features AS (SELECT f FROM long),""" + CRC_CTES + """,
words AS MATERIALIZED (
  SELECT word, count(*) AS n
  FROM (SELECT CASE WHEN c % 31 = 0 THEN run[: c % length(run)] || run[c % length(run) + 2 :] ELSE run END AS word FROM long JOIN crc USING (f))
  WHERE length(word) >= 7 GROUP BY word HAVING count(*) >= 2
),
cuts AS MATERIALIZED (
  SELECT word, n, i, word[: i - 1] || word[i + 1 :] AS rest FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM words)
),
pairs AS (
  SELECT c.word, c.n, w.word AS near, w.n AS near_n FROM cuts c JOIN words w ON w.word = c.rest
  UNION SELECT w.word, w.n, c.word, c.n FROM cuts c JOIN words w ON w.word = c.rest
  UNION SELECT a.word, a.n, b.word, b.n FROM cuts a JOIN cuts b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
),
near AS MATERIALIZED (SELECT *, row_number() OVER (PARTITION BY word ORDER BY near_n DESC, near) AS r, count(*) OVER (PARTITION BY word) AS n_near FROM pairs),
best AS MATERIALIZED (
  SELECT w.word, w.n, coalesce(n_near, 0) AS n_near, CASE WHEN near_n >= 10 * w.n THEN near END AS form, CASE WHEN near_n >= 10 * w.n THEN near_n END AS form_n
  FROM words w LEFT JOIN near x ON x.word = w.word AND r = 1
),
chain(word, root, next) AS (
  SELECT word, word, form FROM best
  UNION ALL
  SELECT c.word, c.next, b.form FROM chain c JOIN best b ON b.word = c.next
)
SELECT b.word, form, root, n, n_near, form_n FROM best b JOIN chain c ON c.word = b.word AND c.next IS NULL
"""
