"""Near duplicates: SuperMinHash signatures, banding, exact verification, union-find groups.

1. ``sketch`` reads each text once: its set of word runs, a SuperMinHash signature and
   the keys of its bands. SuperMinHash gives each element one random permutation of the
   slots and increasing ranks; an element stops as soon as its next rank can't lower any
   slot, which after the first few ranks is nearly always.
2. Texts with equal sets form a class, which has a key of its own; from here on only one row
   of each class counts. Several classes may have rows of one doc_id.
3. In each round of ``linking`` a member is compared on full sets with one other at most, that of
   some band-mates of other components most like it by its signature. What the rounds leave is compared by ``prefix_join``: two
   members meet only if they share one of their rarest elements. Groups of near copies are thus
   linked through a few of their members, and documents of one template that are not
   near copies hardly meet. Before sets are fetched, two
   bits of each slot must agree as far as ``percent`` less 13 allows, some five standard
   deviations of the estimate; a bound of ``prefix_join`` that no similar pair exceeds does the rest.
4. Pairs are confirmed on their full sets: 100 * intersection >= ``percent`` * union.
5. Components of the links, found by ``components``, give the groups, each named by its
   least doc_id.

Signatures have ``BANDS`` * ``ROWS`` slots: two sets of similarity 0.8 share no band with
probability 2e-6. Sets of fewer than four elements can only be linked when equal, so
they take part in classes but not in bands.

Defined results: null and empty texts, and texts of white space, have an empty set and
are linked with nothing. Rows without ``doc_id`` have a null component and are kept. Rows
that share a ``doc_id`` are kept apart by their sets. Repeated rows fall in one class. An
empty table gives an empty result; other columns are not read.
"""

from __future__ import annotations

import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.llm.linking import linked
from folioworks.llm.prefix_join import candidates
from folioworks.llm.words import Tokens, distinct, mix, ngrams, row_batches, slices
from folioworks.session import discard, materialize

BANDS, ROWS = 56, 7
SLOTS = BANDS * ROWS
#: Sets of this size or more can have similar sets that differ from them.
LEAST_SET = 4
#: Slots whose lowest two bits share a 64-bit integer.
PACKED = 32
WORDS = -(-SLOTS // PACKED)
#: The estimate from the packed bits may fall this far below the similarity asked for.
LEEWAY = 0.13
#: The same for the choice of what to compare in a round.
SMALL_LEEWAY = 0.03
#: Elements whose permutations are kept as a table once most have stopped.
TABLE_ELEMENTS = 20_000

_GOLDEN = 0x9E3779B97F4A7C15
_LOW32 = np.uint64(0xFFFFFFFF)
_32 = np.uint64(32)


def signatures(elements: np.ndarray, doc: np.ndarray, count: int) -> np.ndarray:
    """SuperMinHash: SLOTS values per text, of elements given with their text numbers (sorted).

    A value is the rank of the element that won the slot, in the upper 32 bits, and the
    random fraction that ordered it, in the lower ones.
    """
    slots = np.full(count * SLOTS, np.iinfo(np.uint64).max, dtype=np.uint64)
    seeds = mix(elements)
    picks: list[np.ndarray] = []  # of the ranks so far, the place that each active element swapped
    table = None
    for rank in range(SLOTS):
        random = mix(seeds + np.uint64((rank + 1) * _GOLDEN % (1 << 64)))
        place = (rank + (((random & _LOW32) * np.uint64(SLOTS - rank)) >> _32)).astype(np.int64)
        if table is not None:
            row = np.arange(len(seeds))
            slot = table[row, place].astype(np.int64)
            table[row, place] = table[row, rank]
        else:
            slot = place.copy()
            for i in range(rank - 1, -1, -1):
                slot[picks[i] == slot] = i
            picks.append(place)
        np.minimum.at(slots, doc * SLOTS + slot, (np.uint64(rank) << _32) | (random >> _32))
        # A text goes on while a slot can still be lowered by the next rank.
        top = slots.reshape(count, SLOTS).max(axis=1)
        goes_on = (top >> _32) > rank
        active = goes_on[doc]
        if not active.any():
            break
        if not active.all():
            seeds, doc = seeds[active], doc[active]
            picks = [p[active] for p in picks]
            table = table[active] if table is not None else None
        if table is None and rank >= 2 and len(seeds) <= TABLE_ELEMENTS:
            table = np.tile(np.arange(SLOTS, dtype=np.uint16), (len(seeds), 1))
            row = np.arange(len(seeds))
            for i, p in enumerate(picks):
                table[row, p] = table[row, i]
            picks = []
    return slots.reshape(count, SLOTS)


def band_keys(slots: np.ndarray) -> np.ndarray:
    """One 64-bit key per band."""
    parts = slots.reshape(len(slots), BANDS, ROWS)
    key = np.broadcast_to(np.arange(1, BANDS + 1, dtype=np.uint64), parts.shape[:2]).copy()
    for r in range(ROWS):
        key = mix(key * np.uint64(_GOLDEN) + parts[:, :, r])
    return key


def packed_bits(slots: np.ndarray) -> np.ndarray:
    """Two bits of each slot, PACKED slots to an integer."""
    bits = np.zeros((len(slots), WORDS * PACKED), dtype=np.uint64)
    bits[:, :SLOTS] = slots & np.uint64(3)
    places = np.arange(PACKED, dtype=np.uint64) * np.uint64(2)
    return (bits.reshape(len(slots), WORDS, PACKED) << places).sum(axis=2, dtype=np.uint64)


def differing_bits(one: str, other: str) -> Column:
    """Slots of which the packed bits differ."""
    odd = 0x5555555555555555
    differing = F.lit(0)
    for w in range(WORDS):
        x = F.col(one)[w].bitwiseXOR(F.col(other)[w])
        either = x.bitwiseOR(F.shiftrightunsigned(x, 1)).bitwiseAND(F.lit(odd))
        differing = differing + F.bit_count(either)
    return differing


def looks_similar(one: str, other: str, percent: int, leeway: float = LEEWAY) -> Column:
    """Whether packed bits agree as often as a pair of the similarity does, within the leeway."""
    return differing_bits(one, other) <= int((1 - percent / 100 + leeway) * 0.75 * SLOTS)


def _sets(texts: list[bytes], words: int) -> tuple[np.ndarray, np.ndarray]:
    tokens = Tokens(texts)
    return distinct(*ngrams(tokens.hashes(), tokens.doc, tokens.first, words))


def _names(elements: np.ndarray, doc: np.ndarray, count: int) -> list[np.ndarray]:
    """Of each set its size and two 64-bit sums over its elements: what tells it from other sets."""
    n = np.bincount(doc, minlength=count)
    start = np.cumsum(n) - n
    sums = []
    for salt in (1, 2):
        total = np.zeros(len(elements) + 1, dtype=np.uint64)
        np.cumsum(mix(mix(elements) + np.uint64(salt)), out=total[1:])
        sums.append((total[start + n] - total[start]).view(np.int64))
    return [n, *sums]


SKETCH = "doc_id bigint, text_hash bigint, row_hash bigint, n_shingles bigint, set_a bigint, set_b bigint, bands array<bigint>, bits array<bigint>"


def sketch(docs: DataFrame, words: int) -> DataFrame:
    """Hashes of the text and of the whole row, set size, two 64-bit sums that name the set, and the band keys of every row."""

    def run(batches):
        for batch in row_batches(batches):
            for first, texts in slices(batch.column(1)):
                elements, doc = _sets(texts, words)
                n, *sums = _names(elements, doc, len(texts))
                banded = np.flatnonzero(n >= LEAST_SET)
                number = np.zeros(len(texts), dtype=np.int64)
                number[banded] = np.arange(len(banded))
                mine = (n >= LEAST_SET)[doc]
                slots = signatures(elements[mine], number[doc[mine]], len(banded))
                upto = np.concatenate([[0], np.cumsum(n >= LEAST_SET)]).astype(np.int32)
                lists = [
                    pa.ListArray.from_arrays(pa.array(upto * values.shape[1]), pa.array(values.ravel().view(np.int64)))
                    for values in (band_keys(slots), packed_bits(slots))
                ]
                yield pa.RecordBatch.from_arrays(
                    [*(batch.column(c).slice(first, len(texts)) for c in (0, 2, 3)), pa.array(n), *map(pa.array, sums), *lists],
                    names=["doc_id", "text_hash", "row_hash", "n_shingles", "set_a", "set_b", "bands", "bits"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text", F.xxhash64("text"), row_hash(docs)).mapInArrow(run, SKETCH)


def row_hash(docs: DataFrame) -> Column:
    """A hash of all columns that can be hashed (maps can't)."""
    return F.xxhash64(*[F.col(f"`{n}`") for n, kind in docs.dtypes if "map<" not in kind and kind != "variant"])


def sets(docs: DataFrame, words: int) -> DataFrame:
    """doc_id, what names its set, and the set's elements."""

    def run(batches):
        for batch in row_batches(batches):
            for first, texts in slices(batch.column(1)):
                elements, doc = _sets(texts, words)
                n, *sums = _names(elements, doc, len(texts))
                offsets = np.zeros(len(texts) + 1, dtype=np.int32)
                np.cumsum(n, out=offsets[1:])
                held = pa.ListArray.from_arrays(pa.array(offsets), pa.array(elements.view(np.int64)))
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, len(texts)), pa.array(n), *map(pa.array, sums), held],
                    names=["doc_id", "n_shingles", "set_a", "set_b", "elements"],
                )

    return docs.select(F.col("doc_id").cast("bigint"), "text").mapInArrow(
        run, "doc_id bigint, n_shingles bigint, set_a bigint, set_b bigint, elements array<bigint>"
    )


def confirm(pairs: DataFrame, full: DataFrame, percent: int) -> DataFrame:
    """Those of ``pairs`` (a, b) whose full sets are similar enough."""
    left = full.select(F.col("key").alias("a"), F.col("elements").alias("x"))
    right = full.select(F.col("key").alias("b"), F.col("elements").alias("y"))
    both = pairs.join(right, "b").join(left, "a")
    shared = F.size(F.array_intersect("x", "y"))
    similar = 100 * shared >= percent * (F.size("x") + F.size("y") - shared)
    return both.filter(similar).select("a", "b")


def _sizes_fit(percent: int) -> Column:
    return 100 * F.least("an", "bn") >= percent * F.greatest("an", "bn")


def _found(docs: DataFrame, words: int, percent: int) -> DataFrame:
    """doc_id, text_hash, row_hash, n_shingles, c, component_id of every row of ``docs`` (doc_id, text).

    ``c`` tells components apart whose least doc_id is the same; it is null for empty sets and rows without doc_id.
    """
    sketched = materialize(sketch(docs, words))
    name = ["n_shingles", "set_a", "set_b"]
    filled = sketched.filter("n_shingles > 0 AND doc_id IS NOT NULL").select("doc_id", *name)
    classes = filled.groupBy(*name).agg(F.min("doc_id").alias("rep"))
    classes = materialize(classes.withColumn("key", F.monotonically_increasing_id()))
    heads = classes.filter(F.col("n_shingles") >= LEAST_SET).select(F.col("rep").alias("doc_id"), *name, "key")
    # Repeated rows of a class and doc_id are equal here.
    start = materialize(sketched.join(heads, ["doc_id", *name]).dropDuplicates(["key"]).select("key", F.col("n_shingles").alias("n"), "bits", "bands"))
    banded = start.select("key", F.explode("bands").alias("band"))
    several = banded.groupBy("band").agg(F.count("*").alias("members")).filter("members > 1").select("band")
    banded = materialize(banded.join(several, "band"))

    met = materialize(heads.join(banded.select("key").distinct(), "key", "left_semi"))
    # As at scale: the ids are too many to broadcast.
    ids = met.select("doc_id").distinct().hint("merge")
    found = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text").join(ids, "doc_id", "left_semi")
    # Rows that share a doc_id may hold several sets; the class's own is told by its size and sums.
    full = sets(found, words).join(met, ["doc_id", *name]).dropDuplicates(["key"])
    full = materialize(full.select("key", "elements"))
    facts = materialize(start.join(met.select("key"), "key", "left_semi").select("key", "n", "bits"))
    discard(start, met)

    def known(pairs: DataFrame) -> DataFrame:
        sides = facts.toDF("b", "bn", "bbits"), facts.toDF("a", "an", "abits")
        return pairs.join(sides[0], "b").join(sides[1], "a").filter(_sizes_fit(percent))

    def promising(pairs: DataFrame) -> DataFrame:
        # What is passed over here stays open, so the leeway may be small.
        likely = known(pairs).filter(looks_similar("abits", "bbits", percent, SMALL_LEEWAY))
        order = F.shiftleft(differing_bits("abits", "bbits").cast("bigint"), 48) + F.col("a") % (1 << 47)
        return likely.groupBy("b").agg(F.min_by("a", order).alias("a")).select("a", "b")

    def rest(open_: DataFrame) -> DataFrame:
        return candidates(full.join(open_, "key"), percent, facts, looks_similar("abits", "bbits", percent))

    groups = linked(banded, promising, lambda pairs: confirm(pairs, full, percent), rest)
    discard(banded, facts, full)
    held = classes.join(groups, "key", "left").select(*name, "rep", F.coalesce("c", "key").alias("c"))
    least = held.groupBy("c").agg(F.min("rep").alias("component_id"))
    named = held.join(least, "c").select(*name, "c", "component_id")
    return (
        sketched.select("doc_id", "text_hash", "row_hash", *name)
        .join(named, name, "left")
        .select("doc_id", "text_hash", "row_hash", "n_shingles", F.when(F.col("doc_id").isNotNull(), F.col("c")).alias("c"), F.when(F.col("doc_id").isNotNull(), F.coalesce("component_id", "doc_id")).alias("component_id"))
    )


def near_duplicates(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """doc_id, n_shingles, component_id of every row of ``docs`` (doc_id, text)."""
    return _found(docs, words, percent).select("doc_id", "n_shingles", "component_id")


def keep_first(docs: DataFrame, words: int = 5, percent: int = 80) -> DataFrame:
    """One row of each group of near copies, with all its columns: that of the least doc_id.

    Of several rows of that doc_id the one of least hash over its columns stays. Rows with empty sets
    are one group if doc_id and text are equal. Rows without ``doc_id`` all stay.
    """
    found = _found(docs, words, percent).filter("doc_id IS NOT NULL")
    group = [F.col("c"), F.when(F.col("c").isNull(), F.col("doc_id")).alias("own"), F.when(F.col("c").isNull(), F.col("text_hash")).alias("same")]
    copies = found.groupBy(*group, "doc_id", "row_hash").agg(F.count("*").alias("copies"))
    least = copies.groupBy("c", "own", "same").agg(F.min(F.struct("doc_id", "row_hash", "copies")).alias("least"))
    mark, repeated = (f"_{uuid.uuid4().hex}" for _ in range(2))
    stay = least.select(F.col("least.row_hash").alias(mark), F.col("least.doc_id").alias("_doc_id_"), (F.col("least.copies") > 1).alias(repeated))
    named = docs.filter(F.col("doc_id").isNotNull()).withColumn(mark, row_hash(docs))
    kept = named.join(stay, (named[mark] == stay[mark]) & (named["doc_id"].cast("bigint") == stay["_doc_id_"])).select(named["*"], repeated)
    once = kept.filter(~F.col(repeated)).select(docs.columns)
    folded = kept.filter(repeated).dropDuplicates([mark]).select(docs.columns)
    return once.union(folded).union(docs.filter(F.col("doc_id").isNull()))


def op9_near_dedup(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    found = near_duplicates(docs, words=2, percent=80)
    return found.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))
