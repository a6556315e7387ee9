"""Fingerprints that keep edit distance: a shared random walk over the characters, sampled bit by bit.

1. A text is walked with a pointer that emits the character under it at every step and then
   either stays or moves on, as a random bit of (step, character) says that all texts share.
   After an edit, the walks of two texts meet again within a number of steps that depends on the number of
   edits only, so edit distance becomes Hamming distance between what is emitted.
   How long the pointer stays on a character depends on the step of its arrival alone. A
   table of next arrivals turns the walk into one look-up per character.
2. The fingerprint holds one random bit of (step, character) at sampled steps: the first
   ``SAMPLES`` and then as many of each octave, so texts of any two lengths share samples. It is
   written as the number of steps and the bits in base 64.
3. ``likeness`` weighs the agreement of each octave with its number of steps. Bits of different
   characters agree half the time, so 2 * agreement - 1 estimates the share of equal steps.
4. ``near_groups`` bands sampled bits, compares the members of a band with a few leads each, verifies
   by exact edit distance and groups the links (``linking``, ``components``).

``with_next`` pairs each row with the next one in the order of doc_id by one range exchange of
the texts: each part is walked backwards with one text held, and only the first and the last row
of each part are joined afterwards.

Defined results: a null text is empty; an empty text has the fingerprint ``0.``, is like itself
(1) and unlike any other (0). Rows without ``doc_id`` come first. Rows of one doc_id follow each other in the
order of their text's hash, so a repeated row is its own copy's next. One row alone is its own
next; an empty table gives none. Other columns are not read. Characters fall in 256 classes by hash;
characters of one class are alike to the walk, never to the verification.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioworks.llm.linking import linked
from folioworks.llm.words import mix, row_batches
from folioworks.session import materialize

CLASSES = 256
#: Steps after which the shared random bits repeat.
PERIOD = 4096
#: Sampled steps of each octave, and octaves.
SAMPLES, OCTAVES = 128, 34


def _next_arrivals() -> list[list[int]]:
    """Of each class and step (modulo PERIOD), the step at which the next character is reached."""
    numbers = list(range(PERIOD))
    table = []
    for kind in range(CLASSES):
        moves = mix(np.arange(PERIOD, dtype=np.uint64) * np.uint64(CLASSES) + np.uint64(kind)) >> np.uint64(63)
        at = np.flatnonzero(moves)
        following = np.append(at, at[0] + PERIOD)[np.searchsorted(at, np.arange(PERIOD))]
        table.append([numbers[i] for i in ((following + 1) % PERIOD).tolist()])
    return table


def _sampled_steps() -> tuple[np.ndarray, np.ndarray]:
    """Sampled steps in ascending order, and the number of the first sample of each octave."""
    parts = [np.arange(SAMPLES, dtype=np.int64)]
    low = SAMPLES
    for octave in range(OCTAVES):
        draw = mix(np.arange(4 * SAMPLES, dtype=np.uint64) + np.uint64((octave + 1) << 32))
        steps = low + (draw % np.uint64(low)).astype(np.int64)
        _, first = np.unique(steps, return_index=True)
        parts.append(np.sort(steps[np.sort(first)[:SAMPLES]]))
        low *= 2
    return np.concatenate(parts), np.cumsum([0, *map(len, parts)])


_NEXT = _next_arrivals()
STEPS, _FIRST = _sampled_steps()
#: First step of each octave, and of the one after the last.
_LOW = np.array([0, *(SAMPLES << i for i in range(OCTAVES + 1))], dtype=np.int64)
_BITS = (mix(np.arange(len(STEPS) * CLASSES, dtype=np.uint64) + np.uint64(1 << 50)) >> np.uint64(63)).astype(np.uint8)
_KIND = (mix(np.arange(1 << 16, dtype=np.uint64)) % np.uint64(CLASSES)).astype(np.uint8)


def classes(text: str) -> np.ndarray:
    """The class of each code point."""
    points = np.frombuffer(text.encode("utf-32-le"), dtype=np.uint32)
    return _KIND[(points ^ (points >> np.uint32(16))) & np.uint32(0xFFFF)]


def arrivals(kinds: np.ndarray, start: int = 0) -> np.ndarray:
    """The step at which each character is reached, and the one after the last; ``start`` is that of the first."""
    a = start % PERIOD
    found = np.empty(len(kinds) + 1, dtype=np.int64)
    found[0] = a
    found[1:] = array("i", [a := row[a] for row in map(_NEXT.__getitem__, kinds.tobytes())])
    # A stay is far shorter than the period: a smaller step means that it was passed.
    found[1:] += np.cumsum(found[1:] <= found[:-1]) * PERIOD
    return found + (start - start % PERIOD)


class Fingerprint:
    """Number of steps, and one bit for each sampled step."""

    def __init__(self, kinds: np.ndarray, reached: np.ndarray):
        self.steps = int(reached[-1])
        n = int(np.searchsorted(STEPS, self.steps))
        at = np.searchsorted(reached, STEPS[:n], side="right") - 1
        self.bits = _BITS[np.arange(n) * CLASSES + kinds[at]]

    def __str__(self) -> str:
        return f"{self.steps:x}." + base64.b64encode(np.packbits(self.bits).tobytes()).decode().rstrip("=")


def of_text(text: str) -> Fingerprint:
    kinds = classes(text)
    return Fingerprint(kinds, arrivals(kinds))


def parse(written: str) -> Fingerprint:
    """The fingerprint that ``str`` wrote."""
    made = Fingerprint.__new__(Fingerprint)
    steps, bits = written.split(".")
    made.steps = int(steps, 16)
    n = int(np.searchsorted(STEPS, made.steps))
    made.bits = np.unpackbits(np.frombuffer(base64.b64decode(bits + "=" * (-len(bits) % 4)), dtype=np.uint8))[:n]
    return made


def likeness(one: Fingerprint, other: Fingerprint) -> float:
    """Estimated share, 0 to 1, of the steps of the longer walk at which both are on equal characters."""
    short, long = sorted((one.steps, other.steps))
    if not short:
        return float(short == long)
    n = min(len(one.bits), len(other.bits))
    edges = _FIRST[: int(np.searchsorted(_FIRST, n))]
    agreed = np.add.reduceat((one.bits[:n] == other.bits[:n]).astype(np.int64), edges)
    sampled = np.diff(np.append(edges, n))
    span = np.minimum(_LOW[1 : len(edges) + 1], short) - _LOW[: len(edges)]
    return float(np.clip((span * (2 * agreed / sampled - 1)).sum() / long, 0, 1))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, fingerprint of every row of ``docs`` (doc_id, text); nothing is shuffled."""

    def run(batches):
        for batch in row_batches(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            columns = [pa.array([len(t) for t in texts], pa.int64()), pa.array([str(of_text(t)) for t in texts], pa.string())]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["doc_id", "n_chars", "fingerprint"])

    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    return rows.mapInArrow(run, "doc_id bigint, n_chars bigint, fingerprint string")


RESULT = "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_NAMES = [x.split()[0] for x in RESULT.split(", ")]


class _Walked:
    """A text, its walk and its fingerprint."""

    def __init__(self, text: str):
        self.text, self.kinds = text, classes(text)
        self.reached = arrivals(self.kinds)
        self.print = Fingerprint(self.kinds, self.reached)

    def edited(self, following: _Walked) -> tuple[str, Fingerprint]:
        """Hash and fingerprint of this text with its last half replaced by the beginning of the next; the first half isn't walked again."""
        half = len(self.text) // 2
        kept = len(self.text) - half
        more = following.kinds[:half]
        reached = np.concatenate([self.reached[:kept], arrivals(more, int(self.reached[kept]))])
        text = self.text[:kept] + following.text[:half]
        return hashlib.sha256(text.encode()).hexdigest(), Fingerprint(np.concatenate([self.kinds[:kept], more]), reached)

    def row(self, doc_id: int | None, following: _Walked) -> tuple:
        digest, edited = self.edited(following)
        return (doc_id, len(self.text), digest, str(self.print), str(edited), likeness(self.print, edited), likeness(self.print, following.print))


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)


_DONE = [("doc_id", pa.int64()), ("n_chars", pa.int64()), *((n, pa.string()) for n in _NAMES[2:5]), *((n, pa.float64()) for n in _NAMES[5:])]


def with_next(docs: DataFrame) -> DataFrame:
    """RESULT of every row of ``docs`` (doc_id, text), beside the next row in the order of doc_id; after the last comes the first."""
    schema = pa.schema([*_DONE, ("part", pa.int64()), ("text", pa.string()), ("place", pa.string())])
    no_facts = (None,) * (len(_NAMES) - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        following, doc_id = None, None
        for batch in row_batches(batches, 500):
            made = []
            for doc_id, text in zip(*(c.to_pylist() for c in batch.columns[:2]), strict=True):
                here = following if following and following.text == (text or "") else _Walked(text or "")
                if following:
                    made.append((*here.row(doc_id, following), None, None, None))
                else:
                    made.append((doc_id, *no_facts, part, here.text, "last"))
                following = here
            if made:
                yield _batch(made, schema)
        if following:
            yield _batch([(doc_id, *no_facts, part, following.text, "first")], schema)

    # Copies of one row are told apart by their place in the input, so they may span several parts.
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
    rows = rows.withColumn("row", F.monotonically_increasing_id())
    order = ["doc_id", "h", "row"]
    backwards = rows.repartitionByRange(*order).sortWithinPartitions(*(F.col(c).desc() for c in order))
    walked = materialize(backwards.select("doc_id", "text").mapInArrow(run, f"{RESULT}, part bigint, text string, place string"))

    ends = walked.filter("place IS NOT NULL").select("part", "place", "doc_id", "text")
    first = ends.filter("place = 'first'").select("part", F.col("text").alias("next_text"))
    parts = first.select("part")
    follows = F.lead("part").over(Window.orderBy("part"))
    least = F.min("part").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    parts = parts.select("part", F.coalesce(follows, least).alias("next_part"))
    last = ends.filter("place = 'last'").join(parts, "part").join(first.withColumnRenamed("part", "next_part"), "next_part")

    def join(batches):
        for batch in row_batches(batches, 100):
            if batch.num_rows:
                rows = zip(*(c.to_pylist() for c in batch.columns), strict=True)
                yield _batch([_Walked(text).row(doc_id, _Walked(more)) for doc_id, text, more in rows], pa.schema(_DONE))

    closed = last.select("doc_id", "text", "next_text").mapInArrow(join, RESULT)
    return walked.filter("place IS NULL").select(_NAMES).union(closed)


#: Bands of each of two octaves, and bits of a band; edits per character that near texts may have.
BANDS, BAND_BITS, SHARE = 20, 32, 0.02
_PICKED = np.stack([
    np.argsort(mix(np.arange(SAMPLES - 8, dtype=np.uint64) + np.uint64((b + 1) << 20)), kind="stable")[:BAND_BITS] for b in range(BANDS)
])


def band_keys(made: Fingerprint) -> list[int]:
    """Keys of the bands: sampled bits of the two last octaves that the walk fills.

    Walks whose lengths lie on both sides of a power of two share an octave. A walk that fills none has no bands.
    """
    full = int(np.searchsorted(_LOW, made.steps, side="right")) - 2
    keys = []
    for octave in range(max(0, full - 1), full + 1):
        bits = made.bits[_FIRST[octave] : _FIRST[octave + 1]]
        values = (bits[_PICKED].astype(np.uint64) << np.arange(BAND_BITS, dtype=np.uint64)).sum(axis=1, dtype=np.uint64)
        numbers = np.arange(BANDS, dtype=np.uint64) + np.uint64(octave * BANDS + 1)
        keys += mix(mix(values) ^ mix(numbers << np.uint64(40))).view(np.int64).tolist()
    return keys


def edit_distance(one: str, other: str) -> int:
    """Insertions, deletions and replacements between two texts: a column of the table in the bits of one integer."""
    low = 0
    while low < min(len(one), len(other)) and one[low] == other[low]:
        low += 1
    one, other = one[low:], other[low:]
    while one and other and one[-1] == other[-1]:
        cut = next((i for i, (x, y) in enumerate(zip(reversed(one), reversed(other))) if x != y), min(len(one), len(other)))
        one, other = one[: len(one) - cut], other[: len(other) - cut]
    if not one or not other:
        return len(one) + len(other)
    places: dict[str, int] = {}
    for i, c in enumerate(one):
        places[c] = places.get(c, 0) | 1 << i
    every, last = (1 << len(one)) - 1, 1 << len(one) - 1
    up, down, distance = every, 0, len(one)
    for c in other:
        same = places.get(c, 0)
        level = ((same & up) + up ^ up) | same
        raised, lowered = down | every & ~(level | up), up & level
        distance += bool(raised & last) - bool(lowered & last)
        raised, lowered = raised << 1 | 1, lowered << 1
        same |= down
        up, down = (lowered | ~(same | raised)) & every, raised & same & every
    return distance


def near_groups(docs: DataFrame, share: float = SHARE) -> DataFrame:
    """doc_id, n_chars, component_id of every row of ``docs`` (doc_id, text): the least doc_id reachable over near texts.

    Texts are near if their edit distance is at most ``share`` of the longer one's length; equal texts are one
    class. Links are found by bands, so a pair with few edits is missed with the probability that the walks stay apart;
    every link made is confirmed by its edit distance. Texts that fill no octave (some 64 characters), and empty ones, are linked with
    their equals only. Rows without ``doc_id`` have no component.
    """
    columns = "doc_id bigint, n_chars bigint, mark string, bands array<bigint>"

    def run(batches):
        for batch in row_batches(batches):
            texts = [t or "" for t in batch.column(1).to_pylist()]
            bands = pa.array([band_keys(of_text(t)) for t in texts], pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([len(t) for t in texts], pa.int64()), batch.column(2), bands], names=["doc_id", "n_chars", "mark", "bands"]
            )

    filled = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), filled.alias("text"), F.md5(filled.cast("binary")).alias("mark"))
    sketched = materialize(rows.mapInArrow(run, columns))
    named = sketched.filter("doc_id IS NOT NULL")
    classes = named.groupBy("mark").agg(F.min("doc_id").alias("rep"))
    classes = materialize(classes.withColumn("key", F.monotonically_increasing_id()))
    heads = named.join(classes, "mark").filter("doc_id = rep").dropDuplicates(["key"])
    banded = heads.select("key", F.explode("bands").alias("band"))
    several = banded.groupBy("band").agg(F.count("*").alias("n")).filter("n > 1").select("band")
    banded = materialize(banded.join(several, "band"))
    met = classes.join(banded.select("key").distinct(), "key", "left_semi")
    texts = rows.join(met.select(F.col("rep").alias("doc_id"), "mark", "key"), ["doc_id", "mark"]).dropDuplicates(["key"])
    texts = materialize(texts.select("key", "text", F.length("text").alias("n")))

    def confirm(pairs: DataFrame) -> DataFrame:
        def measure(batches):
            for batch in batches:
                ends = zip(batch.column(2).to_pylist(), batch.column(3).to_pylist(), strict=True)
                yield batch.filter(pa.array([edit_distance(x, y) <= share * max(len(x), len(y)) for x, y in ends], pa.bool_())).select(["a", "b"])

        right, left = texts.toDF("b", "y", "m"), texts.toDF("a", "x", "n")
        both = pairs.join(right, "b").join(left, "a").filter(F.abs(F.col("n") - F.col("m")) <= share * F.greatest("n", "m"))
        return both.select("a", "b", "x", "y").mapInArrow(measure, "a bigint, b bigint")

    def rest(open_: DataFrame) -> DataFrame:
        known = banded.join(open_, "key")
        sizes = known.groupBy("band", "c").agg(F.count("*").alias("held"))
        main = sizes.groupBy("band").agg(F.max_by("c", "held").alias("main"), F.count("*").alias("several")).filter("several > 1")
        placed = known.join(main.select("band", "main"), "band").withColumn("other", F.col("c") != F.col("main"))
        one, other = placed.filter("other").toDF("band", "a", "ac", "am", "ao"), placed.toDF("band", "b", "bc", "bm", "bo")
        # Members of the most frequent component of a band meet those of the others only.
        pairs = one.join(other, (one["band"] == other["band"]) & (F.col("ac") != F.col("bc")) & (~F.col("bo") | (F.col("a") < F.col("b"))))
        return pairs.select("a", "b").distinct()

    groups = linked(banded, lambda pairs: pairs.groupBy("b").agg(F.min("a").alias("a")).select("a", "b"), confirm, rest)
    held = classes.join(groups, "key", "left").select("mark", "rep", F.coalesce("c", "key").alias("c"))
    least = held.groupBy("c").agg(F.min("rep").alias("component_id"))
    found = sketched.select("doc_id", "n_chars", "mark").join(held.join(least, "c").select("mark", "component_id"), "mark", "left")
    return found.select("doc_id", "n_chars", F.when(F.col("doc_id").isNotNull(), F.col("component_id")).alias("component_id"))


def op11_edit_fingerprint(spark, sf_dir: str) -> DataFrame:
    return with_next(spark.read.parquet(f"{sf_dir}/documents.parquet"))
