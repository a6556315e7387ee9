"""Pairs of sets that can be similar enough, by the prefixes of their rarest elements.

Two sets with |x| <= |y| and 100 * |x and y| >= percent * |x or y| share at least
2 * percent / (100 + percent) * |x| elements and percent / 100 * |y| elements. So in any order of all elements,
one of the first ``|x| - that + 1`` of x is among the first ``|y| - that + 1`` of y. Rare
elements go first: sets that share much of a template but have enough elements of their own
meet nowhere. The first shared element also has to stand early enough in both for the rest to
suffice. How many sets hold an element is counted, not estimated: an estimate that blurs as elements
grow in number lets common elements into the prefixes. Elements that one component holds alone come first of all
and make no row.

What two sets do not share is at least their elements held by one component alone and the bits in which their maps
of the other elements differ; a pair for which this is too much makes no row either, and no similar pair is among those.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from folioworks.session import discard, materialize

#: 64-bit integers in the map of a set.
MAP = 16


def _as_long(percent: int) -> str:
    """Elements in the prefix of a set as the larger of a pair. Shares are rounded up in integers; one element at least is left."""
    return f"n - (({percent} * n + 99) DIV 100) + 1"


def _as_short(percent: int) -> str:
    return f"n - (({2 * percent} * n + {99 + percent}) DIV {100 + percent}) + 1"


def held_across(sets: DataFrame, percent: int) -> DataFrame:
    """key, c, n, own, first, map of those of ``sets`` (key, c, elements) that share elements with other components.

    Of the n elements ``own`` are held by one component alone. ``map`` has a bit for each of the others; two on one
    bit cancel out. ``first`` has those of them that are in the prefix, as (sets that hold it, element), rarest first.
    """
    each = sets.select("key", "c", F.size("elements").cast("bigint").alias("n"), F.explode("elements").alias("element"))
    counted = each.groupBy("element").agg(F.count("*").alias("sets"), F.min("c").alias("lo"), F.max("c").alias("hi"))
    across = each.join(counted.filter("lo <> hi").select("element", "sets"), "element")
    across = across.withColumn("place", F.pmod(F.xxhash64("element"), F.lit(64 * MAP)))
    words = [F.expr(f"bit_xor(IF(place DIV 64 = {w}, shiftleft(1L, CAST(place % 64 AS INT)), 0L))") for w in range(MAP)]
    # Rows of one set go to one task first, so that no map is moved.
    across = across.select("key", "c", "n", "sets", "element", "place").repartition("key")
    made = across.groupBy("key", "c", "n").agg(F.sort_array(F.collect_list(F.struct("sets", "element"))).alias("held"), F.array(*words).alias("map"))
    made = made.withColumn("own", F.col("n") - F.size("held"))
    return made.select("key", "c", "n", "own", _cut("held", _as_long(percent)).alias("first"), "map")


def _cut(held: str, length: str) -> Column:
    """Of the elements of a set that others hold, those within the first ``length`` of all."""
    return F.expr(f"slice({held}, 1, CAST(greatest({length} - own, 0) AS INT))")


def prefixes(known: DataFrame, percent: int) -> DataFrame:
    """slot, key, c, n, at, short: the prefix elements of every set of ``known`` (``held_across``) and their places.

    ``short`` rows are those that a set has when it is the smaller of a pair.
    """

    def rows(length: str, short: bool) -> DataFrame:
        some = known.select("key", "c", "n", "own", F.posexplode(_cut("first", length)).alias("at", "one"))
        return some.select(F.col("one.element").alias("slot"), "key", "c", "n", (F.col("own") + F.col("at")).alias("at"), F.lit(short).alias("short"))

    return rows(_as_long(percent), False).union(rows(_as_short(percent), True))


def differing(one: str, other: str) -> Column:
    """Bits in which two maps differ."""
    return sum((F.bit_count(F.col(one)[w].bitwiseXOR(F.col(other)[w])) for w in range(MAP)), F.lit(0))


def candidates(sets: DataFrame, percent: int, marks: DataFrame | None = None, alike: Column | None = None) -> DataFrame:
    """Distinct pairs a < b of ``sets`` (key, c, elements) with different c that hold all similar ones.

    In a slot, members of its most frequent component meet only the members of others. With ``marks`` (key, bits)
    a pair must also be ``alike``, a test of ``abits`` and ``bbits`` that does not depend on their order: what
    fails it makes no row, whatever the slots that a pair shares.
    """
    known = materialize(held_across(sets, percent))
    every = materialize(prefixes(known, percent))
    sizes = every.groupBy("slot", "c").agg(F.count("*").alias("rows"), F.max("short").alias("as_short"), F.min("short").alias("as_long"))
    several = sizes.groupBy("slot").agg(F.max_by("c", "rows").alias("main"), F.count("*").alias("held_by"), F.max("as_short").alias("as_short"), F.min("as_long").alias("as_long"))
    several = several.filter("held_by > 1 AND as_short AND NOT as_long").select("slot", "main")
    rows = every.join(several, "slot").select("slot", "key", "n", "c", "at", "short", (F.col("c") != F.col("main")).alias("other"))
    facts = known.select("key", "own", "map")
    rows = materialize(rows.join(facts if marks is None else facts.join(marks.select("key", "bits"), "key"), "key"))
    discard(known, every)
    kept = ["own", "map"] if marks is None else ["own", "map", "bits"]
    short = rows.filter("short").select("slot", F.col("key").alias("a"), F.col("c").alias("ac"), F.col("n").alias("an"), F.col("at").alias("i"), F.col("other").alias("a_other"), *[F.col(x).alias(f"a{x}") for x in kept])
    long = rows.filter("NOT short").select("slot", F.col("key").alias("b"), F.col("c").alias("bc"), F.col("n").alias("bn"), F.col("at").alias("j"), F.col("other").alias("b_other"), *[F.col(x).alias(f"b{x}") for x in kept])
    fits = (F.col("an") <= F.col("bn")) & (100 * F.col("an") >= percent * F.col("bn")) & (F.col("ac") != F.col("bc"))
    # Nothing before the first element that both hold is shared, so what comes from there on must do.
    left = F.least(F.col("an") - F.col("i"), F.col("bn") - F.col("j"))
    fits &= (100 + percent) * left >= percent * (F.col("an") + F.col("bn"))
    apart = F.col("aown") + F.col("bown") + differing("amap", "bmap")
    fits &= (100 + percent) * apart <= (100 - percent) * (F.col("an") + F.col("bn"))
    if marks is not None and alike is not None:
        fits &= alike
    found = short.filter("a_other").join(long, ["slot"]).filter(fits)
    found = found.union(short.filter("NOT a_other").join(long.filter("b_other"), ["slot"]).filter(fits).select(found.columns))
    return found.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).distinct()
