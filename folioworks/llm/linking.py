"""Groups of similar members, from bands they share, without comparing all members of a band.

Every band has a lead in every round: its least member at first, then the first of an order of
its own. A member of another component looks at the leads of its bands, at one in the first round and
four times as many in each further one (those that linked need none), and is compared with the one
most like it by estimate. Bands whose members are all in one component are done. After a round
without links, or ``ROUNDS``, ``rest`` names the pairs across components that are still to be compared.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.llm.components import components
from folioworks.session import discard, materialize

ROUNDS = 4


def linked(
    bands: DataFrame,
    promising: Callable[[DataFrame], DataFrame],
    confirm: Callable[[DataFrame], DataFrame],
    rest: Callable[[DataFrame], DataFrame],
) -> DataFrame:
    """key, c: every member that has a link, and the least key of its component.

    ``bands`` (band, key) holds one row per member and band. ``promising`` takes pairs (a, b) and
    returns the one likeliest link of each b, if any is likely. ``confirm`` takes pairs (a, b) and
    returns those that are links. ``rest`` takes members (key, c) and returns pairs of different
    components that hold all links between them.
    """
    spread = bands.groupBy("band").agg(F.min("key").alias("lead"), F.max("key").alias("most")).filter("lead <> most")
    shared = materialize(bands.join(spread.select("band", "lead"), "band").select("band", "key", F.col("key").alias("c"), "lead"))
    groups = None
    for turn in range(ROUNDS):
        if turn:
            # Another order of the keys in each band; applied twice it gives the key.
            shuffled = F.col("key").bitwiseXOR(F.shiftrightunsigned(F.xxhash64("band", F.lit(turn)), 2))
            named = shared.select("band", "key").join(groups, "key", "left").select("band", "key", F.coalesce("c", "key").alias("c"))
            spans = named.groupBy("band").agg(F.min("c").alias("lo"), F.max("c").alias("hi"), F.min(shuffled).alias("first")).filter("lo <> hi")
            lead = F.col("first").bitwiseXOR(F.shiftrightunsigned(F.xxhash64("band", F.lit(turn)), 2)).alias("lead")
            open_ = materialize(named.join(spans.select("band", lead), "band"))
            discard(shared)
            shared = open_
            if shared.isEmpty():
                break
            known = groups.select(F.col("key").alias("lead"), F.col("c").alias("lead_c"))
            across = shared.join(known, "lead", "left").filter(F.coalesce("lead_c", "lead") != F.col("c"))
        else:
            across = shared.filter("key <> lead")
        looks = F.pmod(F.xxhash64("band"), F.lit(4**turn))
        pairs = across.groupBy(F.col("key").alias("b"), looks.alias("look")).agg(F.min("lead").alias("a")).select("a", "b").distinct()
        links = materialize(confirm(promising(pairs)))
        none = links.isEmpty()
        if not none:
            merged = _merged(groups, links)
            if groups is not None:
                discard(groups)
            groups = merged
        discard(links)
        if none and turn:
            break
        if groups is None:
            groups = shared.select("key", "c").limit(0)
    open_ = shared.select("key").distinct().join(groups, "key", "left").select("key", F.coalesce("c", "key").alias("c"))
    links = materialize(confirm(rest(open_)))
    if not links.isEmpty():
        groups = _merged(groups, links)
    discard(links)
    return groups


def _merged(groups: DataFrame | None, links: DataFrame) -> DataFrame:
    """``groups`` (key, c) and ``links`` (a, b) as one set of components."""
    known = links.select("a", "b")
    if groups is not None:
        known = known.union(groups.filter("key <> c").select("key", "c"))
    return materialize(components(known).toDF("key", "c"))
