"""Connected components of a table of links, in a bounded number of joins and aggregations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from folioworks.session import discard, materialize


def forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Links of a batch replaced by links from each node to the least node that it reaches there.

    Union-find with path halving over one Arrow batch at a time, so memory stays that of a batch.
    """
    for batch in batches:
        if not batch.num_rows:
            continue
        ends = np.column_stack([batch.column(0).to_numpy(), batch.column(1).to_numpy()])
        nodes, at = np.unique(ends, return_inverse=True)
        parent = list(range(len(nodes)))
        for a, b in at.reshape(ends.shape).tolist():
            while parent[a] != a:
                parent[a] = parent[parent[a]]
                a = parent[a]
            while parent[b] != b:
                parent[b] = parent[parent[b]]
                b = parent[b]
            if a != b:
                parent[max(a, b)] = min(a, b)
        for i in range(len(parent)):
            parent[i] = parent[parent[i]]
        moved = np.flatnonzero(np.array(parent) != np.arange(len(parent)))
        yield pa.RecordBatch.from_arrays(
            [pa.array(nodes[moved]), pa.array(nodes[np.array(parent)[moved]])], names=["a", "b"]
        )


#: Contracted links that one task joins at the end, some 2 MB; more go through the rounds.
ONE_TASK = 100_000


def _joined_in_one(edges: DataFrame) -> DataFrame:
    """The same hanging of nodes by union-find in one task, for at most ONE_TASK links."""

    def run(batches):
        held = [b for b in batches if b.num_rows]
        if held:
            yield from forest(iter(pa.Table.from_batches(held).combine_chunks().to_batches()))

    return edges.repartition(1).mapInArrow(run, "a bigint, b bigint")


def components(links: DataFrame, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component) of every node in ``links`` (a, b); a component is named by its least node.

    Batches are first contracted by union-find, then alternating large-star and small-star
    steps hang every node on the least node it can see, until nothing changes. No step
    gathers the neighbours of a node: each takes a minimum and joins it back, so a node
    with very many links is split like any skewed join. Each round is written to the shared
    folder. As soon as no more than ``one_task`` links are left, one task joins them, with the same
    result. An empty table gives an empty one.
    """
    schema = "a bigint, b bigint"
    edges = links.select(F.col("a").cast("bigint").alias("a"), F.col("b").cast("bigint").alias("b")).filter("a <> b")
    edges = materialize(edges.mapInArrow(forest, schema).distinct())
    while edges.count() > one_task:
        both = edges.union(edges.select("b", "a"))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.filter("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        down = large.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        low = down.groupBy("a").agg(F.min("b").alias("m"))
        small = down.join(low, "a").select(F.explode(F.array(F.struct("a", F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e"))
        hung = materialize(small.select("e.a", "e.b").filter("a <> b").distinct())
        discard(edges)
        edges = hung
        # Finished when every node hangs on one node that hangs on none.
        one_each = edges.agg((F.count("*") == F.countDistinct("a")).alias("yes")).first().yes
        if one_each and edges.join(edges.select(F.col("b").alias("a")).distinct(), "a", "left_semi").isEmpty():
            break
    else:
        edges = materialize(_joined_in_one(edges))
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select("b", "b").distinct())
