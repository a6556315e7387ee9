"""Approximate nearest neighbours by inner product: balanced posting lists around centroids.

Centroids are fitted on a bounded sample in one task, with large clusters split, and linked
by a neighbour graph that every task holds in memory. Every vector is then indexed: a beam
search of the graph finds its nearest centroids, and a vector near a boundary enters all
lists whose distance is within ``REPLICATE`` times the least one. Queries search the same
graph and open lists, nearest first, until these hold 2 * ``COPIES`` * (k + 1) vec_ids, then all
lists within ``PRUNE`` times the distance reached, or times that of a typical query if it is
more. A query that still has fewer than ``k`` rows searches all lists.

Vectors far longer than nearly all others are kept in a list of their own that every query opens:
else their length would drown all differences.

Largest inner product becomes least distance by one more coordinate, sqrt(M^2 - |x|^2), for
the indexed vectors and 0 for the queries. Lists longer than ``CHUNK`` are cut in chunks that
all their queries visit, and many queries of one list are cut likewise, so no group grows
with the data. A group returns each query's best; scores are sums in double precision over
the given vectors, in a fixed order (all divided by one power of two first, so that nothing overflows), so equal vectors tie and the smaller vec_id goes first.

Defined results: vectors that are null, zero, or hold a null or non-finite component, rows
without vec_id, and vectors of another length than most take no part. Rows of one vec_id are
one candidate, with their best score. Fewer candidates than ``k`` give fewer rows; an empty
table gives none. Other columns are not read.
"""

from __future__ import annotations

import math
import pickle

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from folioworks.session import materialize

#: Vectors that the centroids are fitted on, at most.
SAMPLE_ROWS = 16_000
#: Vectors per centroid that are aimed at, and the most centroids.
LIST_SIZE, MOST_LISTS = 128, 2_000
ROUNDS, DEGREE, BEAM = 8, 24, 160
REPLICATE, COPIES = 1.06, 6
PRUNE = 1.15
CHUNK = 4096
#: Powers of two up to which components are squared as they are.
LARGE = 480
#: Vectors longer than so many times the length that ORDINARY of them stay below are searched by every query.
LONG, ORDINARY = 4.0, 0.98


class Centroids:
    """Centroids and a graph between near ones."""

    def __init__(self, points: np.ndarray):
        #: Least distance of the median query.
        self.typical = 0.0
        self.points = points.astype(np.float64)
        self.squares = (self.points**2).sum(1)
        n = len(points)
        degree = min(DEGREE, n - 1)
        self.near = np.zeros((n, max(degree, 1)), dtype=np.int64)
        for i in range(0, n, 512):
            d = self.squares[None, :] - 2 * self.points[i : i + 512] @ self.points.T
            d[np.arange(len(d)), np.arange(i, i + len(d))] = np.inf
            if degree:
                self.near[i : i + 512] = np.argpartition(d, degree - 1, axis=1)[:, :degree]
        rng = np.random.default_rng(5)
        self.entries = np.sort(rng.permutation(n)[: min(n, BEAM)])

    def search(self, x: np.ndarray, beam: int) -> tuple[np.ndarray, np.ndarray]:
        """Nearest centroids of each row, nearest first, and their distances: a beam walk over the graph."""
        n, k = len(x), min(beam, len(self.points))
        square = (x**2).sum(1)[:, None]
        seen = np.zeros((n, len(self.points)), dtype=bool)
        ids = np.broadcast_to(self.entries, (n, len(self.entries))).copy()
        seen[:, self.entries] = True
        dist = square + self.squares[ids] - 2 * (x @ self.points[self.entries].T)
        done = np.zeros((n, len(self.points)), dtype=bool)
        rows = np.arange(n)[:, None]
        while True:
            order = np.argsort(dist, axis=1, kind="stable")[:, :k]
            ids, dist = ids[rows, order], dist[rows, order]
            fresh = ~done[rows, ids] & np.isfinite(dist)
            # The four nearest that were not yet opened, of every row that has any.
            rank = np.cumsum(fresh, axis=1)
            open_row, open_col = np.nonzero(fresh & (rank <= 4))
            if not len(open_row):
                return ids, np.sqrt(np.maximum(dist, 0))
            node = ids[open_row, open_col]
            done[open_row, node] = True
            r = np.repeat(open_row, self.near.shape[1])
            c = self.near[node].ravel()
            new = ~seen[r, c]
            pair = np.unique(r[new] * len(self.points) + c[new])
            r, c = pair // len(self.points), pair % len(self.points)
            seen[r, c] = True
            width = np.bincount(r, minlength=n)
            slot = np.arange(len(r)) - np.repeat(np.cumsum(width) - width, width)
            more_ids = np.zeros((n, max(width.max(initial=0), 1)), dtype=np.int64)
            more = np.full(more_ids.shape, np.inf)
            more_ids[r, slot] = c
            more[r, slot] = square[r, 0] + self.squares[c] - 2 * np.einsum("ij,ij->i", x[r], self.points[c])
            ids, dist = np.concatenate([ids, more_ids], axis=1), np.concatenate([dist, more], axis=1)


def fit_centroids(sample: np.ndarray, count: int) -> Centroids:
    """Lloyd rounds from spread starts; a cluster of over twice the mean size gives up half to an empty one."""
    rng = np.random.default_rng(3)
    distinct = np.unique(sample, axis=0)
    count = max(1, min(count, len(distinct)))
    points = distinct[rng.permutation(len(distinct))[:count]]
    for _ in range(ROUNDS):
        best = np.concatenate([
            ((points**2).sum(1)[None, :] - 2 * sample[i : i + 2048] @ points.T).argmin(1) for i in range(0, len(sample), 2048)
        ])
        size = np.bincount(best, minlength=count)
        total = np.zeros_like(points)
        np.add.at(total, best, sample)
        points = np.where(size[:, None] > 0, total / np.maximum(size, 1)[:, None], points)
        small = np.argsort(size, kind="stable")
        large = np.flatnonzero(size > 2 * len(sample) / count)
        for a, b in zip(large[np.argsort(-size[large], kind="stable")], small, strict=False):
            if size[b] * 4 > size[a]:
                break
            points[b] = sample[rng.choice(np.flatnonzero(best == a))]
    made = Centroids(np.unique(points, axis=0))
    asking = np.column_stack([sample[:, :-1], np.zeros(len(sample))])
    least = np.concatenate([
        (made.squares[None, :] - 2 * asking[i : i + 2048] @ made.points.T).min(1) for i in range(0, len(asking), 2048)
    ])
    made.typical = float(np.sqrt(np.maximum(np.median(least + (asking**2).sum(1)), 0)))
    return made


def usable(vectors: DataFrame) -> DataFrame:
    """vec_id, embedding (array of double) of the rows that can take part, of any length."""
    x = F.col("embedding").cast("array<double>")
    odd = F.exists(x, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == F.lit(float("inf"))))
    rows = vectors.select(F.col("vec_id").cast("bigint").alias("vec_id"), x.alias("embedding"))
    rows = rows.filter(F.col("vec_id").isNotNull() & x.isNotNull()).filter(~odd & F.exists("embedding", lambda v: v != 0))
    return rows


def prepared(vectors: DataFrame, queries: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """Rows of the length that most vectors have, on both sides, over the same power of two, and its exponent.

    Components so large that a sum of squares would overflow, or all so small that it would vanish, are
    brought into range; others stay as they are. No digit of a score in range is lost.
    """
    rows, asked = usable(vectors), usable(queries)
    sizes = rows.groupBy(F.size("embedding").alias("n")).count().orderBy(F.desc("count"), "n").first()
    length = sizes.n if sizes else 0
    rows, asked = (df.filter(F.size("embedding") == length) for df in (rows, asked))
    largest = F.max(F.array_max(F.transform("embedding", F.abs))).alias("x")
    top = max((r.x for r in (rows.agg(largest).first(), asked.agg(largest).first()) if r.x), default=1.0)
    exponent = math.frexp(top)[1]
    exponent = exponent - LARGE if exponent > LARGE else max(exponent, -1000) if exponent < -LARGE else 0
    if not exponent:
        return rows, asked, 0
    scaled = F.transform("embedding", lambda v: v * F.lit(2.0**-exponent))
    return rows.withColumn("embedding", scaled), asked.withColumn("embedding", scaled), exponent


def _matrix(column: pa.Array) -> np.ndarray:
    flat = np.asarray(column.flatten(), dtype=np.float64)
    return flat.reshape(len(column), -1)


def _augmented(x: np.ndarray, top: float) -> np.ndarray:
    return np.column_stack([x, np.sqrt(np.maximum(top**2 - (x**2).sum(1), 0))])


def nearest(vectors: DataFrame, queries: DataFrame, k: int = 20) -> DataFrame:
    """query_id, rank, vec_id, score: up to ``k`` neighbours of each row of ``queries`` among ``vectors``.

    Both have vec_id and embedding; a row is no neighbour of its own id.
    """
    rows, asked, exponent = prepared(vectors, queries)
    norm = F.sqrt(F.aggregate("embedding", F.lit(0.0), lambda a, v: a + v * v))
    facts = rows.agg(F.count("*").alias("n"), F.max(norm).alias("top"), F.percentile_approx(norm, ORDINARY).alias("most")).first()
    if not facts.n:
        return vectors.sparkSession.createDataFrame([], "query_id bigint, rank int, vec_id bigint, score double")
    # One very long vector would make all others look alike.
    top = min(float(facts.top), LONG * float(facts.most) or float(facts.top))
    some_long = float(facts.top) > top
    lists = max(1, min(MOST_LISTS, facts.n // LIST_SIZE))

    def fit(batches):
        sample = np.concatenate([np.column_stack([np.asarray(b.column(0)), _matrix(b.column(1))]) for b in batches if b.num_rows])
        sample = sample[np.argsort(sample[:, 0], kind="stable")][:, 1:]
        made = fit_centroids(_augmented(sample, top), lists)
        yield pa.RecordBatch.from_arrays([pa.array([pickle.dumps(made)], pa.binary())], names=["model"])

    sample = rows.filter(norm <= top).orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE_ROWS)
    centroids = pickle.loads(sample.repartition(1).mapInArrow(fit, "model binary").first().model)

    def assign(as_query: bool, held: np.ndarray | None = None):
        ratio, most = (PRUNE, BEAM) if as_query else (REPLICATE, COPIES)
        enough = 2 * COPIES * (k + 1)

        def run(batches):
            for whole in batches:
                for i in range(0, whole.num_rows, 1024):
                    batch = whole.slice(i, 1024)
                    x = _matrix(batch.column(1))
                    is_long = np.sqrt((x**2).sum(1)) > top
                    x = np.column_stack([x, np.zeros(len(x))]) if as_query else _augmented(x, top)
                    ids, dist = centroids.search(x, BEAM if as_query else 2 * COPIES)
                    reach = dist[:, :1]
                    if as_query:
                        opened = np.minimum((np.cumsum(held[ids], axis=1) < enough).sum(1), ids.shape[1] - 1)
                        reach = np.maximum(dist[np.arange(len(dist)), opened], centroids.typical)[:, None]
                    taken = (dist <= ratio * reach + 1e-12) & (np.arange(ids.shape[1]) < most)
                    row, col = np.nonzero(taken & (as_query | ~is_long)[:, None])
                    extra = np.arange(len(x)) if as_query and some_long else np.flatnonzero(is_long) if not as_query else row[:0]
                    of_long = np.full(len(extra), len(centroids.points), dtype=np.int64)
                    row, list_ = np.concatenate([row, extra]), np.concatenate([ids[row, col], of_long])
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(list_), *(c.take(pa.array(row)) for c in batch.columns)], names=["list", "vec_id", "embedding"]
                    )

        return run

    schema = "list bigint, vec_id bigint, embedding array<double>"
    posted = materialize(rows.mapInArrow(assign(False), schema))

    # Of each list, its vec_ids and how many chunks of vectors; at most MOST_LISTS rows.
    chunks = posted.groupBy("list").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("chunks"), F.countDistinct("vec_id").alias("ids"))
    chunks = materialize(chunks)
    held = np.zeros(len(centroids.points) + 1, dtype=np.int64)
    for r in chunks.collect():
        held[r.list] = r.ids

    def best(candidates: pa.Table, asking: pa.Table) -> pa.Table:
        out = [[], [], []]
        if candidates.num_rows and asking.num_rows:
            candidates = candidates.sort_by("vec_id")
            ids, x = np.asarray(candidates["vec_id"]), _matrix(candidates["embedding"].combine_chunks())
            starts = np.flatnonzero(np.diff(ids, prepend=ids[0] - 1))
            query_ids, q = np.asarray(asking["vec_id"]), _matrix(asking["embedding"].combine_chunks())
            for i in range(0, len(q), 256):
                rough = q[i : i + 256] @ x.T
                rough[query_ids[i : i + 256, None] == ids[None, :]] = -np.inf
                # Rows of one vec_id are one candidate.
                each = np.maximum.reduceat(rough, starts, axis=1) if len(starts) < len(ids) else rough
                m = min(k, len(starts))
                cut = np.partition(each, len(starts) - m, axis=1)[:, len(starts) - m]
                row, col = np.nonzero((rough >= (cut - 1e-9 * (1 + np.abs(cut)))[:, None]) & np.isfinite(rough))
                exact = (q[i + row] * x[col]).sum(axis=1)
                order = np.lexsort((-exact, ids[col], row))
                row, col, exact = row[order], col[order], exact[order]
                new = (np.diff(row, prepend=-1) != 0) | (np.diff(ids[col], prepend=0) != 0)
                row, col, exact = row[new], col[new], exact[new]
                order = np.lexsort((ids[col], -exact, row))
                row, col, exact = row[order], col[order], exact[order]
                first = np.searchsorted(row, np.arange(len(q)))
                keep = np.arange(len(row)) - first[row] < k
                for kept, values in zip(out, (query_ids[i + row[keep]], ids[col[keep]], exact[keep]), strict=True):
                    kept.append(values)
        arrays = [np.concatenate(h) if h else np.zeros(0) for h in out]
        return pa.table({"query_id": pa.array(arrays[0], pa.int64()), "vec_id": pa.array(arrays[1], pa.int64()), "score": pa.array(arrays[2], pa.float64())})

    key = ["list", "chunk", "turn"]
    chunk = lambda n: F.pmod(F.xxhash64("vec_id"), F.col(n)).cast("int")
    every = lambda n: F.explode(F.sequence(F.lit(0), F.col(n) - 1))
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")

    def search(visits: DataFrame) -> DataFrame:
        turns = visits.groupBy("list").agg(F.ceil(F.count("*") / CHUNK).cast("int").alias("turns"))
        plan = F.broadcast(chunks.join(turns, "list"))
        left = posted.join(plan, "list").select("list", chunk("chunks").alias("chunk"), every("turns").alias("turn"), "vec_id", "embedding")
        right = visits.join(plan, "list").select("list", every("chunks").alias("chunk"), chunk("turns").alias("turn"), "vec_id", "embedding")
        found = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInArrow(best, "query_id bigint, vec_id bigint, score double")
        once = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
        ranked = once.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= k)
        return materialize(ranked.select("query_id", "rank", "vec_id", "score"))

    def unscaled(found: DataFrame) -> DataFrame:
        # In two steps: the square of the power may be out of range.
        power = F.lit(2.0**exponent)
        return found.withColumn("score", F.col("score") * power * power) if exponent else found

    near = search(materialize(asked.mapInArrow(assign(True, held), schema)))
    full = near.filter(F.col("rank") == k).select("query_id")
    short = materialize(asked.join(full, asked["vec_id"] == full["query_id"], "left_anti"))
    if short.isEmpty():
        return unscaled(near)
    wide = search(short.crossJoin(F.broadcast(chunks.select("list"))).select("list", "vec_id", "embedding"))
    return unscaled(near.join(full, "query_id", "left_semi").union(wide))


def op6_neighbours(spark, sf_dir: str) -> DataFrame:
    vectors = spark.read.parquet(f"{sf_dir}/embeddings.parquet")
    return nearest(vectors, vectors.filter(F.col("vec_id") % 20 == 0))
