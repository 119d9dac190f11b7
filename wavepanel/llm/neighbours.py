"""Approximate nearest neighbours by collision counting.

Every vector is projected on PROJECTIONS random lines.  A block of vectors
keeps one sorted array per line.  A query opens a window of half-width R around
its own projection on every line; a vector that falls into the window collides
there.  Vectors that collide on at least THRESHOLD of the lines are verified
by their true distance.  If the k-th verified distance is above R, the windows
are widened around the query (virtual rehashing: no hash is made anew) and the
search goes on; at the widest, every vector collides, so k are always found.

A vector at distance R from the query collides on a line with probability
0.68, so it reaches the threshold of half the lines almost surely, while one
at distance 2R collides with probability 0.38 and seldom does.

Blocks are searched where their vectors are; only k rows per query and block
travel, and are merged by distance.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import read, schema

PROJECTIONS = 64
THRESHOLD = 32
GROWTH = 1.25
# Vectors whose sorted arrays a task holds at a time.
BLOCK_ROWS = 16_384
# Numbers in a block of queries that is sent to the tasks (8 bytes each).
QUERY_NUMBERS = 4_000_000


def usable(vectors: DataFrame, vec_id: str, vector: str) -> DataFrame:
    """(uid, id, v): vectors without nulls and non-finite numbers, not zero."""
    x = F.transform(F.col(vector), lambda a: a.cast("double"))
    fine = F.forall(x, lambda a: a.isNotNull() & ~F.isnan(a) & (F.abs(a) < float("inf")))
    some = F.exists(x, lambda a: a != 0)
    return (vectors.where(F.col(vector).isNotNull())
            .select(F.monotonically_increasing_id().alias("uid"), F.col(vec_id).alias("id"),
                    x.alias("v")).where(fine & some))


class Block:
    """Sorted projections of the vectors of one task."""

    def __init__(self, uid: np.ndarray, ids: list, x: np.ndarray, lines: np.ndarray):
        self.uid, self.ids, self.x = uid, ids, x
        value = x @ lines
        self.order = np.argsort(value, axis=0, kind="stable").T.copy()
        self.value = np.take_along_axis(value, self.order.T, axis=0).T.copy()

    def nearest(self, uid: int, q: np.ndarray, at: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of the k nearest found, the query's own row left out."""
        n = len(self.x)
        sample = self.x[:: max(1, n // 128)]
        own = np.flatnonzero(self.uid == uid)
        others = n - len(own)
        near = np.sqrt(((sample - q) ** 2).sum(1))
        near = near[near > 0]
        # Copies of the query project to its place but for rounding, so the
        # first window is never empty.
        radius = max(0.5 * near.min(initial=np.inf) if len(near) else 0.0,
                     1e-9 * float(np.abs(q).sum()), np.finfo(float).tiny)
        seen = np.zeros(n, bool)
        seen[own] = True
        rows = np.zeros(0, np.int64)
        dist = np.zeros(0)
        count = np.zeros(n, np.int32)
        lo = hi = None
        while True:
            a = np.array([np.searchsorted(v, c - radius, "left") for v, c in zip(self.value, at)])
            b = np.array([np.searchsorted(v, c + radius, "right") for v, c in zip(self.value, at)])
            if lo is None:
                new = [o[i:j] for o, i, j in zip(self.order, a, b)]
            else:                                # only what the windows gained
                new = [o[i:j] for o, i, j in zip(self.order, a, lo)]
                new += [o[i:j] for o, i, j in zip(self.order, hi, b)]
            lo, hi = a, b
            count += np.bincount(np.concatenate(new), minlength=n).astype(np.int32)
            # numbers too large to project are all verified in the end
            fresh = np.flatnonzero(((count >= THRESHOLD) | ~np.isfinite(radius)) & ~seen)
            if len(fresh):
                seen[fresh] = True
                d = np.sqrt(((self.x[fresh] - q) ** 2).sum(1))
                rows, dist = np.concatenate((rows, fresh)), np.concatenate((dist, d))
                if len(dist) > 4 * k + 64:
                    cut = np.partition(dist, k - 1)[k - 1]
                    keep = dist <= cut           # ties with the k-th stay
                    rows, dist = rows[keep], dist[keep]
            if len(dist) >= min(k, others) and (
                    seen.all() or len(dist) >= k > 0 and np.partition(dist, k - 1)[k - 1] <= radius):
                return rows, dist
            radius *= GROWTH


def search(vectors: DataFrame, queries: DataFrame, k: int = 10, vec_id: str = "vec_id",
           seed: int = 3) -> DataFrame:
    """(query_id, rank, vec_id, score): the k nearest found of each query row.

    ``vectors`` comes from ``usable`` and is staged; ``queries`` is a part of
    it.  Only vectors of a query's dimension are its candidates; the query's
    own row is none, other rows with its id are.  Ties go to the smaller id.
    Fewer than k candidates are all returned; an empty table gives none.
    """
    kind = vectors.schema["id"].dataType.simpleString()
    many = queries.agg(F.count(F.lit(1)).alias("n"), F.max(F.size("v")).alias("d")).first()
    spark = vectors.sparkSession
    blocks = max(1, -(-many["n"] * (many["d"] or 1) // QUERY_NUMBERS))
    out = None
    ddl = f"quid long, query_id {kind}, vec_id {kind}, score double"
    for part in range(blocks):
        rows = queries.where(F.pmod(F.xxhash64("uid"), F.lit(blocks)) == part).collect()
        by_dim: dict[int, list] = {}
        for r in rows:
            by_dim.setdefault(len(r["v"]), []).append((r["uid"], r["id"], np.array(r["v"])))
        sent = spark.sparkContext.broadcast(by_dim)

        def run(batches):
            held: dict[int, list] = {}

            def answer(dim):
                rows, wanted = held.pop(dim), sent.value.get(dim, [])
                if not wanted:
                    return None
                lines = np.random.default_rng(seed).standard_normal((dim, PROJECTIONS))
                x = np.array([v for _, _, v in rows])
                ids = [i for _, i, _ in rows]
                block = Block(np.array([u for u, _, _ in rows]), ids, x, lines)
                got = [[], [], [], []]
                for uid, qid, q in wanted:
                    found, dist = block.nearest(uid, q, q @ lines, k)
                    best = sorted(zip(dist.tolist(), (ids[i] for i in found)),
                                  key=lambda p: (p[0], p[1] is None, p[1]))[:k]
                    for d, i in best:
                        for c, v in zip(got, (uid, qid, i, d)):
                            c.append(v)
                ids_kind = schema_arrow
                return pa.RecordBatch.from_arrays(
                    [pa.array(got[0], pa.int64()), pa.array(got[1], ids_kind),
                     pa.array(got[2], ids_kind), pa.array(got[3], pa.float64())],
                    names=["quid", "query_id", "vec_id", "score"])

            schema_arrow = pa.int64()
            for b in batches:
                schema_arrow = b.column("id").type
                for u, i, v in zip(b.column("uid").to_pylist(), b.column("id").to_pylist(),
                                   b.column("v")):
                    v = v.values.to_numpy()
                    held.setdefault(len(v), []).append((u, i, v))
                    if len(held[len(v)]) >= BLOCK_ROWS:
                        got = answer(len(v))
                        if got is not None:
                            yield got
            for dim in list(held):
                got = answer(dim)
                if got is not None:
                    yield got

        found = vectors.mapInArrow(run, schema(ddl))
        out = found if out is None else out.unionByName(found)
    order = Window.partitionBy("quid").orderBy("score", F.col("vec_id").asc_nulls_last())
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))


def nearest_neighbours(vectors: DataFrame, query_rows, k: int = 10, vec_id: str = "vec_id",
                       vector: str = "embedding") -> DataFrame:
    """Neighbours of the rows that ``query_rows`` (a condition on ``id``)
    chooses, among all rows.  Null, zero and non-finite vectors take no part."""
    rows = stage(usable(vectors, vec_id, vector), "vectors")
    return search(rows, rows.where(query_rows), k)


def op6_nearest_neighbours(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    return nearest_neighbours(rows, F.col("id") % 100 == 0)
