"""Hard negatives from an STR-packed R-tree over integer vectors.

*Index.*  The vectors are cut into tiles of about ``tile_rows`` rows by
sort-tile-recursive packing: Spark cuts the table into slabs of equal size
along the coordinate that varies most, each slab along the next one, and so
on.  The task that holds a tile packs it the same way into leaves, and leaves
into nodes of FANOUT children, each with its minimum bounding box and the
range of its labels.  The tiles are written once; every search reads them.

*Search.*  With a box's sides [lo, hi], each coordinate adds at most
max(q lo, q hi) and at least min(q lo, q hi) to the inner product with q.
A best-first queue opens the box with the greatest possible score first.  Boxes
whose interval misses the score window, whose labels cannot do, or whose
greatest score lies strictly below the k-th found are never opened; boxes that
can tie with it are, since ties go to the smaller id.  Queries go to the tiles
in blocks of bounded size, an anchor with all of its score windows at once; a
task keeps its k best of each window over all of its tiles, and only these
travel.

All scores are exact: vectors whose squares sum up to 2^44 and more take no
part (components of the given tables would have to exceed 16,000), so every
product and bound is an integer that a double holds.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import read, schema

TILE_ROWS, LEAF_ROWS, FANOUT = 8_192, 256, 32
# Coordinates along which Spark cuts the tiles.
TILE_DIMS = 3
# Numbers in a block of queries that is sent to the tasks (8 bytes each).
QUERY_NUMBERS = 2_000_000
# Sum of squares beyond which a score might not be exact.
SQUARES = 1 << 44


def integer_vectors(rows: DataFrame, vec_id: str, vector: str, label: Column | str,
                    scale: int = 256) -> DataFrame:
    """(id, label, dim, v): floor(scale * x) of each component, one row each.

    Left out: rows with a null id, label or vector, with a null or non-finite
    component, without components, or too large (see above).  Rows equal in
    id, label and vector count once.
    """
    x = F.transform(F.col(vector), lambda a: F.floor(a.cast("double") * scale).cast("double"))
    fine = F.forall(F.col(vector), lambda a: a.isNotNull() & ~F.isnan(a)
                    & (F.abs(a.cast("double")) < float("inf")))
    squares = F.aggregate(x, F.lit(0.0), lambda s, a: s + a * a)
    label = F.col(label) if isinstance(label, str) else label
    return (rows.select(F.col(vec_id).cast("long").alias("id"), label.cast("long").alias("label"),
                        F.when(fine, x).alias("x"))
            .where(F.col("id").isNotNull() & F.col("label").isNotNull() & (F.size("x") > 0))
            .where(squares < float(SQUARES))
            .select("id", "label", F.size("x").alias("dim"),
                    F.transform("x", lambda a: a.cast("int")).alias("v")).distinct())


# -------------------------------------------------------------------- packing

def _slabs(tiles: float, dims: int) -> int:
    """Slabs for each of ``dims`` cuts that make ``tiles`` tiles or more."""
    return max(1, int(np.ceil(round(tiles ** (1 / dims), 9))))


def tiled(rows: DataFrame, dim: int, tile_rows: int, dims: int = TILE_DIMS) -> DataFrame:
    """``rows`` (all of one dimension) with ``tile``: slabs of slabs.

    The cuts are approximate quantiles of each slab, so neither a slab nor its
    order is ever in one task.  Vectors that share a coordinate lie in one
    slab; a tile that they make too large is dealt out by a hash of the id.
    """
    spread = [r["s"] for r in rows.select(F.posexplode("v").alias("c", "x")).groupBy("c")
              .agg(F.var_pop("x").alias("s")).orderBy("c").collect()]      # one row a coordinate
    many = rows.count()
    widest = sorted(range(dim), key=lambda c: (-(spread[c] or 0.0), c))[:dims]
    slabs = _slabs(many / tile_rows, len(widest))
    shares = [i / slabs for i in range(1, slabs)]

    def cuts_of(c):
        return F.percentile_approx(F.element_at("v", c + 1), shares, 1000 * slabs).alias("cuts")

    def slab(c, cuts):
        return F.size(F.filter(cuts, lambda q: q < F.element_at("v", c + 1)))

    if slabs == 1:
        out = rows.withColumn("tile", F.lit(0).cast("long"))
    else:
        cuts = rows.agg(cuts_of(widest[0])).first()["cuts"] or []    # slabs - 1 numbers
        out = stage(rows.withColumn("tile", slab(widest[0], F.lit(cuts)).cast("long")), "slabs")
        for c in widest[1:]:
            out = stage(out.join(out.groupBy("tile").agg(cuts_of(c)), "tile")
                        .withColumn("tile", F.col("tile") * slabs + slab(c, "cuts"))
                        .drop("cuts"), "slabs")
    size = out.groupBy("tile").agg(F.ceil(F.count(F.lit(1)) / (2 * tile_rows)).alias("pieces"))
    return (out.join(size, "tile")
            .withColumn("piece", F.pmod(F.xxhash64("id", "label"), F.col("pieces"))).drop("pieces"))


def pack(x: np.ndarray, first: np.ndarray, leaf_rows: int) -> np.ndarray:
    """Order of the rows in which each ``leaf_rows`` neighbours are a leaf.

    ``first`` (the label) is cut along first, then the coordinates that vary
    most.
    """
    spread = x.var(0)
    keys = [first, *(x[:, c] for c in np.argsort(-spread, kind="stable"))]

    def cut(rows: np.ndarray, level: int) -> Iterator[np.ndarray]:
        leaves = -(-len(rows) // leaf_rows)
        rows = rows[np.argsort(keys[level][rows], kind="stable")]
        left = min(len(keys) - level, max(1, int(np.ceil(np.log2(max(2, leaves))))))
        slabs = _slabs(leaves, left)
        if leaves == 1 or left == 1:
            yield rows
            return
        each = -(-leaves // slabs) * leaf_rows
        for i in range(0, len(rows), each):
            yield from cut(rows[i:i + each], level + 1)

    return np.concatenate(list(cut(np.arange(len(x)), 0)))


class Found:
    """The k greatest scores of one query in each of its score windows."""

    def __init__(self, low: np.ndarray, high: np.ndarray, k: int):
        self.low, self.high, self.k = low, high, k
        self.score = [np.zeros(0, np.int64) for _ in low]
        self.ids = [np.zeros(0, np.int64) for _ in low]
        self.need = low.copy()          # what a score must reach in each window

    def wanted(self, top, bottom) -> np.ndarray:
        """Greatest score in a window that boxes can add; -inf where none."""
        cap = np.minimum(top[..., None], self.high)
        return np.where((cap >= self.need) & (bottom[..., None] <= self.high), cap, -np.inf).max(-1)

    def add(self, score: np.ndarray, ids: np.ndarray) -> None:
        near = (score >= self.need.min()) & (score <= self.high.max())
        if not near.any():
            return
        score, ids = score[near].astype(np.int64), ids[near]
        for w in range(len(self.low)):
            fit = (score >= self.need[w]) & (score <= self.high[w])
            if fit.any():
                s = np.concatenate((self.score[w], score[fit]))
                i = np.concatenate((self.ids[w], ids[fit]))
                best = np.lexsort((i, -s))[:self.k]
                self.score[w], self.ids[w] = s[best], i[best]
                if len(best) == self.k:
                    self.need[w] = s[best[-1]]


class Tree:
    """A tile's R-tree: levels of boxes over the packed rows."""

    def __init__(self, ids: np.ndarray, labels: np.ndarray, x: np.ndarray, leaf_rows: int):
        self.ids, self.labels, self.x = ids, labels, x
        self.levels = []                         # (lo, hi, least and greatest label, step)
        starts = np.arange(0, len(x), leaf_rows)
        level = (np.minimum.reduceat(x, starts), np.maximum.reduceat(x, starts),
                 np.minimum.reduceat(labels, starts), np.maximum.reduceat(labels, starts), leaf_rows)
        while True:
            self.levels.append(level)
            lo, hi, least, most, _ = level
            if len(lo) == 1:
                break
            at = np.arange(0, len(lo), FANOUT)
            level = (np.minimum.reduceat(lo, at), np.maximum.reduceat(hi, at),
                     np.minimum.reduceat(least, at), np.maximum.reduceat(most, at), FANOUT)

    def search(self, q: np.ndarray, label: int, same: bool, own: int, found: Found) -> None:
        """Adds this tile's rows of the label (``same``) or of other ones, with
        another id than ``own``, to what the query has found."""
        up, down = np.maximum(q, 0.0), np.minimum(q, 0.0)
        queue: list[tuple] = []

        def push(level: int, a: int, b: int) -> None:
            lo, hi, least, most = (v[a:b] for v in self.levels[level][:4])
            top, bottom = hi @ up + lo @ down, lo @ up + hi @ down
            fit = (least <= label) & (label <= most) if same else (least != label) | (most != label)
            bound = np.where(fit, found.wanted(top, bottom), -np.inf)
            for i in np.flatnonzero(bound > -np.inf).tolist():
                heapq.heappush(queue, (-bound[i], level, a + i, top[i], bottom[i]))

        push(len(self.levels) - 1, 0, 1)
        while queue:
            bound, level, node, top, bottom = heapq.heappop(queue)
            if -bound < found.need.min():
                break                            # so is every box still queued
            if found.wanted(top, bottom) == -np.inf:
                continue                         # strictly below the k-th by now
            step = self.levels[level][4]
            a, b = node * step, (node + 1) * step
            if level:
                push(level - 1, a, min(b, len(self.levels[level - 1][0])))
                continue
            fit = ((self.labels[a:b] == label) == same) & (self.ids[a:b] != own)
            found.add((self.x[a:b] @ q)[fit], self.ids[a:b][fit])


def _packed(dim: int, leaf_rows: int):
    def packed(pdf):
        import pandas as pd
        x = np.array(pdf["v"].tolist(), np.int32).reshape(-1, dim)
        labels, ids = pdf["label"].to_numpy(), pdf["id"].to_numpy()
        order = np.lexsort((labels, ids))                # not the order of arrival
        order = order[pack(x[order].astype(np.float64), labels[order], leaf_rows)]
        return pd.DataFrame({"dim": [dim], "ids": [ids[order].tobytes()],
                             "labels": [labels[order].tobytes()], "x": [x[order].tobytes()]})
    return packed


def build_index(rows: DataFrame, tile_rows: int = TILE_ROWS, leaf_rows: int = LEAF_ROWS
                ) -> DataFrame:
    """(dim, ids, labels, x): one row per packed tile, written once.

    ``rows`` comes from ``integer_vectors`` and is staged.  Vectors of
    different dimensions are never compared and lie in trees of their own.
    """
    out = None
    for dim in sorted(r["dim"] for r in rows.select("dim").distinct().collect()):
        tiles = (tiled(rows.where(F.col("dim") == dim), dim, tile_rows)
                 .groupBy("tile", "piece")
                 .applyInPandas(_packed(dim, leaf_rows), "dim int, ids binary, labels binary, x binary"))
        out = tiles if out is None else out.unionByName(tiles)
    if out is None:
        return rows.sparkSession.createDataFrame([], "dim int, ids binary, labels binary, x binary")
    return stage(out, "rtree")


# --------------------------------------------------------------------- search

def search(index: DataFrame, queries: list[tuple], same: bool, k: int,
           leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(query, window, id, score): at most k of each window from each task.

    A query is (number, vector, label, own id, lows, highs): a window for each
    pair of a low and a high score.
    """
    by_dim: dict[int, list] = {}
    for q in queries:
        by_dim.setdefault(len(q[1]), []).append(q)
    sent = index.sparkSession.sparkContext.broadcast(by_dim)

    def run(batches):
        found: dict[int, Found] = {}
        for b in batches:
            for r in b.to_pylist():
                wanted = sent.value.get(r["dim"], [])
                if not wanted:
                    continue
                x = np.frombuffer(r["x"], np.int32).reshape(-1, r["dim"]).astype(np.float64)
                tree = Tree(np.frombuffer(r["ids"], np.int64),
                            np.frombuffer(r["labels"], np.int64), x, leaf_rows)
                for n, q, label, own, lows, highs in wanted:
                    if n not in found:
                        found[n] = Found(np.array(lows, np.float64), np.array(highs, np.float64), k)
                    tree.search(q, label, same, own, found[n])
        for n, f in found.items():
            size = [len(i) for i in f.ids]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(sum(size), n), pa.int64()),
                 pa.array(np.repeat(np.arange(len(size)), size), pa.int32()),
                 pa.array(np.concatenate(f.ids)), pa.array(np.concatenate(f.score))],
                names=["query", "window", "id", "score"])

    return index.mapInArrow(run, schema("query long, window int, id long, score long"))


def _best(found: DataFrame, k: int) -> DataFrame:
    # rows of different content may share an id, label and score: any order
    order = Window.partitionBy("query", "window").orderBy(F.desc("score"), "id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def mine(rows: DataFrame, anchors: Column, positives: int = 5, negatives: int = 10,
         low: int = 30, high: int = 90, den: int = 100, tile_rows: int = TILE_ROWS,
         leaf_rows: int = LEAF_ROWS, query_numbers: int = QUERY_NUMBERS) -> DataFrame:
    """Hard negatives of the rows that ``anchors`` (a condition on id) chooses.

    ``rows`` comes from ``integer_vectors``.  Per anchor and positive, the
    ``negatives`` rows of other labels with the greatest scores among those
    with low * p <= den * score <= high * p, p being the positive's score:
    (anchor_id, positive_id, rank, negative_id, positive_score,
    negative_score).  Positives are the anchor's ``positives`` greatest scores
    among other ids of its label.  Ties go to the smaller id.  Anchors without
    a positive, and positives without a negative in their window, give no
    rows; an empty table gives none.  Rows that share an id but differ in
    label or vector are rows of their own, and none is another's positive.
    """
    spark = rows.sparkSession
    rows = stage(rows, "integer-vectors")
    index = build_index(rows, tile_rows, leaf_rows)
    asked = rows.where(anchors)
    size = asked.agg(F.sum("dim").alias("n")).first()["n"] or 0
    blocks = max(1, -(-size // query_numbers))
    key = F.xxhash64("id", "label", "v")
    out = None
    for part in range(blocks):
        block = sorted((r["id"], r["label"], r["v"]) for r in
                       asked.where(F.pmod(key, F.lit(blocks)) == part).collect())
        if not block:
            continue
        vectors = [np.array(v, np.float64) for _, _, v in block]
        asks = [(n, v, label, i, [-float(1 << 52)], [float(1 << 52)])
                for n, ((i, label, _), v) in enumerate(zip(block, vectors))]
        near = (_best(search(index, asks, True, positives, leaf_rows), positives)
                .orderBy("query", "rank").collect())                  # positives x the block
        windows: dict[int, list] = {}
        pairs = []
        for r in near:
            a, b = -(-low * r["score"] // den), high * r["score"] // den
            if a <= b:
                held = windows.setdefault(r["query"], [])
                pairs.append((r["query"], len(held), block[r["query"]][0], r["id"], r["score"]))
                held.append((float(a), float(b)))
        if not pairs:
            continue
        asks = [(n, vectors[n], block[n][1], block[n][0], *map(list, zip(*w)))
                for n, w in windows.items()]
        names = spark.createDataFrame(pairs, "query long, window int, anchor_id long, "
                                             "positive_id long, positive_score long")
        got = (_best(search(index, asks, False, negatives, leaf_rows), negatives)
               .join(names, ["query", "window"])
               .select("anchor_id", "positive_id", F.col("rank").cast("int").alias("rank"),
                       F.col("id").alias("negative_id"), "positive_score",
                       F.col("score").alias("negative_score")))
        out = got if out is None else out.unionByName(got)
    if out is None:
        return spark.createDataFrame(
            [], "anchor_id long, positive_id long, rank int, negative_id long, "
                "positive_score long, negative_score long")
    return out


def op13_hard_negatives(spark, sf_dir):
    rows = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return mine(integer_vectors(rows, "vec_id", "embedding", label), F.col("id") % 100 == 0)


HARD_NEGATIVES_SQL = """
    WITH r AS (
        SELECT vec_id AS id,
               CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
               [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
        FROM embeddings
        WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
          AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
    s AS (
        SELECT a.id AS anchor_id, b.id, a.label = b.label AS same,
               CAST(list_inner_product(a.v, b.v) AS BIGINT) AS score
        FROM r a JOIN r b ON a.id % 100 = 0 AND a.id <> b.id),
    p AS (
        SELECT anchor_id, id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
    SELECT p.anchor_id, p.positive_id,
           CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id
                                   ORDER BY s.score DESC, s.id) AS INTEGER) AS rank,
           s.id AS negative_id, p.positive_score, s.score AS negative_score
    FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
         AND 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score
    QUALIFY rank <= 10
"""
