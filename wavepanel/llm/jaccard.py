"""Exact Jaccard join of documents as sets of word shingles.

The Jaccard distance is a metric, so documents can be cut into Voronoi regions
around pivots, and the triangle inequality says which documents near a border
must be seen by a neighbouring region too: if x and y are within eps, x has to
visit the region of y's pivot q only if d(x, q) <= d(x, nearest pivot) + 2 eps.
Regions that are still large are cut again around pivots of their own.

Pivots that are documents tell only related documents apart; two unrelated
ones are at a distance of almost 1 from every pivot, so their windows would
send everything everywhere.  The first level therefore cuts the space by its
subspaces.  A hash splits the universe of shingles into slices.  Linked sets
differ in at most h shingles, so of h + c slices at least c agree exactly (in
a slice, the window around a pivot has no width).  Each distinct set takes the
hashes of its slices as keys, drops the c - 1 most frequent of those that
anyone shares (c shared ones always leave one), and documents that are
connected by the remaining keys form a cell.  No linked pair lies in two
cells, and text that many documents share connects none of them unless at
least c slices consist of it; c grows with the slices, so that a quarter of a
set may be such text.  Sets of few shingles leave most slices empty, and an
empty slice says nothing: their keys are the shingles themselves, of which
linked sets share all that the threshold asks for.

Every cell of more than two sets gets pivots, Voronoi regions and windows,
recursively.  Cells above ``region_rows`` sets are cut as a Spark job, and
those that pivots don't shrink go on block by block; cells or regions below
are cut further within their task, until pivots don't shrink a region, whose
pairs are then compared.  Equal sets are one row throughout.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import give_back, own_columns, read, schema, small_batches
from .components import components
from .shingles import mix, set_name, shingle_set, words

# Sets that one task compares with each other.
REGION_ROWS = 1_500
# Slices that linked sets share at least, and the part of a set that may be
# text of others too before so many of its slices consist of it.
SHARED = 6
COMMON = 0.25
# Growth of set sizes from one size band to the next.
BAND = 1.5
# Sizes up to which the shingles themselves are keys.
FEW = 128
# The last bits of a key: 0 where it is a shingle, else one more than the band.
KIND = 63
# Pivots of a large cell, and bytes of pivots sent out at a time.
PIVOTS = 48
PIVOT_BYTES = 64 << 20
# Levels of pivots before a large region is joined block by block.
DEPTH = 4
# Rows of a derived table that may be broadcast (16 to 40 bytes each).
BROADCAST_ROWS = 500_000


class Threshold:
    """Links: den * intersection >= num * union."""

    def __init__(self, num: int, den: int):
        self.num, self.den = num, den

    def most_apart(self, a: int, b: int) -> int:
        """Largest symmetric difference of linked sets of these sizes."""
        return (a + b) * (self.den - self.num) // (self.den + self.num)

    def least_size(self, n: int) -> int:
        return -(-n * self.num // self.den)

    @property
    def eps(self) -> float:
        return 1 - self.num / self.den


def _band(n: int) -> int:
    return int(math.log(n) / math.log(BAND) + 1e-9)


def _slices(band: int, t: Threshold, memo: dict) -> tuple[int, int, int]:
    """(slices, how many of a set's slices may be empty, how many others
    linked sets share) of a band; 0 slices where sets are too small for them."""
    got = memo.get(band)
    if got is None:
        low, top = max(1, int(BAND ** band)), int(BAND ** (band + 1)) + 1
        apart = t.most_apart(top, top * t.den // t.num)
        spare, shared = 2, SHARED
        for _ in range(4):
            m = apart + shared + spare
            each = low / m
            p = math.exp(-each)
            spare = min(m, 2 + math.ceil(m * p + 2 * math.sqrt(m * p)))
            common = math.exp(-each * (1 - COMMON)) * -math.expm1(-each * COMMON)
            shared = max(SHARED, math.ceil(m * common))
        m = apart + shared + spare
        got = memo[band] = (0, 0, 0) if top <= FEW or m >= low else (m, spare, shared)
    return got


def slice_keys(s: np.ndarray, t: Threshold, memo: dict) -> np.ndarray:
    """Keys of a sorted set: one per non-empty slice, for every size
    band from that of its least partner to its own.

    Where a band has no slices, or the set leaves too many of them empty, its
    shingles are keys too.  A set that is linked to equal ones only has none.
    """
    n = len(s)
    if t.least_size(n) == n == n * t.den // t.num:
        return np.zeros(0, np.int64)
    out, whole = [], False
    mixed = mix(s ^ np.uint64(0x5851F42D4C957F2D))
    for band in range(_band(max(1, t.least_size(n))), _band(n) + 1):
        m, spare, _ = _slices(band, t, memo)
        if not m:
            whole = True
            continue
        part = (s % np.uint64(m)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        part = part[order]
        at = np.flatnonzero(np.concatenate(([True], part[1:] != part[:-1])))
        content = np.add.reduceat(mixed[order], at)
        held = part[at]
        whole |= m - len(held) > spare
        out.append(mix(content * np.uint64(0x9E3779B97F4A7C15)
                       + mix(held.astype(np.uint64) + np.uint64(band << 32)))
                   & np.uint64(~KIND & 0xFFFFFFFFFFFFFFFF) | np.uint64(band + 1))
    if whole:
        out.append(mixed & np.uint64(~KIND & 0xFFFFFFFFFFFFFFFF))
    return np.concatenate(out).view(np.int64)


def _described(docs: DataFrame, text: str, row_id: str, k: int) -> DataFrame:
    """(id, n, name) of every row."""
    kind = docs.schema[row_id].dataType.simpleString()

    def run(batches):
        for b in batches:
            n, name = [], []
            for h in words([(x or "").encode() for x in b.column(1).to_pylist()]):
                s = shingle_set(h, k)
                n.append(len(s))
                name.append(set_name(s) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(n, pa.int64()), pa.array(name, pa.int64())],
                names=["id", "n", "name"])
        give_back()

    return docs.select(F.col(row_id).alias("id"), text).mapInArrow(
        run, schema(f"id {kind}, n long, name long"))


def _keyed(docs: DataFrame, text: str, k: int, t: Threshold) -> DataFrame:
    """(name, key), the keys of every set; copies in one task give them once."""
    def run(batches):
        memo: dict = {}
        seen: set[int] = set()
        for b in batches:
            names, keys = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
            for h in words([(x or "").encode() for x in b.column(0).to_pylist()]):
                s = shingle_set(h, k)
                if not len(s) or (name := set_name(s)) in seen:
                    continue
                seen.add(name)
                keys.append(np.unique(slice_keys(s, t, memo)))
                names.append(np.full(len(keys[-1]), name, np.int64))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(names)), pa.array(np.concatenate(keys))],
                names=["name", "key"])
        del seen
        give_back()

    return docs.select(text).mapInArrow(run, schema("name long, key long"))


def _bounded(df: DataFrame) -> DataFrame:
    """A staged table, marked for broadcast if it is small enough."""
    return F.broadcast(df) if df.count() <= BROADCAST_ROWS else df


def _cells(one: DataFrame, sets: DataFrame, t: Threshold) -> DataFrame:
    """(node, root): distinct sets that may be linked to another one, by cell.

    ``one`` has rows (name, key), some of them more than once, ``sets`` has
    (name, n).  The keys are dealt a single time, whatever their number: what
    is counted and what is kept are the same rows.  A set has each of its keys
    once, so the sets of one key are a small part of all rows.  Of the keys of
    one kind, linked sets share ``least``, and a set keeps all but the
    ``least`` - 1 most frequent.
    """
    same = Window.partitionBy("key")
    shared = (one.repartition("key").dropDuplicates(["key", "name"])
              .withColumn("many", F.count(F.lit(1)).over(same)).where("many > 1"))
    kind = F.col("key").bitwiseAND(F.lit(KIND)).cast("int")
    slices = F.array(*(F.lit(_slices(b, t, {})[2]) for b in range(KIND)))
    ranked = (shared.join(sets.select("name", "n"), "name").groupBy("name", kind.alias("kind"))
              .agg(F.array_sort(F.collect_list(F.struct("many", "key"))).alias("ks"),
                   F.first("n").alias("n"))
              .withColumn("least", F.when(F.col("kind") == 0, F.expr(
                  f"int((n * {t.num} + {t.den - 1}) div {t.den})"))
                  .otherwise(F.get(slices, F.col("kind") - 1)))
              .where("size(ks) >= least"))
    few = stage(ranked.select("name", F.explode(F.expr(
        "slice(ks, 1, size(ks) - least + 1)")).alias("k")).select("name", "k.key"), "rare-keys")
    least = stage(few.groupBy("key").agg(F.min("name").alias("least"),
                                         F.count(F.lit(1)).alias("n")).where("n > 1")
                  .select("key", "least"), "key-least")
    edges = few.join(least, "key").select(F.col("name").alias("u"), F.col("least").alias("v"))
    return components(edges)


def _intersections(sets: list[np.ndarray], rows: int) -> np.ndarray:
    """Intersection sizes of the first ``rows`` sets with all sets."""
    flat = np.concatenate(sets)
    of = np.repeat(np.arange(len(sets)), [len(s) for s in sets])
    values, inverse, count = np.unique(flat, return_inverse=True, return_counts=True)
    keep = count[inverse] > 1
    inverse, of = inverse[keep], of[keep]
    order = np.argsort(inverse, kind="stable")
    inverse, of = inverse[order], of[order]
    out = np.zeros((rows, len(sets)), np.float32)
    # columns in strips, so that the 0/1 matrix stays small
    width = max(64, (8 << 20) // len(sets))
    column = np.cumsum(np.concatenate(([0], inverse[1:] != inverse[:-1]))) if len(inverse) else inverse
    total = int(column[-1]) + 1 if len(column) else 0
    for a in range(0, total, width):
        lo, hi = np.searchsorted(column, [a, a + width])
        strip = np.zeros((len(sets), min(width, total - a)), np.float32)
        strip[of[lo:hi], column[lo:hi] - a] = 1
        out += strip[:rows] @ strip.T
    return out


def voronoi(sets: list[np.ndarray], home: np.ndarray, eps: float, sizes: np.ndarray
            ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places, home flags) of regions that every link of a home set lies in.

    Pivots are drawn from the home sets, about the root of their number.  A
    region is home to the sets nearest to its pivot, and sees all sets within
    the window of twice ``eps``.  Regions of more than two sets are cut again
    as long as pivots shrink them.
    """
    todo = [(np.arange(len(sets)), home)]
    while todo:
        at, own = todo.pop()
        some = at[own]
        pivots = some[::max(1, math.isqrt(len(some)))][:PIVOTS]
        if len(at) <= 2 or len(pivots) < 2:
            yield at, own
            continue
        both = _intersections([sets[i] for i in (*pivots, *at)], len(pivots))[:, len(pivots):]
        far = 1 - both / (sizes[pivots][:, None] + sizes[at] - both)
        best = far.argmin(0)
        near = far <= far.min(0) + 2 * eps + 1e-6
        for j in range(len(pivots)):
            inner = own & (best == j)
            if not inner.any():
                continue
            seen = at[near[j]], inner[near[j]]
            if len(seen[0]) > 0.9 * len(at):
                yield seen
            else:
                todo.append(seen)


def join_region(names: np.ndarray, home: np.ndarray, copies: np.ndarray, sets: list[np.ndarray],
                t: Threshold, counts: bool = True) -> list[tuple[int, int, int]]:
    """(name, links, label): documents linked to each home set by other sets,
    and smaller names that the region's links connect sets with.

    The region is cut around pivots of its own first.  Without ``counts``
    another region counts the links between home sets.
    """
    order = np.argsort(names, kind="stable")       # names are hashes: pivots come at random
    names, home, copies = names[order], home[order], copies[order]
    sets = [sets[i] for i in order]
    sizes = np.array([len(s) for s in sets], np.int64)
    out = []
    for at, own in voronoi(sets, home, t.eps, sizes):
        at = np.concatenate((at[own], at[~own]))
        counted = np.ones(len(at), bool) if counts else ~home[at]
        out += _join_leaf(names[at], int(own.sum()), copies[at], [sets[i] for i in at],
                          sizes[at], counted, t)
    return out


def _join_leaf(names: np.ndarray, h: int, copies: np.ndarray, sets: list[np.ndarray],
               sizes: np.ndarray, counted: np.ndarray, t: Threshold
               ) -> list[tuple[int, int, int]]:
    """All links of the first ``h`` sets; those to ``counted`` sets are counted."""
    both = np.rint(_intersections(sets, h)).astype(np.int64)
    linked = t.den * both >= t.num * (sizes[:h, None] + sizes[None, :] - both)
    linked &= names[:h, None] != names[None, :]
    links = (linked & counted) @ copies
    label = names.copy()
    while True:                                  # least name along links
        near = np.where(linked, label[None, :], np.iinfo(np.int64).max)
        rows = np.minimum(label[:h], near.min(1))
        cols = np.where(linked, rows[:, None], np.iinfo(np.int64).max).min(0, initial=2**63 - 1)
        new = np.minimum(label, cols)
        new[:h] = np.minimum(new[:h], rows)
        if (new == label).all():
            break
        label = new
    return [(int(names[i]), int(links[i]) if i < h else 0, int(label[i]))
            for i in range(len(names)) if i < h or label[i] != names[i]]


def _distance(a: np.ndarray, b: np.ndarray) -> float:
    both = np.searchsorted(b, a, "right") - np.searchsorted(b, a, "left")
    i = int(both.sum())
    return 1 - i / (len(a) + len(b) - i)


def _refine(rows: DataFrame, big: DataFrame, level: int, eps: float) -> DataFrame:
    """Rows of the big cells, dealt to the Voronoi regions of new pivots."""
    chosen = (rows.join(F.broadcast(big), "cell").where("home")
              .where(F.pmod(F.xxhash64("name", F.lit(level)), F.col("rows"))
                     < F.least(F.lit(PIVOTS), F.col("rows") / F.lit(REGION_ROWS // 2))))
    pivots: dict[int, list[tuple[int, np.ndarray]]] = {}
    for r in chosen.select("cell", "name", "set").collect():     # sized by the caller
        pivots.setdefault(r["cell"], []).append((r["name"], np.array(r["set"], np.int64)))
    sent = rows.sparkSession.sparkContext.broadcast(pivots)

    def run(batches):
        for b in batches:
            take, cell, home = [], [], []
            for i, (c, x, s) in enumerate(zip(b.column("cell").to_pylist(),
                                              b.column("home").to_pylist(),
                                              b.column("set"))):
                near = sent.value.get(c)
                if not near:                     # no pivot was drawn: it stays one region
                    take.append(i)
                    cell.append(c)
                    home.append(x)
                    continue
                s = s.values.to_numpy()
                d = [_distance(s, p) for _, p in near]
                best = min(range(len(d)), key=lambda j: (d[j], near[j][0]))
                for j, dj in enumerate(d):
                    if dj <= d[best] + 2 * eps + 1e-12:
                        take.append(i)
                        cell.append(set_name(np.array([c, near[j][0], level])))
                        home.append(x and j == best)
            idx = pa.array(take, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell, pa.int64()), pa.array(home, pa.bool_()),
                 *(b.column(c).take(idx) for c in ("name", "copies", "set"))],
                names=["cell", "home", "name", "copies", "set"])
        give_back()

    return rows.join(F.broadcast(big.select("cell")), "cell", "left_semi").select(
        "cell", "home", "name", "copies", "set").mapInArrow(
        run, schema("cell long, home boolean, name long, copies long, set array<long>"))


def _regions(members: DataFrame, t: Threshold, region_rows: int) -> DataFrame:
    """(region, home, name, copies, set, counts): rows to be joined within a
    region; it counts the links between its home rows if ``counts``."""
    done, rows = [], members
    before = uncut = None
    for level in range(DEPTH + 1):
        sizes = stage(rows.groupBy("cell").agg(F.count(F.lit(1)).alias("rows"),
                                               F.sum(F.size("set")).alias("held")),
                      "cell-sizes")
        big = sizes.where(F.col("rows") > region_rows)
        stat = big.agg(F.count(F.lit(1)).alias("n"), F.sum("rows").alias("rows"),
                       F.sum(F.col("rows").cast("double") * F.col("rows")).alias("pairs"),
                       F.max(F.col("held") / F.col("rows")).alias("each")).first()
        if not stat["n"]:
            done.append(rows)
            break
        if before is not None and stat["pairs"] >= before["pairs"]:
            # every region saw about all of its cell: blocks of the cells are fewer rows
            done.append(_blocks(*uncut, region_rows))
            break
        small = rows.join(_bounded(big.select("cell")), "cell", "left_anti")
        done.append(small)
        left = rows.join(_bounded(big.select("cell")), "cell", "left_semi")
        stuck = before is not None and stat["rows"] > 0.9 * before["rows"]
        heavy = stat["n"] * 2 * PIVOTS * stat["each"] * 8 > PIVOT_BYTES
        if level == DEPTH or stuck or heavy or stat["n"] > BROADCAST_ROWS:
            done.append(_blocks(left, sizes, region_rows))
            break
        before, uncut = stat, (left, sizes)
        rows = stage(_refine(left, big, level, t.eps), "regions")
    whole = [d if "counts" in d.columns else d.withColumn("counts", F.lit(True)) for d in done]
    out = whole[0].select("cell", "home", "name", "copies", "set", "counts")
    for d in whole[1:]:
        out = out.unionByName(d.select("cell", "home", "name", "copies", "set", "counts"))
    return out.withColumnRenamed("cell", "region")


def _blocks(rows: DataFrame, sizes: DataFrame, region_rows: int) -> DataFrame:
    """Cells as block pairs: each block of home rows meets every block, and
    counts the links within itself where it meets its own."""
    half = region_rows // 2
    placed = (rows.join(sizes.select("cell", "rows"), "cell")
              .withColumn("_b", F.ceil(F.col("rows") / half).cast("int"))
              .withColumn("_i", F.pmod(F.xxhash64("name"), F.col("_b")).cast("int")))
    every = F.explode(F.sequence(F.lit(0), F.col("_b") - 1))
    left = (placed.where("home").select("*", every.alias("_j"))
            .withColumn("counts", F.col("_i") == F.col("_j"))
            .withColumn("cell", F.xxhash64("cell", "_i", "_j")))
    right = (placed.select("*", every.alias("_j"))
             .where(~F.col("home") | (F.col("_i") != F.col("_j")))
            .withColumn("counts", F.col("_i") == F.col("_j"))
             .withColumn("cell", F.xxhash64("cell", F.col("_j"), F.col("_i")))
             .withColumn("home", F.lit(False)))
    return left.unionByName(right)


def _joined(regions: DataFrame, t: Threshold) -> DataFrame:
    """(name, links, label) of the home sets and of window sets with a link."""
    def run(batches):
        held, region = [], None

        def flush():
            if not held or not any(x[0] for x in held):
                return []
            return join_region(np.array([x[1] for x in held]), np.array([x[0] for x in held]),
                               np.array([x[2] for x in held]), [x[3] for x in held], t, held[0][4])

        def batch(rows):
            cols = list(zip(*rows)) if rows else [[]] * 3
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols],
                                              names=["name", "links", "label"])

        for b in batches:
            out = []
            for r, home, name, copies, counts, s in zip(
                    *(b.column(c).to_pylist()
                      for c in ("region", "home", "name", "copies", "counts")),
                    b.column("set")):
                if r != region:
                    out += flush()
                    held, region = [], r
                held.append((home, name, copies, s.values.to_numpy().copy(), counts))
            yield batch(out)
        yield batch(flush())
        held.clear()
        give_back()

    return (regions.repartition("region").sortWithinPartitions("region")
            .mapInArrow(run, schema("name long, links long, label long")))


def jaccard_components(docs: DataFrame, text: str = "text", row_id: str = "doc_id", k: int = 3,
                       num: int = 90, den: int = 100,
                       region_rows: int = REGION_ROWS) -> DataFrame:
    """(row_id, n_shingles, component_id, n_links), one row per document.

    Documents link when den * |A and B| >= num * |A or B| over their sets of
    distinct k-word shingles; n_links counts the others that a document links
    with, component_id is the smallest row id reachable by links.  A null,
    empty or blank text has no shingles, links with nothing, and is its own
    component.  Equal texts link.  Null row ids take part and count as the
    largest; a component of null ids only has a null id.  Rows with the same
    id are documents of their own.  Other columns of ``docs`` are not read.
    Sets are compared by 64-bit hashes of shingles.
    """
    t = Threshold(num, den)
    docs = small_batches(docs).select(F.col(row_id), F.col(text))
    rows = stage(_described(docs, text, row_id, k), "shingle-rows")
    sets = stage(rows.where("n > 0").groupBy("name").agg(
        F.min("id").alias("id"), F.count(F.lit(1)).alias("copies"), F.first("n").alias("n")),
        "shingle-sets")
    # keys are long: they are made for one shuffle, and not written
    cells = stage(_cells(_keyed(docs, text, k, t), sets, t), "cells")

    # the sets of the cells' members are made anew from one text each
    wanted = cells.join(sets.select("name", "id", "copies"), F.col("node") == F.col("name")).select(
        "name", "id", "copies", F.col("root").alias("cell"))
    wanted = stage(wanted, "cell-members")
    ids = wanted.select(F.col("id").alias("_want")).distinct()
    texts = docs.join(_bounded(stage(ids, "cell-ids")), docs[row_id].eqNullSafe(F.col("_want")),
                      "left_semi")

    def make(batches):
        for b in batches:
            names, found = [], []
            for h in words([(x or "").encode() for x in b.column(0).to_pylist()]):
                s = shingle_set(h, k)
                if len(s):
                    names.append(set_name(s))
                    found.append(np.sort(s.view(np.int64)))
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.int64()), pa.array(found, pa.list_(pa.int64()))],
                names=["name", "set"])
        give_back()

    made = texts.select(text).mapInArrow(make, schema("name long, set array<long>"))
    members = stage(made.join(wanted, "name").groupBy("name").agg(
        F.first("cell").alias("cell"), F.first("copies").alias("copies"),
        F.first("set").alias("set")).withColumn("home", F.lit(True)), "member-sets")
    joined = stage(_joined(_regions(members, t, region_rows), t), "region-links")

    links = joined.groupBy("name").agg(F.sum("links").alias("links"))
    roots = components(joined.select(F.col("name").alias("u"), F.col("label").alias("v")))
    named = (sets.select("name", "id", "copies")
             .join(roots.withColumnRenamed("node", "name"), "name", "left")
             .join(links, "name", "left")
             .withColumn("root", F.coalesce("root", "name")))
    named = stage(named.select("name", "id", "root", "copies", F.coalesce("links", F.lit(0))
                               .alias("links")), "set-roots")
    least = stage(named.groupBy("root").agg(F.min("id").alias("component_id")), "root-least")
    facts = stage(named.join(least, "root").select(
        "name", "component_id", (F.col("links") + F.col("copies") - 1).alias("n_links")),
        "set-facts")
    return (rows.select(F.col("id"), F.col("n").alias("n_shingles"), "name")
            .join(facts, "name", "left")
            .select(F.col("id").alias(row_id), "n_shingles",
                    F.when(F.col("name").isNull(), F.col("id")).otherwise(F.col("component_id"))
                    .alias("component_id"),
                    F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links")))


def without_near_copies(docs: DataFrame, text: str = "text", row_id: str = "doc_id", k: int = 5,
                        num: int = 80, den: int = 100) -> DataFrame:
    """``docs`` with one row of each component: the one with the smallest id.

    Texts without words are no copies of each other and stay.  Where row ids
    repeat, the rows are numbered first, and of rows with the smallest id the
    first one stays.
    """
    many = docs.agg(F.count(F.lit(1)).alias("n"), F.countDistinct(row_id).alias("d"),
                    F.count_if(F.col(row_id).isNull()).alias("nulls")).first()
    if many["n"] == many["d"] + many["nulls"] and many["nulls"] <= 1:
        found = jaccard_components(docs, text, row_id, k, num, den)
        gone = stage(found.where(~F.col(row_id).eqNullSafe(F.col("component_id")))
                     .select(F.col(row_id).alias("_gone")), "near-copies")
        return docs.join(_bounded(gone), docs[row_id].eqNullSafe(F.col("_gone")), "left_anti")
    rows = stage(own_columns(docs, ["_row"]).withColumn("_row", F.monotonically_increasing_id()),
                 "numbered-rows")
    found = jaccard_components(rows, text, "_row", k, num, den)
    best = F.struct(F.col(row_id).isNull(), F.col(row_id), F.col("_row"))
    stays = (found.join(rows.select("_row", row_id), "_row").groupBy("component_id")
             .agg(F.min(best).alias("b")).select(F.col("b._row").alias("_row")))
    return rows.join(stays, "_row", "left_semi").select(*docs.columns)


def op5_jaccard_join(spark, sf_dir):
    docs = read(spark, sf_dir, "documents").select("doc_id", "text")
    return jaccard_components(docs)
