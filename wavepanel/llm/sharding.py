"""Minimax contiguous shards over ordered atomic groups.

The groups (rows that share a key) are laid out in key order.  A shard is a
run of neighbouring groups, and the largest shard is made as small as any such
cut allows: the smallest feasible capacity is found by binary search, each
capacity being checked greedily ("fill a shard while the next group fits").

The greedy check only asks "which group boundary is the last one at or below
x?".  The driver answers from a bounded sketch of the running total: some known
boundaries, and for each gap between two of them whether it hides others.  A
capacity is judged with the hidden boundaries as bad and as good as they can
be; the two answers bracket the capacity, and only the gaps that keep the
bracket open are looked into again, in one scan of the running totals.  A few
thousand numbers ever reach the driver, and the result is exact.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage
from .common import own_columns, schema, text_key

# Pieces (two boundaries each) that one look into the open gaps brings to the driver.
PIECES = 8192
# Rows that one task numbers when the slots are given out.
SLOT_ROWS = 200_000


def running_totals(groups: DataFrame, key: str, size: str) -> DataFrame:
    """(key, before, upto): each group's running total in key order, staged.

    One range exchange; the totals of its partitions (one row each) are added
    up and joined back.
    """
    kind = groups.schema[key].dataType.simpleString()

    def add_up(batches):
        total = 0
        for b in batches:
            sizes = b.column(1).to_numpy(zero_copy_only=False).astype(np.int64)
            ends = total + np.cumsum(sizes)
            total = int(ends[-1]) if len(ends) else total
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(ends - sizes), pa.array(ends), b.column(2)],
                names=["k", "lo", "hi", "part"])

    ranged = (groups.select(F.col(key).alias("k"), F.col(size).cast("long").alias("s"))
              .repartitionByRange("k").sortWithinPartitions("k")
              .withColumn("part", F.spark_partition_id()))
    local = stage(ranged.mapInArrow(add_up, schema(f"k {kind}, lo long, hi long, part int")),
                  "shard-totals")
    whole = local.groupBy("part").agg(F.max("hi").alias("t"))
    # one row per range partition: spark.sql.shuffle.partitions bounds it
    base = whole.select("part", (F.sum("t").over(Window.orderBy("part")) - F.col("t"))
                        .alias("base"))
    return (local.join(F.broadcast(base), "part")
            .select("k", (F.col("lo") + F.col("base")).alias("before"),
                    (F.col("hi") + F.col("base")).alias("upto")))


class Boundaries:
    """What the driver knows of the sorted group boundaries."""

    def __init__(self, totals: DataFrame, total: int):
        self.totals, self.total = totals, total
        self.known = [0, total]
        self.open = [False, total > 1]     # open[i]: known[i-1]..known[i] hides some

    def floor(self, x: int) -> tuple[int, int]:
        """Least and greatest value that the last boundary <= x can have."""
        i = bisect_right(self.known, x) - 1
        low = self.known[i]
        if i + 1 < len(self.known) and self.open[i + 1] and x > low:
            return low, min(x, self.known[i + 1] - 1)
        return low, low

    def greedy(self, capacity: int, shards: int, hopeful: bool) -> list[int]:
        cuts, at = [], 0
        for _ in range(shards):
            at = self.floor(at + capacity)[hopeful]
            cuts.append(at)
        return cuts

    def least(self, shards: int, hopeful: bool, low: int, high: int) -> int:
        while low < high:
            mid = (low + high) // 2
            if self.greedy(mid, shards, hopeful)[-1] >= self.total:
                high = mid
            else:
                low = mid + 1
        return low

    def look_into(self, gaps: list[int]) -> None:
        """Split each open gap (by index) into pieces, and learn the first and
        the last boundary of each.  What a piece still hides lies between the
        two, so an open gap is half as wide at most after each look."""
        each = max(2, PIECES // len(gaps))
        spans = [(self.known[g - 1], self.known[g]) for g in gaps]
        edges = {a + (b - a) * j // each for a, b in spans for j in range(each + 1)}
        fixed = np.array(sorted(edges), np.int64)

        @F.pandas_udf("int")
        def piece(v):
            import pandas as pd
            return pd.Series(np.searchsorted(fixed, v.to_numpy(), "left").astype("int32"))

        lo, hi = int(fixed[0]), int(fixed[-1])
        found = (self.totals.where((F.col("upto") > lo) & (F.col("upto") <= hi))
                 .groupBy(piece("upto").alias("p"))
                 .agg(F.min("upto").alias("a"), F.max("upto").alias("b"),
                      F.count(F.lit(1)).alias("n"))
                 .collect())                      # one row a piece, and one a space between gaps
        starts = [a for a, _ in spans]
        new = {k: was for k, was in zip(self.known, self.open)}
        for r in found:
            i = bisect_left(starts, r["b"]) - 1   # the gap that starts before it
            if i >= 0 and r["b"] <= spans[i][1]:
                new[r["a"]] = False
                if r["b"] > r["a"]:               # groups of size 0 end where others do
                    new[r["b"]] = r["n"] > 2 and r["b"] - r["a"] > 1
        self.known = sorted(new)
        self.open = [new[k] for k in self.known]

    def unsure(self, low: int, high: int, shards: int) -> list[int]:
        """Open gaps that keep the capacity between low and high: all that any
        cut can fall into, or, where these are many, those of capacity low."""
        worst = [0, *self.greedy(low, shards, False)[:-1]]
        for hopeful in (high, low):
            best = [0, *self.greedy(hopeful, shards, True)[:-1]]
            gaps: set[int] = set()
            for w, b in zip(worst, best):
                for x, y in ([(w + low, b + high)] if hopeful == high else
                             [(w + low, w + low), (b + low, b + low)]):
                    i = max(1, bisect_left(self.known, x))
                    j = min(len(self.known) - 1, bisect_left(self.known, y))
                    gaps.update(g for g in range(i, j + 1) if self.open[g])
            if gaps and len(gaps) <= PIECES // 16:
                break
        return sorted(gaps)

    def solve(self, shards: int, largest: int) -> tuple[int, list[int]]:
        """The least capacity, and cuts that keep to it and are as even as
        the known boundaries allow.

        At capacity low the hopeful check succeeds and the other one fails, so
        one of the gaps that they ask about is open; each look halves it at
        least, so the search ends.
        """
        low = max(largest, -(-self.total // shards))
        high = self.total
        while True:
            low = self.least(shards, True, low, high)
            high = self.least(shards, False, low, high)
            if low == high:
                return low, self.even(low, shards)
            self.look_into(self.unsure(low, high, shards))

    def even(self, capacity: int, shards: int) -> list[int]:
        need = [self.total]                       # least start that leaves the rest feasible
        for _ in range(shards - 1):
            need.append(self.known[bisect_left(self.known, need[-1] - capacity)]
                        if need[-1] > capacity else 0)
        need = need[::-1][:-1]                    # for cuts 1 .. shards-1
        cuts, at = [], 0
        for i, least in enumerate(need):
            aim = at + (self.total - at) // (shards - i)
            top = bisect_right(self.known, at + capacity) - 1
            first = bisect_left(self.known, max(least, at))
            j = min(max(bisect_left(self.known, aim), first), top)
            if j > first and abs(self.known[j - 1] - aim) < abs(self.known[j] - aim):
                j -= 1
            at = self.known[j]
            cuts.append(at)
        return cuts


def minimax_cuts(groups: DataFrame, key: str, size: str, shards: int) -> tuple[int, list]:
    """(capacity, cut keys): shard i ends with cut key i; None cuts before all.

    ``groups`` has one row per atomic group, a non-null orderable ``key`` and
    a size >= 0.  An empty table gives capacity 0 and no group to cut.
    """
    totals = running_totals(groups, key, size)
    top = totals.agg(F.max("upto").alias("t"),
                     F.max(F.col("upto") - F.col("before")).alias("g")).first()
    if not top["t"]:
        return 0, [None] * (shards - 1)
    capacity, cuts = Boundaries(totals, top["t"]).solve(shards, top["g"])
    at = {r["upto"]: r["k"] for r in
          totals.where(F.col("upto").isin(sorted(set(cuts)) or [-1]))
          .groupBy("upto").agg(F.max("k").alias("k")).collect()}   # < shards rows
    return capacity, [at.get(c) for c in cuts]


def shard_of(key, cuts: list):
    """Shard of a key: how many cuts lie before it (no join, no shuffle)."""
    n = F.lit(0)
    for c in cuts:
        n = n + (F.lit(1) if c is None else F.when(key > F.lit(c), 1).otherwise(0))
    return n.cast("int")


def number_rows(df: DataFrame, group: str, order: list[str], rows: int = SLOT_ROWS) -> DataFrame:
    """Adds ``slot``: 0, 1, ... within each value of ``group``.

    The rows of a group are dealt by a hash of their order columns to chunks
    of about ``rows`` rows, numbered there, and shifted by the counts of the
    chunks before; no task ever holds a whole group.
    """
    chunks = max(1, -(-df.count() // rows))
    df = df.withColumn("_chunk", F.pmod(F.xxhash64(*order), F.lit(chunks)).cast("int"))
    sizes = df.groupBy(group, "_chunk").agg(F.count(F.lit(1)).alias("_n"))
    before = Window.partitionBy(group).orderBy("_chunk")
    base = sizes.select(group, "_chunk", (F.sum("_n").over(before) - F.col("_n")).alias("_base"))
    here = Window.partitionBy(group, "_chunk").orderBy(*order)
    return (df.withColumn("_rn", F.row_number().over(here) - 1)
            .join(base, [group, "_chunk"])
            .withColumn("slot", (F.col("_base") + F.col("_rn")).cast("long"))
            .drop("_chunk", "_rn", "_base"))


def shard_texts(docs: DataFrame, shards: int = 8, text: str = "text",
                row_id: str = "doc_id") -> DataFrame:
    """Shards of near equal bytes, equal texts together.

    Adds size (UTF-8 bytes plus 1; a null text has 1), text_crc32, shard and
    slot to ``row_id``.  Null and empty texts are one group.
    Repeated and null row ids are kept as rows of their own.  An empty table
    gives an empty result.  Other columns of ``docs`` are not read.
    """
    rows = stage(docs.select(
        F.col(row_id),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.coalesce(F.crc32(F.col(text).cast("binary")), F.lit(0)).cast("long")
        .alias("text_crc32"),
        text_key(text).alias("_key")), "shard-rows")
    groups = rows.groupBy("_key").agg(F.sum("size").alias("size"))
    _, cuts = minimax_cuts(groups, "_key", "size", shards)
    placed = rows.withColumn("shard", shard_of(F.col("_key"), cuts))
    return number_rows(placed, "shard", ["_key", row_id]).drop("_key")


def op1_minimax_shards(spark, sf_dir):
    from .common import read
    docs = own_columns(read(spark, sf_dir, "documents"), ["size", "text_crc32", "shard", "slot"])
    return (shard_texts(docs).withColumn("law", F.lit("bytes"))
            .withColumn("grown_shard", F.lit(None).cast("int"))
            .select("doc_id", "size", "text_crc32", "law", "shard", "slot", "grown_shard"))
