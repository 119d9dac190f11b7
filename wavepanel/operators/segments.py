"""Running (prefix) aggregates per key that stay balanced under key skew.

A window ``partitionBy(key).orderBy(...)`` sorts every key inside one task.
That is the right plan while each key is small, and a single task that must
sort a third of the table when one key is hot.  ``running`` keeps the plain
window for ordinary keys and splits each hot key into ordered *segments*:

1. one aggregate finds the keys holding more than ``wavepanel.rowsPerSegment``
   rows (their number is bounded by rows / threshold, so the table is
   written to the checkpoint folder and broadcast);
2. the rows of hot keys are range-partitioned by key and order columns, about
   two ranges per threshold of rows, and staged with the number of their range.
   Ranges follow the order, so a key's ranges are consecutive slices of it.
   Spark draws the bounds from a bounded sample; any type that sorts will do,
   NULL keys and NULL order values are split like others (NULL sorts first),
   and a frequent first value is split by the columns after it;
3. a small table of per-segment summaries is prefix-combined with a window
   over ``(key, segment)`` (tiny), giving the carry-in of every segment;
4. the window runs per ``(key, segment)`` and adds the carry-in.

With ``frame="range"`` all rows of a hot key with one order value share a
result, so it is computed on a (key, value) table and joined back.

The result equals the plain window exactly; only the work split differs.
Rows that tie on every order column stay together, so give a tie-break.
Supported running aggregates: ``sum`` (nulls count as 0), ``last`` (last
non-null value, ROWS frame), and ``group_sum`` (whole-key total).
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavepanel.session import ensure_checkpoint_dir, max_broadcast_rows, rows_per_segment, stage

SEG = "_wp_seg"


def _cols(xs: Sequence[str | Column]) -> list[Column]:
    return [F.col(x) if isinstance(x, str) else x for x in xs]


def hot_keys(df: DataFrame, keys: Sequence[str], limit: int,
             info: dict | None = None) -> tuple[DataFrame | None, int, int]:
    """Keys with more than ``limit`` rows, written to the checkpoint folder.

    Returns ``(table, n_hot, max_rows)``; ``table`` is None when no key is hot.
    The table has at most ``rows / limit`` rows, which is what makes it safe
    to broadcast.  ``info`` (if given) receives ``n_keys``, the number of
    distinct keys, from the same job.
    """
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_wp_n"))
    summary = counts.agg(F.count(F.lit(1)).alias("keys"),
                         F.count_if(F.col("_wp_n") > limit).alias("k"),
                         F.max(F.when(F.col("_wp_n") > limit, F.col("_wp_n"))).alias("m")).first()
    if info is not None:
        info["n_keys"] = int(summary["keys"]) if summary else 0
    if not summary or not summary["k"]:
        return None, 0, 0
    ensure_checkpoint_dir(df.sparkSession)
    hot = counts.where(F.col("_wp_n") > limit)
    return hot.checkpoint(eager=True), int(summary["k"]), int(summary["m"])


def _maybe_broadcast(df: DataFrame, n_rows: int) -> DataFrame:
    return F.broadcast(df) if n_rows <= max_broadcast_rows(df.sparkSession) else df


def join_keys(df: DataFrame, side: DataFrame, keys: Sequence[str], how: str,
              n_rows: int) -> DataFrame:
    """Join with a per-key table, NULL keys matching; ``side``'s key columns
    are not kept.  ``n_rows`` is its counted size."""
    named = side.withColumnsRenamed({k: f"_wp_side{i}" for i, k in enumerate(keys)})
    match = F.lit(True)
    for i, k in enumerate(keys):
        match = match & F.col(k).eqNullSafe(F.col(f"_wp_side{i}"))
    out = df.join(_maybe_broadcast(named, n_rows), match, how)
    return out.drop(*[f"_wp_side{i}" for i in range(len(keys))])


def assign_segments(df: DataFrame, keys: Sequence[str], order: Sequence[str],
                    limit: int | None = None, info: dict | None = None,
                    hot: tuple | None = None) -> tuple[DataFrame, DataFrame | None]:
    """(rows of ordinary keys, rows of hot keys with ``_wp_seg``, staged).

    The second is None without a hot key.  ``hot`` is a ``hot_keys`` result
    already computed for the same rows and keys (e.g. shared by several
    operators), which skips the detection job.
    """
    keys = list(keys)
    limit = limit or rows_per_segment(df.sparkSession)
    hot, n_hot, _ = hot if hot is not None else hot_keys(df, keys, limit, info)
    if hot is None:
        return df, None
    n = max(2, math.ceil(2.0 * hot.agg(F.sum("_wp_n")).first()[0] / limit))
    names = hot.select(*keys)
    ranged = (join_keys(df, names, keys, "left_semi", n_hot)
              .repartitionByRange(n, *keys, *order).withColumn(SEG, F.spark_partition_id()))
    return join_keys(df, names, keys, "left_anti", n_hot), stage(ranged, "segments")


def _windows(df: DataFrame, part: Sequence[str], order: Sequence[str],
             aggs: dict[str, tuple[str, Column]], frame: str) -> DataFrame:
    """The plain windows."""
    w_order = Window.partitionBy(*part).orderBy(*_cols(order))
    w_run = (w_order.rowsBetween(Window.unboundedPreceding, Window.currentRow) if frame == "rows"
             else w_order.rangeBetween(Window.unboundedPreceding, Window.currentRow))
    w_all = Window.partitionBy(*part)
    local = {}
    for name, (kind, c) in aggs.items():
        if kind == "sum":
            local[name] = F.coalesce(F.sum(c).over(w_run), F.lit(0))
        elif kind == "last":
            local[name] = F.last(c, ignorenulls=True).over(w_run)
        elif kind == "group_sum":
            local[name] = F.coalesce(F.sum(c).over(w_all), F.lit(0))
        else:
            raise ValueError(f"unknown running aggregate {kind!r}")
    return df.withColumns(local)


def running(df: DataFrame, keys: Sequence[str], order: Sequence[str],
            aggs: dict[str, tuple[str, Column]], frame: str = "rows",
            limit: int | None = None, info: dict | None = None,
            hot: tuple | None = None) -> DataFrame:
    """Add running aggregates per key in the given order.

    ``aggs`` maps an output name to ``(kind, column)``, kind one of
    ``sum`` | ``last`` | ``group_sum``.  ``frame="range"`` makes ``sum`` include
    all rows tied on the first order column (SQL ``RANGE`` frame); it needs
    only ``order[0]``.  ``last`` requires ``frame="rows"``.  ``info`` (if
    given) receives ``n_keys``, the number of distinct keys.
    """
    keys = list(keys)
    order = list(order)
    if not keys:
        # one global group: a constant key lets the hot-key path split it
        out = running(df.withColumn("_wp_all", F.lit(0)), ["_wp_all"], order, aggs, frame, limit, info)
        return out.drop("_wp_all")
    if frame not in ("rows", "range"):
        raise ValueError("frame must be 'rows' or 'range'")
    if frame == "range":
        if any(kind == "last" for kind, _ in aggs.values()):
            raise ValueError("'last' needs a ROWS frame")
        order = order[:1]
    limit = limit or rows_per_segment(df.sparkSession)
    hot = hot if hot is not None else hot_keys(df, keys, limit, info)
    if hot[0] is None:
        return _windows(df, keys, order, aggs, frame)
    if frame == "rows":
        cold, mine = assign_segments(df, keys, order, limit, hot=hot)
        split = _hot_rows(mine, keys, order, aggs)
    else:
        names = hot[0].select(*keys)
        cold = join_keys(df, names, keys, "left_anti", hot[1])
        split = _hot_values(join_keys(df, names, keys, "left_semi", hot[1]), keys, order, aggs,
                            limit)
    plain = _windows(cold, keys, order, aggs, frame)
    return plain.unionByName(split.select(*[F.col(f.name).cast(f.dataType).alias(f.name)
                                            if f.name in aggs else F.col(f.name)
                                            for f in plain.schema.fields]))


def _hot_rows(mine: DataFrame, keys: list[str], order: list[str],
              aggs: dict[str, tuple[str, Column]]) -> DataFrame:
    """Windows per (key, segment) plus what the segments before carry in."""
    part = keys + [SEG]
    # one row per key and segment: about 2 * rows / limit
    summ = []
    for name, (kind, c) in aggs.items():
        if kind == "last":
            summ.append(F.max(F.when(c.isNotNull(), F.struct(*[F.col(o) for o in order], c.alias("v"))))
                        .alias(f"_s_{name}"))
        else:
            summ.append(F.coalesce(F.sum(c), F.lit(0)).alias(f"_s_{name}"))
    seg_tab = mine.groupBy(*part).agg(*summ)
    w_prev = Window.partitionBy(*keys).orderBy(SEG).rowsBetween(Window.unboundedPreceding, -1)
    w_key = Window.partitionBy(*keys)
    carry = {}
    for name, (kind, _) in aggs.items():
        s = F.col(f"_s_{name}")
        if kind == "sum":
            carry[f"_o_{name}"] = F.coalesce(F.sum(s).over(w_prev), F.lit(0))
        elif kind == "group_sum":
            carry[f"_o_{name}"] = F.sum(s).over(w_key)
        else:
            carry[f"_o_{name}"] = F.last(s, ignorenulls=True).over(w_prev)["v"]
    offsets = stage(seg_tab.withColumns(carry).select(*part, *carry.keys()), "segment-offsets")
    joined = join_keys(_windows(mine, part, order, aggs, "rows"), offsets, part, "left",
                       offsets.count())
    final = {}
    for name, (kind, _) in aggs.items():
        o = F.col(f"_o_{name}")
        if kind == "sum":
            final[name] = F.col(name) + o
        elif kind == "group_sum":
            final[name] = o
        else:
            final[name] = F.coalesce(name, o)
    return joined.withColumns(final).drop(SEG, *carry.keys())


def _hot_values(mine: DataFrame, keys: list[str], order: list[str],
                aggs: dict[str, tuple[str, Column]], limit: int) -> DataFrame:
    """RANGE frame: running totals over distinct values, joined back."""
    by = keys + order
    values = mine.groupBy(*by).agg(*[F.sum(c).alias(f"_v_{n}") for n, (_, c) in aggs.items()])
    done = running(values, keys, order, {n: (kind, F.col(f"_v_{n}"))
                                         for n, (kind, _) in aggs.items()}, limit=limit)
    done = stage(done.select(*by, *aggs), "segment-values")
    return join_keys(mine.drop(*[c for c in aggs if c in mine.columns]), done, by, "left",
                     done.count())
