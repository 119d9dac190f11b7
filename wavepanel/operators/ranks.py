"""Income-rank crosswalk: weighted ECDF ranks, binning, median rank per bin,
and the validated many-to-one lookup back onto a panel.

Plan shape.  The ECDF is a running weighted sum per group (``segments.running``),
so a group holding a third of the table is still sorted by many tasks.  The
crosswalk ranks no rows at all: a bin is a slice of the income order, so counts
and weights of the (group, bin) cells, which no sort needs, fix the position of
each median; a sketch brackets the incomes there, and only the rows within the
bracket are ordered.  The count per cell comes from the same aggregate.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from wavepanel.functions.columns import clamp_low, cut
from wavepanel.operators.segments import join_keys, running
from wavepanel.operators.stats import exact_quantiles
from wavepanel.session import max_broadcast_rows, stage

# Family-income bin edges of the survey (lower edges of the
# 11 answer categories, plus an open top edge).
SURVEY_INCOME_EDGES = [0, 10000, 20000, 30000, 40000, 50000, 60000, 75000,
                       100000, 150000, 200000, 1e20]


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def weighted_ecdf(df: DataFrame, value: str, weight: str | Column | None = None,
                  by: Sequence[str] = (), tiebreak: str | None = None,
                  ties: str = "rows", rank_col: str = "rank",
                  pos_col: str | None = None, limit: int | None = None,
                  info: dict | None = None) -> DataFrame:
    """Weighted empirical CDF of ``value`` within ``by`` (frequency weights).

    ``rank = (sum of weights up to this row) / (group total)``; rows with a
    missing value or weight get NULL and do not count.  ``ties="rows"`` gives
    tied values successive ranks in ``(value, tiebreak)`` order (a tie-break
    column is required for a deterministic answer); ``ties="equal"`` gives
    tied values the same, largest, rank.  ``pos_col`` adds the 0-based
    position of the row among the group's ranked rows.
    """
    if ties not in ("rows", "equal"):
        raise ValueError("ties must be 'rows' or 'equal'")
    if ties == "rows" and tiebreak is None:
        raise ValueError("ties='rows' needs a tie-break column")
    w = F.lit(1) if weight is None else _c(weight)
    valid = F.col(value).isNotNull() & w.isNotNull()
    work = df.withColumns({"_wp_w": F.when(valid, w).otherwise(F.lit(0)),
                           "_wp_v": valid.cast("int")})
    aggs = {"_wp_cw": ("sum", F.col("_wp_w")), "_wp_tw": ("group_sum", F.col("_wp_w"))}
    if pos_col:
        aggs["_wp_cn"] = ("sum", F.col("_wp_v"))
    order = [value] + ([tiebreak] if tiebreak else [])
    frame = "rows" if ties == "rows" else "range"
    out = running(work, list(by), order, aggs, frame=frame, limit=limit, info=info)
    cols = {rank_col: F.when(F.col("_wp_v") == 1, F.try_divide("_wp_cw", "_wp_tw"))}
    if pos_col:
        cols[pos_col] = F.when(F.col("_wp_v") == 1, F.col("_wp_cn") - 1)
    return out.withColumns(cols).drop("_wp_w", "_wp_v", "_wp_cw", "_wp_tw", "_wp_cn")


def _and(conds):
    out = conds[0]
    for c in conds[1:]:
        out = out & c
    return out


def rank_crosswalk(df: DataFrame, income: str, weight: str | Column | None,
                   by: Sequence[str], tiebreak: str, edges: Sequence[float] = SURVEY_INCOME_EDGES,
                   ties: str = "rows", clamp_at: float | None = 0.0,
                   missing_codes: tuple[float, float] | None = None,
                   count_col: str | None = None, limit: int | None = None) -> DataFrame:
    """Median weighted-ECDF rank of ``income`` per (``by``, income bin).

    Steps: optional special codes -> missing; weighted ECDF rank within
    ``by``; clamp income at ``clamp_at`` (missing -> clamp value); cut into
    left-closed bins at ``edges``; median rank per (by, bin) (and the count
    of ranked rows if ``count_col``); drop rows without a bin; ``ibin`` = the
    1-based index of the bins present within ``by``.  Output columns:
    ``by..., ibin, lbound, rank[, count_col]``.
    """
    by = list(by)
    x = F.col(income)
    if missing_codes is not None:
        lo, hi = missing_codes
        x = F.when(~x.between(F.lit(lo), F.lit(hi)) | x.isNull(), x)
    work = df.select(*by, F.col(tiebreak).alias("_wp_t"), x.alias("_wp_x"),
                     (F.lit(1) if weight is None else _c(weight)).alias("_wp_wt"))
    if ties == "equal":
        return _equal_rank_crosswalk(work, by, edges, clamp_at, count_col, limit)
    return _selected_rank_crosswalk(work, by, edges, clamp_at, count_col, limit)


# Relative rank error of the sketch that brackets a cell's median.
SKETCH_ACCURACY = 1000


def median_values(work: DataFrame, by: list[str], edges: Sequence[float],
                  clamp_at: float | None) -> tuple[DataFrame, DataFrame]:
    """(cells, values): what the median ranks are read from, both staged.

    ``cells`` has per (by, lbound): the number and weight of its ranked rows,
    the weight of the rows before it, the group's total weight and the median
    positions.  Bins are slices of the income order, so no row is sorted for
    that.  A sketch of each cell brackets the incomes at its median positions;
    in ``values`` all ranked rows below the bracket are one row with their
    number and weight, and only the rows within it are rows of their own.
    """
    x, w = F.col("_wp_x"), F.col("_wp_wt")
    valid = x.isNotNull() & w.isNotNull()
    clamped = clamp_low("_wp_x", clamp_at) if clamp_at is not None else x
    rows = work.withColumn("lbound", cut(clamped, edges))
    near = 2 / SKETCH_ACCURACY
    low = F.coalesce(F.col("lbound").isNull() & (x < F.lit(float(edges[0]))), F.lit(False))
    found = rows.groupBy(*by, "lbound", low.alias("_low")).agg(
        F.count_if(valid).alias("_n"), F.coalesce(F.sum(F.when(valid, w)), F.lit(0)).alias("_w"),
        F.min(F.when(valid, x)).alias("_from"), F.max(F.when(valid, x)).alias("_to"),
        F.percentile_approx(F.when(valid, x), [0.5 - near, 0.5 + near], SKETCH_ACCURACY)
        .alias("_near"))
    group = Window.partitionBy(*by)
    before = group.orderBy("_from").rowsBetween(Window.unboundedPreceding, -1)
    found = found.withColumns({"_before": F.coalesce(F.sum("_w").over(before), F.lit(0)),
                               "_total": F.sum("_w").over(group)})
    sure = F.col("_n") > SKETCH_ACCURACY
    cells = stage(found.where(F.col("lbound").isNotNull()).select(
        *by, "lbound", "_n", "_before", "_total",
        F.floor((F.col("_n") - 1) / 2).alias("_mid_lo"), F.ceil((F.col("_n") - 1) / 2).alias("_mid_hi"),
        F.when(sure, F.col("_near")[0]).otherwise(F.col("_from")).alias("_lo"),
        F.when(sure, F.col("_near")[1]).otherwise(F.col("_to")).alias("_hi")), "cells")
    ranked = rows.where(valid & F.col("lbound").isNotNull())
    side = cells.select(*by, "lbound", "_lo", "_hi")
    placed = join_keys(ranked, side, by + ["lbound"], "inner", cells.count())
    inside = F.col("_wp_x") >= F.col("_lo")
    kept = placed.where(F.col("_wp_x") <= F.col("_hi")).select(
        *by, "lbound", w.alias("_wt"), F.when(inside, x).alias("_x"),
        F.when(inside, F.col("_wp_t")).alias("_t"), F.when(inside, w).alias("_each"))
    values = kept.groupBy(*by, "lbound", "_x", "_t", "_each").agg(
        F.count(F.lit(1)).alias("_n"), F.sum("_wt").alias("_w"))
    return cells, stage(values, "median-values")


def _selected_rank_crosswalk(work: DataFrame, by: list[str], edges: Sequence[float],
                             clamp_at: float | None, count_col: str | None,
                             limit: int | None) -> DataFrame:
    """The crosswalk by distributed selection: counts and weights of the cells
    fix the positions of the medians, and only the rows around them are
    ordered.  Rows alike in income, tie-break and weight are one."""
    cells, values = median_values(work, by, edges, clamp_at)
    cell = by + ["lbound"]
    ordered = running(values, cell, ["_x", "_t", "_each"], {
        "_cn": ("sum", F.col("_n")), "_cw": ("sum", F.col("_w"))}, limit=limit)
    ordered = ordered.select(*cell, "_x", "_each", "_cn", (F.col("_cn") - F.col("_n")).alias("_sn"),
                             (F.col("_cw") - F.col("_w")).alias("_sw"))
    many = cells.count()
    known = join_keys(ordered, cells, cell, "inner", many)

    def rank_at(mid: str) -> Column:
        here = F.col("_x").isNotNull() & (F.col("_sn") <= F.col(mid)) & (F.col(mid) < F.col("_cn"))
        upto = F.col("_before") + F.col("_sw") + (F.col(mid) - F.col("_sn") + 1) * F.col("_each")
        return F.max(F.when(here, F.try_divide(upto, F.col("_total"))))

    med = known.groupBy(*cell).agg(((rank_at("_mid_lo") + rank_at("_mid_hi")) / 2).alias("rank"))
    ibin = F.row_number().over(Window.partitionBy(*by).orderBy("lbound"))
    out = join_keys(cells.select(*cell, F.col("_n").alias(count_col or "_n")), med, cell, "left", many)
    return out.withColumn("ibin", ibin.cast("int")).select(
        *cell[:-1], "ibin", "lbound", "rank", *([count_col] if count_col else []))


def _equal_rank_crosswalk(work: DataFrame, by: list[str], edges: Sequence[float],
                          clamp_at: float | None, count_col: str | None,
                          limit: int | None) -> DataFrame:
    """The crosswalk when equal incomes share their largest rank.

    Rows of one income have one rank, so everything runs on the counts and
    weights of the distinct incomes; positions come from the counts.
    """
    counted = F.col("_wp_x").isNotNull() & F.col("_wp_wt").isNotNull()
    values = stage(work.groupBy(*by, "_wp_x").agg(
        F.count_if(counted).alias("_wp_n"),
        F.coalesce(F.sum(F.when(counted, F.col("_wp_wt"))), F.lit(0)).alias("_wp_w")), "incomes")
    r = running(values, by, ["_wp_x"], {"_wp_cw": ("sum", F.col("_wp_w")),
                                        "_wp_tw": ("group_sum", F.col("_wp_w"))}, limit=limit)
    rank = F.when(F.col("_wp_n") > 0, F.try_divide("_wp_cw", "_wp_tw"))
    clamped = clamp_low("_wp_x", clamp_at) if clamp_at is not None else F.col("_wp_x")
    binned = stage(r.withColumn("_wp_rank", rank).withColumn("lbound", cut(clamped, edges))
                   .where(F.col("lbound").isNotNull())
                   .select(*by, "lbound", "_wp_rank", "_wp_n"), "ranked-incomes")
    cell = by + ["lbound"]
    med = exact_quantiles(binned, cell, "_wp_rank", [0.5], ["rank"], freq="_wp_n")
    counts = binned.groupBy(*cell).agg(F.sum("_wp_n").alias("_wp_c"))
    same = _and([counts[c].eqNullSafe(med[c]) for c in cell])
    ibin = F.row_number().over(Window.partitionBy(*by).orderBy("lbound"))
    out = counts.join(med, same, "left").select(*[counts[c] for c in cell], med["rank"],
                                                counts["_wp_c"])
    if count_col:
        out = out.withColumn(count_col, F.col("_wp_c"))
    return out.withColumn("ibin", ibin.cast("int")).select(
        *by, "ibin", "lbound", "rank", *([count_col] if count_col else []))


def small_cell_filter(cw: DataFrame, cell: Sequence[str], count_col: str = "nobs",
                      min_total: int = 1000) -> DataFrame:
    """Keep cells whose total ``count_col`` over all bins is at least ``min_total``.

    ``cw`` is a crosswalk (tiny: cells x bins), so the window is cheap.
    """
    total = F.sum(count_col).over(Window.partitionBy(*cell))
    return cw.withColumn("_wp_tot", total).where(F.col("_wp_tot") >= min_total).drop("_wp_tot")


def key_duplicates(df: DataFrame, keys: Sequence[str], count_col: str = "n") -> DataFrame:
    """Keys occurring more than once (empty = the table is unique on ``keys``)."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias(count_col))
              .where(F.col(count_col) > 1))


def validated_crosswalk(crosswalk: DataFrame, rescale: bool = True,
                        validate: bool = True) -> DataFrame:
    """Crosswalk ready for lookups: columns ``_wp_y, _wp_b, _wp_r``.

    One small job checks it: the row count (broadcast decision), uniqueness
    on (year, ibin) (else ValueError: the many-to-one join is refused), and
    the scale (ranks on [0, 1] are put on [0, 100]).  The result is reusable
    for several lookups.
    """
    cw = crosswalk.select(F.col("year").alias("_wp_y"), F.col("ibin").alias("_wp_b"),
                          F.col("rank").cast("double").alias("_wp_r"))
    facts = cw.agg(F.count(F.lit(1)).alias("n"),
                   F.count_distinct(F.struct("_wp_y", "_wp_b")).alias("k"),
                   F.max("_wp_r").alias("top")).first()
    n = facts["n"]
    if validate and facts["k"] != n:
        raise ValueError("crosswalk is not unique on (year, ibin): many-to-one join refused")
    if rescale and facts["top"] is not None and facts["top"] <= 1.0:
        cw = cw.withColumn("_wp_r", F.col("_wp_r") * F.lit(100.0))
    return F.broadcast(cw) if n <= max_broadcast_rows(crosswalk.sparkSession) else cw


def attach_rank(df: DataFrame, crosswalk: DataFrame, bin_col: str, year_col: str = "year",
                rank_name: str | None = None, rescale: bool = True,
                validate: bool = True) -> DataFrame:
    """Many-to-one LEFT join adding ``<bin_col>_rank`` from a (year, ibin, rank) crosswalk.

    ``df`` is matched on (``year_col``, ``bin_col``) against (year, ibin);
    unmatched rows keep a NULL rank and the row count is unchanged.
    ``crosswalk`` is either a raw crosswalk (checked by
    ``validated_crosswalk``) or the output of ``validated_crosswalk``.
    """
    rank_name = rank_name or f"{bin_col}_rank"
    side = (crosswalk if "_wp_r" in crosswalk.columns
            else validated_crosswalk(crosswalk, rescale=rescale, validate=validate))
    cond = (df[year_col] == side["_wp_y"]) & (df[bin_col] == side["_wp_b"])
    return (df.join(side, cond, "left")
              .withColumnRenamed("_wp_r", rank_name)
              .drop("_wp_y", "_wp_b"))
