"""Exact order statistics and weighted summaries.

Every statistic runs on a *value table*: one row per key and distinct value
with its count and weight, built by one aggregate with map-side combine.
Running totals over the distinct values (``segments.running``, which splits hot
keys) then place every position and every share of the weight exactly.  Survey
answers are few codes, so the table is tiny beside the rows, and a value that
a third of the rows share is one row of it.  The mean with its error and the
extremes need no order at all and use plain aggregates.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavepanel.operators.segments import join_keys, running
from wavepanel.session import stage

# The percentiles of a detailed summary.
SUMMARY_PERCENTILES = [1, 5, 10, 25, 50, 75, 90, 95, 99]


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def _pname(p: float) -> str:
    s = f"{p * 100:g}".replace(".", "_")
    return f"p{s}"


def _present(c: Column, kind: str) -> Column:
    """Neither NULL nor NaN."""
    return c.isNotNull() & ~F.isnan(c) if kind in ("double", "float") else c.isNotNull()


def value_table(df: DataFrame, keys: Sequence[str], value: str | Column,
                freq: str | Column | None = None, extra: Sequence[Column] = ()) -> DataFrame:
    """(keys, _v, _n, extra...): the distinct present values of each key with
    their row counts (the sum of ``freq`` if rows stand for several)."""
    v = df.select(*keys, _c(value).alias("_v"), *([_c(freq).alias("_f")] if freq is not None else []),
                  *extra)
    kind = v.schema["_v"].dataType.simpleString()
    names = [c for c in v.columns if c not in (*keys, "_v", "_f")]
    n = F.sum("_f") if freq is not None else F.count(F.lit(1))
    table = (v.where(_present(F.col("_v"), kind)).groupBy(*keys, "_v")
             .agg(n.cast("long").alias("_n"), *[F.sum(c).alias(c) for c in names]))
    return stage(table, "value-table")


def exact_quantiles(df: DataFrame, keys: Sequence[str], value: str | Column,
                    probs: Sequence[float], names: Sequence[str] | None = None,
                    tiebreak: str | Column | None = None, limit: int | None = None,
                    mean_name: str | None = None, freq: str | Column | None = None) -> DataFrame:
    """Linear-interpolation quantiles (as ``percentile`` / ``quantile_cont``)
    of the non-missing ``value`` per ``keys``; one row per key.

    ``freq`` names a count if a row stands for several.  ``mean_name`` also
    returns the mean, from the same table.  ``tiebreak`` is accepted for
    callers that have one; equal values are one row here and need none.
    """
    keys = list(keys)
    names = list(names) if names else [_pname(p) for p in probs]
    aggs = {"_q_c": ("sum", F.col("_n")), "_q_n": ("group_sum", F.col("_n"))}
    if mean_name:
        aggs["_q_s"] = ("group_sum", F.col("_n") * F.col("_v"))
    r = running(value_table(df, keys, value, freq), keys, ["_v"], aggs, limit=limit)
    n, upto = F.col("_q_n"), F.col("_q_c")
    before = upto - F.col("_n")
    out_aggs = [F.max(n).alias("_q_n")]
    if mean_name:
        out_aggs.append(F.max(F.col("_q_s")).alias("_q_s"))
    for i, p in enumerate(probs):
        h = (n - 1) * F.lit(float(p))
        for name, at in ((f"_lo{i}", F.floor(h)), (f"_hi{i}", F.ceil(h))):
            out_aggs.append(F.max(F.when((before <= at) & (at < upto), F.col("_v"))).alias(name))
    g = r.groupBy(*keys).agg(*out_aggs)
    out = []
    for i, (p, nm) in enumerate(zip(probs, names)):
        h = (F.col("_q_n") - 1) * F.lit(float(p))
        lo, hi = F.col(f"_lo{i}"), F.col(f"_hi{i}")
        out.append((lo + (h - F.floor(h)) * (hi - lo)).alias(nm))
    if mean_name:
        out.append((F.col("_q_s") / F.col("_q_n")).alias(mean_name))
    return g.where(F.col("_q_n") > 0).select(*keys, *out)


def _weights(df: DataFrame, weight: str | Column | None) -> tuple[Column, str]:
    """The weight column and the type in which it is summed exactly: whole
    numbers as long, others as decimals with nine places."""
    if weight is None:
        return F.lit(1).cast("long"), "long"
    kind = df.select(_c(weight).alias("w")).schema["w"].dataType.simpleString()
    whole = kind in ("tinyint", "smallint", "int", "bigint")
    return _c(weight), "long" if whole else "decimal(20,9)"


def _summary(df: DataFrame, keys: Sequence[str], value: str, weight: str | Column | None,
             percents: Sequence[int], extremes: int, limit: int | None) -> DataFrame:
    """Moments, percentiles and extremes per key, from one value table."""
    keys = list(keys)
    w, kind = _weights(df, weight)
    ok = w.isNotNull() & (w > 0)
    src = df.where(ok & ~F.isnan(w.cast("double")))
    vt = value_table(src, keys, value, extra=[w.cast(kind).alias("_w"),
                                              w.cast("double").alias("_d")])
    x, xd, n = F.col("_v"), F.col("_v").cast("double"), F.col("_n")
    # room for the factor of 100 that turns shares into exact comparisons
    sums = "long" if kind == "long" else "decimal(30,9)"
    r = running(vt, keys, ["_v"], {
        "_cw": ("sum", F.col("_w")), "_tw": ("group_sum", F.col("_w")),
        "_cn": ("sum", n), "_tn": ("group_sum", n),
        "_td": ("group_sum", F.col("_d")), "_ts": ("group_sum", F.col("_d") * xd)}, limit=limit)
    r = r.withColumns({"_cw": F.col("_cw").cast(sums), "_tw": F.col("_tw").cast(sums),
                       "_bw": (F.col("_cw") - F.col("_w")).cast(sums),
                       "_off": xd - F.try_divide("_ts", "_td")})
    hundred = F.lit(100) if kind == "long" else F.lit(100).cast("decimal(3,0)")
    cw, tw, before = F.col("_cw") * hundred, F.col("_tw"), F.col("_bw") * hundred
    last, first, tn = F.col("_cn"), F.col("_cn") - n, F.col("_tn")
    aggs = [F.sum("_d").alias("_W"), F.max(F.try_divide("_ts", "_td")).alias("_mean")]
    # central moments around the group's own mean: no cancellation
    aggs += [F.sum(F.col("_d") * F.pow("_off", F.lit(k))).alias(f"_c{k}") for k in (2, 3, 4)]
    for p in percents:
        target = tw * (F.lit(int(p)) if kind == "long" else F.lit(int(p)).cast("decimal(3,0)"))
        at_a = (before <= target) & (target < cw)
        at_b = cw == target
        aggs.append(F.max(F.when(at_a, x)).alias(f"_a{p}"))
        aggs.append(F.max(F.when(at_a, before == target)).alias(f"_e{p}"))
        aggs.append(F.max(F.when(at_b, x)).alias(f"_b{p}"))
    for i in range(extremes):
        aggs.append(F.max(F.when((first <= i) & (last > i), x)).alias(f"smallest{i + 1}"))
        at = tn - 1 - i
        aggs.append(F.max(F.when((first <= at) & (last > at), x)).alias(f"largest{i + 1}"))
    return r.groupBy(*keys).agg(*aggs).where(F.col("_W").isNotNull())


def _percentile_columns(percents: Sequence[int], extremes: int) -> list[Column]:
    cols = []
    for p in percents:
        a, b, e = F.col(f"_a{p}"), F.col(f"_b{p}"), F.col(f"_e{p}")
        cols.append(F.when(e, (a + b) / 2).otherwise(a).alias(f"p{p}"))
    return (cols + [F.col(f"smallest{i + 1}") for i in range(extremes)]
            + [F.col(f"largest{i + 1}") for i in range(extremes)])


def _moment_columns() -> list[Column]:
    W, c2 = F.col("_W"), F.col("_c2")
    m2, m3, m4 = c2 / W, F.col("_c3") / W, F.col("_c4") / W
    # a group without spread, or with a total weight of one, has no such moments
    var = F.when(W > 1, F.try_divide(c2, W - 1))
    return [W.alias("n"), F.col("_mean").alias("mean"), var.alias("variance"),
            F.sqrt(var).alias("sd"), F.try_divide(m3, F.pow(m2, F.lit(1.5))).alias("skewness"),
            F.try_divide(m4, m2 * m2).alias("kurtosis")]


def weighted_percentiles(df: DataFrame, keys: Sequence[str], value: str,
                         weight: str | Column | None, tiebreak: str | Column | None = None,
                         percents: Sequence[int] = SUMMARY_PERCENTILES,
                         extremes: int = 4, limit: int | None = None) -> DataFrame:
    """Frequency-weighted percentiles with the "average at an exact cut"
    rule of a detailed summary, plus the ``extremes`` smallest and largest
    observations.

    With ``W`` the total weight and ``P = W * p / 100``: the percentile is
    the first value whose cumulative weight exceeds ``P``; when the weight
    up to the previous value equals ``P`` exactly, the two are averaged.
    Rows with a missing or non-positive weight, or a missing value, are
    ignored.  Whole weights are summed as 64-bit integers, fractional ones as
    decimals with nine places, so the equality test is exact.  Without
    ``percents`` only the extremes are asked for, and nothing else is sorted.
    """
    if not percents:
        return extreme_values(df, keys, value, weight, extremes)
    g = _summary(df, keys, value, weight, percents, extremes, limit)
    return g.select(*keys, *_percentile_columns(percents, extremes))


def weighted_moments(df: DataFrame, keys: Sequence[str], value: str,
                     weight: str | Column | None) -> DataFrame:
    """Per key: ``n`` (sum of weights), ``mean``, ``variance`` (divisor n-1),
    ``sd``, ``skewness`` and ``kurtosis`` (moment ratios m3/m2^1.5, m4/m2^2;
    kurtosis of a normal = 3).  A moment that a group has not (no spread, a
    total weight of one) is NULL."""
    return _summary(df, keys, value, weight, [], 0, None).select(*keys, *_moment_columns())


def weighted_summary(df: DataFrame, keys: Sequence[str], value: str,
                     weight: str | Column | None, tiebreak: str | Column | None = None,
                     percents: Sequence[int] = SUMMARY_PERCENTILES, limit: int | None = None
                     ) -> DataFrame:
    """Detailed summary per key (``keys=[]``: of all rows): moments,
    percentiles, 4 smallest/largest."""
    g = _summary(df, keys, value, weight, percents, 4, limit)
    return g.select(*keys, *_moment_columns(), *_percentile_columns(percents, 4))


def weighted_mean_se(df: DataFrame, keys: Sequence[str], value: str, weight: str | Column,
                     where: Column | None = None) -> DataFrame:
    """Probability-weighted mean with its linearised standard error:
    ``se = sqrt(n/(n-1) * sum(((w/W) * (x - mean))^2))``; ``where`` restricts
    the estimation sample.  A single row has no error (NULL), zero total
    weight no mean."""
    keys = list(keys)
    kind = df.select(_c(value).alias("v")).schema["v"].dataType.simpleString()
    src = (df if where is None else df.where(where)).select(
        *keys, _c(value).alias("_v"), _c(weight).cast("double").alias("_w"))
    src = src.where(_present(F.col("_v"), kind) & _present(F.col("_w"), "double"))
    x = F.col("_v").cast("double")
    means = stage(src.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("n"), F.sum("_w").alias("_W"),
        F.try_divide(F.sum(F.col("_w") * x), F.sum("_w")).alias("mean")), "means")
    off = x - F.col("_m")
    spread = (join_keys(src, means.select(*keys, F.col("mean").alias("_m")), keys, "inner",
                        means.count())
              .groupBy(*keys).agg(F.sum(F.col("_w") * F.col("_w") * off * off).alias("_ss")))
    se = F.sqrt(F.try_divide(F.col("n") * 1.0, F.col("n") - 1)
                * F.try_divide("_ss", F.col("_W") * F.col("_W")))
    return (join_keys(means.where("n > 0"), spread, keys, "left", means.count())
            .select(*keys, "n", "mean", se.alias("se")))


# Parts of a key's values whose least and greatest bound its extremes.
EXTREME_PARTS = 64


def extreme_values(df: DataFrame, keys: Sequence[str], value: str | Column,
             weight: str | Column | None = None, k: int = 4) -> DataFrame:
    """The ``k`` smallest and largest observations per key: smallest1, ... and
    largest1, ...; NULL where a key has fewer.  Rows with a missing value, or
    with a missing or non-positive ``weight``, are ignored; every other row is
    one observation.

    Nothing is sorted but what can be an extreme.  An aggregate takes the least
    and greatest value of each of EXTREME_PARTS parts of a key's values; the
    k-th least of the former is a value with k values up to it, so only rows up
    to there can be among the smallest, and likewise for the largest.  Those
    rows are counted by value, and the places read off the counts.
    """
    keys = list(keys)
    src = df.select(*keys, _c(value).alias("_v"),
                    *([] if weight is None else [_c(weight).cast("double").alias("_w")]))
    kind = src.schema["_v"].dataType.simpleString()
    src = src.where(_present(F.col("_v"), kind))
    if weight is not None:
        src = src.where((F.col("_w") > 0) & ~F.isnan("_w"))
    src = src.select(*keys, "_v")
    part = F.pmod(F.xxhash64("_v"), F.lit(max(EXTREME_PARTS, 4 * k))).alias("_part")
    ends = (src.groupBy(*keys, part).agg(F.min("_v").alias("_lo"), F.max("_v").alias("_hi"))
            .groupBy(*keys).agg(F.array_sort(F.collect_list("_lo")).alias("_los"),
                                F.sort_array(F.collect_list("_hi"), False).alias("_his")))
    bounds = stage(ends.select(*keys, F.get("_los", F.lit(k - 1)).alias("_up"),
                               F.get("_his", F.lit(k - 1)).alias("_down")), "extreme-bounds")
    # a key whose values fill fewer than k parts has few values, and all stay
    v, up, down = F.col("_v"), F.col("_up"), F.col("_down")
    near = v.isNotNull() & (up.isNull() | down.isNull() | (v <= up) | (v >= down))
    counts = (join_keys(src, bounds, keys, "inner", bounds.count()).where(near)
              .groupBy(*keys, "_v", "_up", "_down").agg(F.count(F.lit(1)).alias("_n")))
    out = counts.groupBy(*keys).agg(F.array_sort(F.collect_list(F.struct("_v", "_n"))).alias("_s"))

    def places(values: Column) -> Column:
        """Each value as often as it occurs, k times at most."""
        return F.flatten(F.transform(values, lambda s: F.array_repeat(
            s["_v"], F.least(s["_n"], F.lit(k)).cast("int"))))

    # the values between the bounds are missing in the middle, not at the ends
    return out.select(*keys, places(F.slice("_s", 1, k)).alias("_a"),
                      places(F.slice(F.reverse("_s"), 1, k)).alias("_b")).select(
        *keys, *[F.get("_a", F.lit(i)).alias(f"smallest{i + 1}") for i in range(k)],
        *[F.get("_b", F.lit(i)).alias(f"largest{i + 1}") for i in range(k)])


def weighted_tabulate(df: DataFrame, var: str, weight: str | Column | None = None,
                      where: Column | None = None) -> DataFrame:
    """Frequency table: ``var, freq, percent, cum_percent`` (ordered by var).

    The aggregate is one row per level, so the percent windows run on a
    table whose size is the number of levels."""
    w = F.lit(1) if weight is None else _c(weight)
    src = df if where is None else df.where(where)
    g = stage(src.groupBy(var).agg(F.sum(w).alias("freq")), "levels")
    # running total over the levels: skew-safe even for many levels
    r = running(g, [], [var], {"_cum": ("sum", F.col("freq")), "_tot": ("group_sum", F.col("freq"))})
    return r.select(var, "freq", F.try_divide(F.col("freq") * 100.0, "_tot").alias("percent"),
                    F.try_divide(F.col("_cum") * 100.0, "_tot").alias("cum_percent")).orderBy(var)


def distinct_levels(df: DataFrame, col: str | Column, where: Column | None = None,
                    name: str = "level") -> DataFrame:
    src = df if where is None else df.where(where)
    return src.select(_c(col).alias(name)).distinct().orderBy(name)
