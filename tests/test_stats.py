"""Weighted statistics, histogram, outliers and the rank lookup."""

import math
import tempfile

import pytest
from pyspark.sql import functions as F

from wavepanel.operators.diagnostics import nobs_histogram, outlier_flags, to_long
from wavepanel.operators.ranks import attach_rank, rank_crosswalk, small_cell_filter
from wavepanel.operators.stats import (weighted_mean_se, weighted_percentiles, weighted_summary,
                                       weighted_tabulate)


def brute_percentile(xs, ws, p):
    """Weighted percentile by the 'average at an exact cut' rule, by expansion."""
    pairs = sorted(zip(xs, ws))
    W = sum(ws)
    P = W * p / 100
    cum = 0
    for i, (x, w) in enumerate(pairs):
        if cum + w > P:
            if cum == P and i > 0:
                return (pairs[i - 1][0] + x) / 2
            return x
        cum += w
    return pairs[-1][0]


@pytest.mark.parametrize("weighted", [False, True])
def test_weighted_percentiles_against_brute_force(spark, weighted):
    xs = [3.0, 1.0, 4.0, 1.0, 5.0, 9.0, 2.0, 6.0, 5.0, 3.0, 5.0, 8.0]
    ws = [2, 1, 3, 1, 1, 4, 2, 1, 1, 2, 3, 1] if weighted else [1] * len(xs)
    df = spark.createDataFrame([(0, i, x, w) for i, (x, w) in enumerate(zip(xs, ws))],
                               "g int, k int, x double, w int")
    r = weighted_percentiles(df, ["g"], "x", "w" if weighted else None, "k").first()
    for p in (1, 5, 10, 25, 50, 75, 90, 95, 99):
        assert r[f"p{p}"] == brute_percentile(xs, ws, p), p
    assert [r[f"smallest{i}"] for i in range(1, 5)] == sorted(xs)[:4]
    assert [r[f"largest{i}"] for i in range(1, 5)] == sorted(xs, reverse=True)[:4]


def test_median_of_three_and_one(spark):
    df = spark.createDataFrame([(0, 0, 1.0, 3), (0, 1, 3.0, 1)], "g int, k int, x double, w int")
    assert weighted_percentiles(df, ["g"], "x", "w", "k").first()["p50"] == 1.0


def test_weighted_mean_se(spark):
    xs, ws = [1.0, 0.0, 1.0, 1.0], [2.0, 1.0, 1.0, 4.0]
    df = spark.createDataFrame([(0, x, w) for x, w in zip(xs, ws)], "g int, x double, w double")
    r = weighted_mean_se(df, ["g"], "x", "w").first()
    W = sum(ws)
    m = sum(w * x for x, w in zip(xs, ws)) / W
    se = math.sqrt(len(xs) / (len(xs) - 1) * sum((w / W) ** 2 * (x - m) ** 2 for x, w in zip(xs, ws)))
    assert abs(r["mean"] - m) < 1e-12 and abs(r["se"] - se) < 1e-12


def test_tabulate(spark):
    df = spark.createDataFrame([("a", 1), ("b", 3), ("a", 4)], "v string, w int")
    rows = [tuple(r) for r in weighted_tabulate(df, "v", "w").collect()]
    assert rows == [("a", 5, 62.5, 62.5), ("b", 3, 37.5, 100.0)]


def test_histogram_last_bin_closed(spark):
    # rows per person 1,2,3,3,2 -> nmax = 3, bins [0,1) [1,2) [2,3]
    rows = [(u, 1.0) for u, n in enumerate([1, 2, 3, 3, 2]) for _ in range(n)]
    df = spark.createDataFrame(rows, "u int, x double")
    out = {r["bin"]: r["n_persons"] for r in nobs_histogram(df, "u", ["x"]).collect()}
    assert out == {1: 1, 2: 4}


def test_iqr_floor(spark):
    # seven equal values: IQR 0 is floored to 1, so the band ends at 5 + 100
    rows = [(1, k, 5.0) for k in range(7)] + [(1, 7, 106.0)]
    df = spark.createDataFrame(rows, "wid int, k int, x double")
    long = to_long(df, ["wid"], ["x"])
    flags = {r["val"]: r["outlier"] for r in outlier_flags(long, "wid").collect()}
    assert flags[106.0] is True and flags[5.0] is False


def _cw(spark, rows):
    return spark.createDataFrame(rows, "year int, ibin int, lbound double, rank double")


def test_lookup_miss_rescale_and_duplicates(spark):
    cw = _cw(spark, [(2020, 1, 0.0, 0.25), (2020, 2, 1e4, 0.97)])
    df = spark.createDataFrame([(1, 2020, 2), (2, 2019, 1)], "id int, year int, b int")
    out = {r["id"]: r["b_rank"] for r in attach_rank(df, cw, "b").collect()}
    assert out == {1: 97.0, 2: None}
    cw97 = _cw(spark, [(2020, 2, 1e4, 97.0)])
    assert attach_rank(df, cw97, "b").where("id = 1").first()["b_rank"] == 97.0
    dup = _cw(spark, [(2020, 1, 0.0, 0.2), (2020, 1, 0.0, 0.3)])
    with pytest.raises(ValueError):
        attach_rank(df, dup, "b")


def test_small_cell_filter(spark):
    cw = spark.createDataFrame([(1, 1, 600), (1, 2, 500), (2, 1, 900)], "year int, ibin int, nobs long")
    assert sorted(r["year"] for r in small_cell_filter(cw, ["year"], "nobs", 1000).collect()) == [1, 1]


def test_ecdf_and_crosswalk_with_missing_income(spark):
    from wavepanel.operators.ranks import rank_crosswalk, weighted_ecdf
    rows = [(1, 2020, 5.0, 1), (2, 2020, None, 3), (3, 2020, 15.0, 2), (4, 2020, 999.0, 1),
            (5, 2020, -3.0, 2), (6, 2020, 25.0, None), (7, 2020, 12.0, 1)]
    df = spark.createDataFrame(rows, "k int, year int, x double, w int")
    r = {row["k"]: row["rank"] for row in weighted_ecdf(df, "x", "w", ["year"], "k").collect()}
    # valid rows (x and w present): -3(2) 5(1) 12(1) 15(2) 999(1) -> total 7
    assert r[2] is None and r[6] is None
    assert r[5] == 2 / 7 and r[1] == 3 / 7 and r[7] == 4 / 7 and r[3] == 6 / 7 and r[4] == 1.0
    # 999 is a special code -> missing; bins [0,10) [10,20) [20, inf)
    cw = rank_crosswalk(df, "x", "w", ["year"], "k", edges=[0, 10, 20, 1e20],
                        missing_codes=(999.0, 999.0), count_col="nobs")
    got = {row["lbound"]: (row["ibin"], row["rank"], row["nobs"]) for row in cw.collect()}
    # ranks without 999: -3(2) 5(1) 12(1) 15(2) -> total 6: 2/6, 3/6, 4/6, 6/6
    # bin 0 holds -3 and 5 (clamped) plus the missing incomes (rank NULL, not counted)
    assert got[0.0] == (1, (2 / 6 + 3 / 6) / 2, 2)
    assert got[10.0] == (2, (4 / 6 + 6 / 6) / 2, 2)
    # x = 25 with a missing weight has a bin but no rank: a cell with NULL median, 0 obs
    assert got[20.0] == (3, None, 0)


def test_wave_stats_approx_close_to_exact(spark):
    from wavepanel.operators.diagnostics import to_long, wave_stats
    rows = [(w, k, float((k * 37) % 101)) for w in (1, 2) for k in range(500)]
    long = to_long(spark.createDataFrame(rows, "wid int, k int, x double"), ["wid"], ["x"])
    ex = {r["wid"]: r for r in wave_stats(long, "wid").collect()}
    ap = {r["wid"]: r for r in wave_stats(long, "wid", method="approx").collect()}
    for w in (1, 2):
        assert abs(ex[w]["p50"] - ap[w]["p50"]) <= 1.0 and ex[w]["mean"] == ap[w]["mean"]


def test_summary_without_keys_and_of_odd_groups(spark):
    rows = [("const", 5.0, 2), ("const", 5.0, 1), ("one", 3.0, 1), ("zero", 1.0, 0), ("nan", float("nan"), 1)]
    df = spark.createDataFrame(rows, "g string, x double, w int")
    by = {r.g: r for r in weighted_summary(df, ["g"], "x", "w").collect()}
    assert set(by) == {"const", "one"}
    assert by["const"].sd == 0 and by["const"].skewness is None and by["const"].p50 == 5.0
    assert by["one"].variance is None and by["one"].smallest2 is None
    whole = weighted_summary(df.where("g != 'nan'"), [], "x", "w").collect()
    assert len(whole) == 1 and whole[0].n == 4.0 and whole[0].smallest1 == 3.0
    se = {r.g: r.se for r in weighted_mean_se(df, ["g"], "x", "w").collect()}
    assert se["one"] is None and se["const"] == 0


def test_moments_do_not_cancel(spark):
    df = spark.createDataFrame([(1e8 + i,) for i in range(3)], "x double")
    r = weighted_summary(df, [], "x", None).first()
    assert r.variance == 1.0 and abs(r.skewness) < 1e-12


def test_fractional_weights_keep_every_row(spark):
    df = spark.createDataFrame([(float(i), 0.5 if i % 2 == 0 else 1.9) for i in range(10)],
                               "x double, w double")
    r = weighted_summary(df, [], "x", "w").first()
    assert r.n == 12.0 and r.smallest1 == 0.0 and r.largest2 == 8.0
    assert r.p50 == brute_percentile(list(map(float, range(10))), [5, 19] * 5, 50)


def test_equal_ranks_share_the_median(spark):
    df = spark.createDataFrame([(1, 10.0), (2, 10.0), (3, 20.0)], "k int, x double").withColumn(
        "g", F.lit(1))
    r = rank_crosswalk(df, "x", None, ["g"], "k", edges=[0, 100], ties="equal", count_col="n").first()
    assert abs(r["rank"] - 2 / 3) < 1e-12 and r["n"] == 3


def brute_crosswalk(rows, edges, clamp=0.0):
    """rows (group, key, income, weight) -> {(group, lbound): (count, median rank)}."""
    out = {}
    for g in {r[0] for r in rows}:
        mine = sorted((x, k, w) for h, k, x, w in rows if h == g and x is not None and w is not None)
        total, upto, cells = sum(w for *_, w in mine), 0, {}
        for h, k, x, w in rows:
            low = max(clamp, x) if x is not None else clamp
            for a, b in zip(edges[:-1], edges[1:]):
                if h == g and a <= low < b:
                    cells.setdefault(float(a), [])
        for x, k, w in mine:
            upto += w
            for a, b in zip(edges[:-1], edges[1:]):
                if a <= max(clamp, x) < b:
                    cells[float(a)].append(upto / total)
        for a, ranks in cells.items():
            n = len(ranks)
            out[g, a] = (n, (ranks[(n - 1) // 2] + ranks[n // 2]) / 2 if n else None)
    return out


@pytest.mark.parametrize("seed,accuracy,ties", [(1, 1000, False), (2, 20, False), (3, 20, True)])
def test_median_ranks_by_selection(spark, monkeypatch, seed, accuracy, ties):
    import random
    from wavepanel.operators import ranks
    monkeypatch.setattr(ranks, "SKETCH_ACCURACY", accuracy)      # 20: cells are bracketed
    rng = random.Random(seed)
    rows = [(rng.choice([2013, 2014, None]), k,
             rng.choice([None, -5.0, 10.0, 25.0, 1e21]) if rng.random() < (0.6 if ties else 0.1)
             else round(rng.uniform(-10, 60), 3), rng.choice([None, 1, 2, 5])) for k in range(3000)]
    df = spark.createDataFrame(rows, "g int, k int, x double, w int")
    edges = [0, 10, 20, 30, 1e20]
    got = {(r.g, r.lbound): (r.n, r["rank"]) for r in
           ranks.rank_crosswalk(df, "x", "w", ["g"], "k", edges=edges, count_col="n").collect()}
    want = brute_crosswalk(rows, edges)
    assert set(got) == set(want)
    for c, (n, rank) in want.items():
        assert got[c][0] == n and abs(got[c][1] - rank) < 1e-12, c


def test_only_rows_around_the_medians_are_ordered(spark, low_limit):
    from wavepanel.operators import ranks
    df = spark.range(40_000).select((F.col("id") % 2).alias("g"), F.col("id").alias("_wp_t"),
                                    ((F.col("id") * 7919) % 30_011).cast("double").alias("_wp_x"),
                                    F.lit(1).alias("_wp_wt"))
    cells, values = ranks.median_values(df, ["g"], [0, 10_000, 20_000, 1e20], 0.0)
    assert cells.count() == 6
    assert values.count() < 0.05 * 40_000 and values.agg(F.sum("_n")).first()[0] > 0.4 * 40_000
    out = ranks.rank_crosswalk(df.withColumnRenamed("_wp_t", "k"), "_wp_x", None, ["g"], "k",
                               edges=[0, 10_000, 20_000, 1e20])
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Range (" not in plan                 # only staged cells and values are left


def test_crosswalk_without_groups_or_rows(spark):
    from wavepanel.operators.ranks import rank_crosswalk
    df = spark.createDataFrame([(k, float(k)) for k in range(1, 6)], "k int, x double")
    r = rank_crosswalk(df, "x", None, [], "k", edges=[0, 4, 9], count_col="n").collect()
    assert [(x.ibin, x.lbound, x["rank"], x.n) for x in r] == [(1, 0.0, 0.4, 3), (2, 4.0, 0.9, 2)]
    assert rank_crosswalk(df.where("k > 9"), "x", None, [], "k", edges=[0, 4]).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_mean_and_error_need_no_window(spark):
    rows = [(g, float(x), w) for g in (1, 2, None) for x, w in ((1, 2.0), (4, 1.0), (9, 0.5), (2, None))]
    df = spark.createDataFrame(rows + [(3, 5.0, 1.0), (4, 5.0, 0.0)], "g int, x double, w double")
    out = weighted_mean_se(df, ["g"], "x", "w")
    assert "Window" not in _plan(out)
    got = {r.g: (r.n, r["mean"], r.se) for r in out.collect()}
    assert set(got) == {1, 2, 3, 4, None} and got[None] == got[1]
    assert got[3] == (1, 5.0, None) and got[4] == (1, None, None)
    whole = weighted_mean_se(df.where("g = 1"), [], "x", "w").first()
    assert (whole.n, whole["mean"], whole.se) == got[1]
    assert weighted_mean_se(df.where("g > 9"), [], "x", "w").count() == 0


def test_extremes_against_brute_force(spark):
    import random
    from wavepanel.operators.stats import extreme_values
    rng = random.Random(4)
    rows = [(rng.choice([1, 2, None]), rng.choice([7.0, 7.0, rng.uniform(0, 9)]),
             rng.choice([1.0, 2.0, 0.0, None])) for _ in range(3000)]
    rows += [(5, 1.5, 1.0), (5, None, 1.0), (6, 2.0, 1.0), (6, 2.0, 1.0), (6, 3.0, 1.0),
             (7, float("nan"), 1.0)]
    df = spark.createDataFrame(rows, "g int, x double, w double")
    out = extreme_values(df, ["g"], "x", "w", 3)
    assert "Window" not in _plan(out)
    got = {r.g: tuple(r)[1:] for r in out.collect()}
    for g in {r[0] for r in rows} - {7}:
        xs = sorted(x for h, x, w in rows if h == g and x is not None and w)
        want = [*xs[:3], *[None] * (3 - len(xs))], [*xs[::-1][:3], *[None] * (3 - len(xs))]
        assert got[g] == (*want[0], *want[1]), g
    assert 7 not in got
    both = weighted_percentiles(df, ["g"], "x", "w", percents=[], extremes=3)
    assert {r.g: tuple(r)[1:] for r in both.collect()} == got
    assert extreme_values(df, [], "x").count() == 1


def test_only_possible_extremes_are_counted(spark, monkeypatch):
    from wavepanel.operators import stats
    df = spark.range(50_000).select(F.lit(1).alias("g"), ((F.col("id") * 7919) % 49_999).alias("x"))
    seen = []
    join = stats.join_keys
    monkeypatch.setattr(stats, "join_keys", lambda *a: seen.append(join(*a)) or seen[-1])
    r = stats.extreme_values(df, ["g"], "x", k=4).first()
    assert [r[f"smallest{i}"] for i in range(1, 5)] == [0, 0, 1, 2]
    assert [r[f"largest{i}"] for i in range(1, 5)] == [49_998, 49_997, 49_996, 49_995]
    near = seen[0].where("_v <= _up or _v >= _down").count()
    assert near < 60


def test_coverage_reports_from_one_scan(spark):
    from wavepanel.operators.diagnostics import coverage_counts, coverage_reports
    d = tempfile.mkdtemp() + "/t"
    rows = [(1, 1, 5.0, None), (1, 2, None, "a"), (2, 1, 1.0, "b"), (None, 2, 2.0, None),
            (2, None, None, None)]
    spark.createDataFrame(rows, "p int, w int, x double, y string").write.parquet(d)
    df = spark.read.parquet(d)
    assert _plan(coverage_counts(df, "p", "w", ["x", "y"])).count("FileScan") == 1
    r = coverage_reports(df, "p", "w", ["x", "y"])
    assert sorted(map(repr, r.by_person.collect())) == sorted(map(repr, (
        df.groupBy("p").agg(F.count("*").alias("n_rows"), F.count("x").alias("n_x"),
                            F.count("y").alias("n_y"))).collect()))
    assert {(x.w, x.n_rows, x.n_x, x.n_y) for x in r.by_wave.collect()} == {
        (1, 2, 2, 1), (2, 2, 1, 1), (None, 1, 0, 0)}
    assert {tuple(x) for x in r.missing.collect()} == {("x", 3, 2), ("y", 2, 3)}
    none = coverage_reports(df.where("w > 9"), "p", "w", ["x"])
    assert none.by_person.count() == 0 and [tuple(x) for x in none.missing.collect()] == [("x", 0, 0)]


def test_stored_counts_give_the_full_statistics(spark):
    from wavepanel.operators.diagnostics import append_counts, read_counts, wave_stats
    path = tempfile.mkdtemp() + "/counts"
    rows = [(w, f"v{v}", float((w * 7 + v * i) % 5)) for w in (1, 2, 3) for v in (1, 2) for i in range(9)]
    long = spark.createDataFrame(rows, "wave int, variable string, val double")
    old, new = long.where("wave < 3 and val < 4"), long.where("wave = 3 or val >= 4")
    append_counts(old, path, "a", "wave")
    append_counts(old.limit(3), path, "b", "wave")             # a delivery that is corrected
    append_counts(new.where("wave <> 1"), path, "b", "wave")
    assert {r.wave for r in read_counts(spark, path, "wave", changed_by="b").collect()} == {2, 3}
    append_counts(new.where("wave = 1"), path, "c", "wave")

    def stats(df, **kw):
        return sorted(tuple(r) for r in wave_stats(df, "wave", **kw).collect())

    assert stats(read_counts(spark, path, "wave"), freq="n") == stats(long)
    one = read_counts(spark, path, "wave", changed_by="c")
    assert stats(one, freq="n") == [r for r in stats(long) if r[0] == 1]
