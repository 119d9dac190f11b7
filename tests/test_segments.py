"""The segmented (hot-key) path must equal the plain window exactly."""

import pandas as pd
from pyspark.sql import Window
from pyspark.sql import functions as F

from wavepanel.operators.diagnostics import median_timestamp
from wavepanel.operators.panel import carry_forward
from wavepanel.operators.ranks import rank_crosswalk, weighted_ecdf
from wavepanel.operators.segments import running
from wavepanel.operators.stats import exact_quantiles

SMOKE = "/root/testdata/sf0.001"


def skewed(spark):
    """Person 0 holds most rows, with many ties in the order column."""
    rows = []
    for i in range(400):
        u = 0 if i % 4 else (i // 4) % 9 + 1
        rows.append((u, i % 13, i, float(i % 7) if i % 5 else None, (i * 37) % 11))
    return spark.createDataFrame(rows, "u int, t int, k int, x double, w int")


def plain(df):
    w = Window.partitionBy("u").orderBy("t", "k").rowsBetween(Window.unboundedPreceding, 0)
    return df.select("k", F.sum("w").over(w).alias("s"),
                     F.last("x", ignorenulls=True).over(w).alias("l"),
                     F.sum("w").over(Window.partitionBy("u")).alias("g"))


def test_running_hot_equals_plain(spark, low_limit):
    df = skewed(spark)
    got = running(df, ["u"], ["t", "k"], {"s": ("sum", F.col("w")), "l": ("last", F.col("x")),
                                         "g": ("group_sum", F.col("w"))})
    a = got.select("k", "s", "l", "g").toPandas().sort_values("k").reset_index(drop=True)
    b = plain(df).toPandas().sort_values("k").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_running_range_hot_equals_plain(spark, low_limit):
    df = skewed(spark)
    got = running(df, ["u"], ["t"], {"s": ("sum", F.col("w"))}, frame="range")
    w = Window.partitionBy("u").orderBy("t").rangeBetween(Window.unboundedPreceding, 0)
    exp = df.select("k", F.sum("w").over(w).alias("s"))
    a = got.select("k", "s").toPandas().sort_values("k").reset_index(drop=True)
    b = exp.toPandas().sort_values("k").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def _ecdf_rows(spark, ties):
    o = (spark.read.parquet(f"{SMOKE}/orders.parquet")
         .select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("y"),
                 (F.col("o_orderkey") % 5 + 1).alias("w")))
    r = weighted_ecdf(o, "o_totalprice", "w", ["y"], "o_orderkey", ties=ties)
    return r.select("o_orderkey", "rank").toPandas().sort_values("o_orderkey").reset_index(drop=True)


def test_ecdf_hot_path_is_exact(spark):
    from wavepanel.session import ROWS_PER_SEGMENT_KEY
    for ties in ("rows", "equal"):
        base = _ecdf_rows(spark, ties)
        spark.conf.set(ROWS_PER_SEGMENT_KEY, "20")
        try:
            hot = _ecdf_rows(spark, ties)
        finally:
            spark.conf.unset(ROWS_PER_SEGMENT_KEY)
        pd.testing.assert_frame_equal(base, hot)


def test_ecdf_ties_fixture(spark):
    df = spark.createDataFrame([(1, 10.0, 1), (2, 10.0, 2), (3, 20.0, 3)], "k int, x double, w int")
    rows = weighted_ecdf(df, "x", "w", [], "k").orderBy("k").collect()
    assert [r["rank"] for r in rows] == [1 / 6, 3 / 6, 6 / 6]
    eq = weighted_ecdf(df, "x", "w", [], "k", ties="equal").orderBy("k").collect()
    assert [r["rank"] for r in eq] == [3 / 6, 3 / 6, 6 / 6]


def test_crosswalk_hot_path_matches_brute_force(spark, low_limit):
    o = (spark.read.parquet(f"{SMOKE}/orders.parquet")
         .select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"),
                 (F.col("o_orderkey") % 5 + 1).alias("w")))
    edges = [0, 100000, 200000, 300000, 1e20]
    got = rank_crosswalk(o, "o_totalprice", "w", ["year"], "o_orderkey", edges=edges).toPandas()
    pdf = o.toPandas().sort_values(["year", "o_totalprice", "o_orderkey"])
    pdf["rank"] = pdf.groupby("year")["w"].cumsum() / pdf.groupby("year")["w"].transform("sum")
    pdf["lbound"] = pd.cut(pdf["o_totalprice"].clip(lower=0), edges, right=False,
                           labels=edges[:-1]).astype(float)
    exp = pdf.groupby(["year", "lbound"], as_index=False)["rank"].median()
    exp["ibin"] = exp.groupby("year").cumcount() + 1
    a = got.sort_values(["year", "lbound"]).reset_index(drop=True)
    b = exp.sort_values(["year", "lbound"]).reset_index(drop=True)
    assert list(a["ibin"]) == list(b["ibin"])
    assert (a["rank"] - b["rank"]).abs().max() < 1e-12


def test_exact_quantiles_hot_matches_pandas(spark, low_limit):
    df = skewed(spark).where(F.col("x").isNotNull())
    got = exact_quantiles(df, ["u"], "x", [0.25, 0.5, 0.75]).toPandas().set_index("u").sort_index()
    pdf = df.toPandas()
    exp = pdf.groupby("u")["x"].quantile([0.25, 0.5, 0.75]).unstack()
    for p, c in zip([0.25, 0.5, 0.75], ["p25", "p50", "p75"]):
        assert (got[c] - exp[p]).abs().max() < 1e-12


def test_carry_forward_hot_matches_plain(spark, low_limit):
    df = skewed(spark).withColumn("y", F.when(F.col("k") % 3 == 0, F.col("x")))
    got = carry_forward(df, ["x", "y"], "u", ["t", "k"]).select("k", "x", "y")
    complete = F.when(F.col("x").isNotNull() & F.col("y").isNotNull(), F.struct("x", "y"))
    w = Window.partitionBy("u").orderBy("t", "k").rowsBetween(Window.unboundedPreceding, 0)
    exp = df.select("k", F.last(complete, ignorenulls=True).over(w).alias("r")).select("k", "r.x", "r.y")
    a = got.toPandas().sort_values("k").reset_index(drop=True)
    b = exp.toPandas().sort_values("k").reset_index(drop=True)
    pd.testing.assert_frame_equal(a, b, check_dtype=False)


def test_median_timestamp(spark):
    import datetime as dt
    df = spark.createDataFrame([(1, dt.datetime(2024, 1, 1, 0, 0, 0)), (1, dt.datetime(2024, 1, 1, 0, 0, 1))],
                               "g int, ts timestamp_ntz")
    r = median_timestamp(df, "g", "ts").first()
    assert r["median_ts"] == dt.datetime(2024, 1, 1, 0, 0, 0, 500000)


def test_tabulate_many_levels_hot_path(spark, low_limit):
    from wavepanel.operators.stats import weighted_tabulate
    df = skewed(spark)
    got = weighted_tabulate(df, "k", "w").toPandas().set_index("k").sort_index()
    pdf = df.toPandas().groupby("k")["w"].sum().sort_index()
    tot = pdf.sum()
    assert list(got["freq"]) == list(pdf)
    assert (got["cum_percent"] - pdf.cumsum() * 100.0 / tot).abs().max() < 1e-9


def test_hot_key_is_split_into_bounded_segments(spark):
    """One person with a third of the rows (and many ties): no window
    partition (key, segment) may exceed a small multiple of the limit."""
    from wavepanel.operators.segments import SEG, assign_segments
    rows = [(0 if i % 3 == 0 else i % 50 + 1, i % 17, i) for i in range(3000)]
    nulls = [(None if i % 3 == 0 else i % 50 + 1, None if i % 2 else i % 17, i) for i in range(3000)]
    for data in (rows, nulls):
        df = spark.createDataFrame(data, "u int, t int, k int")
        cold, seg = assign_segments(df, ["u"], ["t", "k"], limit=100)
        sizes = seg.groupBy("u", SEG).count()
        assert sizes.agg(F.max("count")).first()[0] <= 100
        assert sizes.count() >= 10 and cold.count() + seg.count() == 3000
        assert cold.groupBy("u").count().agg(F.max("count")).first()[0] <= 100


def test_hot_path_with_texts_nulls_and_null_keys(spark):
    rows = [(None if i % 3 == 0 else i % 5, None if i % 2 else f"t{i % 40:02}", i, i % 11)
            for i in range(900)]
    df = spark.createDataFrame(rows, "u int, t string, k int, w int")
    for frame, order in (("rows", ["t", "k"]), ("range", ["t"])):
        runs = [{tuple(r) for r in running(df, ["u"], order, {
            "s": ("sum", F.col("w")), "g": ("group_sum", F.col("w"))}, frame, limit=limit)
            .select("u", "t", "k", "s", "g").collect()} for limit in (10_000, 40)]
        assert runs[0] == runs[1] and len(runs[0]) == 900


def test_crosswalk_without_broadcast_matches(spark, low_limit):
    """The salted (non-broadcast) cell join gives the same crosswalk."""
    from wavepanel.session import MAX_BROADCAST_ROWS_KEY
    o = (spark.read.parquet(f"{SMOKE}/orders.parquet")
         .select("o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"),
                 (F.col("o_orderkey") % 5 + 1).alias("w")))
    edges = [0, 100000, 200000, 300000, 1e20]
    a = rank_crosswalk(o, "o_totalprice", "w", ["year"], "o_orderkey", edges=edges).toPandas()
    spark.conf.set(MAX_BROADCAST_ROWS_KEY, "1")
    try:
        b = rank_crosswalk(o, "o_totalprice", "w", ["year"], "o_orderkey", edges=edges).toPandas()
    finally:
        spark.conf.unset(MAX_BROADCAST_ROWS_KEY)
    key = ["year", "lbound"]
    pd.testing.assert_frame_equal(a.sort_values(key).reset_index(drop=True),
                                  b.sort_values(key).reset_index(drop=True))
