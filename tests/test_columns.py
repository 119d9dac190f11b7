"""Scalar operators on hand-written mini tables (FIXTURES section 4)."""

import datetime as dt

from pyspark.sql import functions as F

from wavepanel.functions import columns as C
from wavepanel.functions.labels import label


def one_col(spark, values, dtype="double"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {dtype}")


def result(df, expr):
    return [r[0] for r in df.select(expr.alias("r"), "i").orderBy("i").collect()]


def test_recode_unmapped_and_missing_become_null(spark):
    df = one_col(spark, [1, 2, 9, None], "int")
    assert result(df, C.recode("x", {1: 0, 2: 1})) == [0, 1, None, None]


def test_member_flag_keeps_missing(spark):
    df = one_col(spark, [None, 5, 9], "int")
    assert result(df, C.member_flag("x", (5, 6, 7, 8))) == [None, 1.0, 0.0]


def test_any_flag_treats_missing_as_false(spark):
    df = spark.createDataFrame([(0, None, None), (1, None, 1)], "i int, a int, b int")
    assert result(df, C.any_equals_flag(["a", "b"], 1)) == [0, 1]


def test_score_with_tolerance(spark):
    df = one_col(spark, [200 * 1.1 ** 2, 242.0, 240.0, None])
    assert result(df, C.score_answer("x", 242, tolerance=1e-6)) == [1.0, 1.0, 0.0, None]


def test_row_sum_needs_all_parts(spark):
    df = spark.createDataFrame([(0, 1.0, 0.0, 2.0, 0.0), (1, 1.0, None, 2.0, 0.0)],
                               "i int, a double, b double, c double, d double")
    assert result(df, C.row_sum(["a", "b", "c", "d"])) == [3.0, None]
    assert result(df, C.row_sum(["a", "b", "c", "d"], min_count=3)) == [3.0, 3.0]


def test_pattern_is_an_unanchored_search():
    assert C.columns_matching(["Q10_1", "XQ10_2", "Q100", "Q1"], "Q10_.*") == ["Q10_1", "XQ10_2"]
    assert C.columns_matching(["HH2_1", "DHH2_1", "HH2_x"], r"^HH2_[\d]+$") == ["HH2_1"]


def test_reference_year_rolls_back_dates_on_the_first(spark):
    days = [dt.date(2020, 3, 15), dt.date(2020, 3, 1), dt.date(2020, 1, 1),
            dt.date(2020, 7, 1), dt.date(2020, 7, 2)]
    df = one_col(spark, days, "date")
    assert result(df, C.reference_year("x")) == [2019, 2019, 2020, 2019, 2020]
    assert result(df, C.reference_year("x", anchor="month_start")) == [2019, 2019, 2019, 2020, 2020]


def test_clamp_and_cut(spark):
    edges = [0, 10000, 20000, 30000, 40000, 50000, 60000, 75000, 100000, 150000, 200000, 1e20]
    df = one_col(spark, [-5.0, 0.0, 9999.99, 10000.0, 1e7, 1e20, None])
    assert result(df, C.cut(C.clamp_low("x", 0), edges)) == [0, 0, 0, 10000, 200000, None, 0]
    assert result(df, C.cut("x", edges)) == [None, 0, 0, 10000, 200000, None, None]
    assert result(df, C.cut_index(C.clamp_low("x", 0), edges)) == [1, 1, 1, 2, 11, None, 1]


def test_interval_recode_passes_unmatched_through(spark):
    df = one_col(spark, [0, 9, 10, 11, 12, None], "int")
    assert result(df, C.interval_recode("x", [(0, 9, 0), (10, 11, 1)])) == [0, 0, 1, 1, 12, None]
    assert result(df, C.interval_recode("x", [(9, 10, None)])) == [0, None, None, 11, 12, None]


def test_sentinel_fill_narrows(spark):
    df = one_col(spark, [3.0, None])
    out = df.select(C.sentinel_fill("x").alias("r"))
    assert out.schema["r"].dataType.simpleString() == "tinyint"
    assert [r[0] for r in out.collect()] == [3, -1]


def test_not_equal_is_true_on_missing(spark):
    df = one_col(spark, [None, 1, 2], "int")
    assert result(df, C.not_equal_or_missing("x", 1)) == [True, False, True]


def test_family_merge_and_overwrite(spark):
    df = spark.createDataFrame([(0, None, 1.0, 5.0, 6.0, True)],
                               "i int, HH2_1 double, HH2_2 double, DHH2_1 double, DHH2_2 double, f boolean")
    merged = df.select(*C.family_merge(df)).first()
    assert (merged["HH2_1"], merged["HH2_2"]) == (5.0, 1.0)
    over = df.select(*C.family_overwrite(F.col("f"), ["HH2_1", "HH2_2"], ["DHH2_1", "DHH2_2"])).first()
    assert (over["HH2_1"], over["HH2_2"]) == (5.0, 6.0)


def test_try_cast_and_failures(spark):
    df = one_col(spark, [1, 300, None], "int")
    assert result(df, C.try_cast("x", "tinyint")) == [1, None, None]
    assert df.agg(C.cast_failures("x", "tinyint")).first()[0] == 1


def test_labels(spark):
    df = one_col(spark, [1, 11, 12, None], "int")
    assert result(df, label("x", "income_bin")) == ["Less than $10,000", "$200,000 or more", None, None]
