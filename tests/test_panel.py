"""Tile, carry-forward and sign verdicts (FIXTURES section 4)."""

import pytest
from pyspark.sql import functions as F

from wavepanel.operators.checks import enforce, implies_missing, missing_report, rule_violations
from wavepanel.operators.panel import carry_forward, spell_lengths, tile, tile_record, tile_violations
from wavepanel.operators.signs import decide, flip_signs, negative_mask, sign_verdicts


def test_tile_spreads_the_single_value(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, None), (2, 1, None)], "u int, w int, x double")
    out = tile(df, ["x"], "u").orderBy("u", "w").collect()
    assert [r["x"] for r in out] == [5.0, 5.0, None]


def test_tile_rejects_two_values_even_if_equal(spark):
    df = spark.createDataFrame([(1, 1, 5.0), (1, 2, 5.0)], "u int, w int, x double")
    with pytest.raises(Exception, match="Multiple non-missing"):
        tile(df, ["x"], "u").collect()
    with pytest.raises(ValueError):
        tile(df, ["x"], "u", check="eager")
    assert [r["x"] for r in tile(df, ["x"], "u", allow_equal=True).collect()] == [5.0, 5.0]
    assert tile_violations(df, "x", "u").count() == 1


def test_tile_record_counts_complete_rows_only(spark):
    df = spark.createDataFrame([(1, 1, 1.0, None), (1, 2, 2.0, 3.0), (2, 1, 4.0, None)],
                               "u int, w int, a double, b double")
    out = {(r["u"], r["w"]): (r["a"], r["b"]) for r in tile_record(df, ["a", "b"], "u").collect()}
    assert out[(1, 1)] == (2.0, 3.0) and out[(2, 1)] == (None, None)


def test_carry_whole_record(spark):
    df = spark.createDataFrame([(2, 1, None, None), (2, 2, 7.0, 8.0), (2, 3, None, 3.0)],
                               "u int, w int, a double, b double")
    out = carry_forward(df, ["a", "b"], "u", ["w"]).orderBy("w").collect()
    assert [(r["a"], r["b"]) for r in out] == [(None, None), (7.0, 8.0), (7.0, 8.0)]


def test_carry_never_crosses_persons(spark):
    df = spark.createDataFrame([(1, 1, 1.0, 5.0), (2, 1, None, 4.0)], "u int, w int, a double, b double")
    out = {r["u"]: (r["a"], r["b"]) for r in carry_forward(df, ["a", "b"], "u", ["w"]).collect()}
    assert out[2] == (None, None)


def test_spell_lengths(spark):
    df = spark.createDataFrame([(1,), (1,), (2,), (3,)], "u int")
    assert [tuple(r) for r in spell_lengths(df, "u").collect()] == [(1, 2), (2, 1)]


def _signs(spark, rows):
    return spark.createDataFrame(rows, "d int, s double")


def _verdict(spark, rows):
    df = _signs(spark, rows)
    return decide(df, {"s": ("s", negative_mask("d", 2))})["s"]


def test_sign_correct_flip_ambiguous(spark):
    assert _verdict(spark, [(2, -2.0), (1, 3.0)]) == "correct"
    assert _verdict(spark, [(2, 2.0), (2, 0.0), (2, None), (1, 3.0)]) == "flip"
    assert _verdict(spark, [(2, 2.0), (2, -1.0), (1, 3.0)]) == "ambiguous"


def test_flip_keeps_zero_and_null(spark):
    df = _signs(spark, [(2, 2.0), (2, 0.0), (2, None), (1, 3.0)])
    out = flip_signs(df, {"s": ("s", negative_mask("d", 2))}).collect()
    vals = [r["s"] for r in out]
    assert vals == [-2.0, 0.0, None, 3.0]
    import math
    assert math.copysign(1.0, vals[1]) == 1.0


def test_missing_direction_counts_as_not_negative(spark):
    df = _signs(spark, [(None, -1.0)])
    v = sign_verdicts(df, {"s": ("s", negative_mask("d", 2))}).first()
    assert v["wrong_pos"] == 1 and v["verdict"] == "ambiguous"


def test_skip_logic_and_enforce(spark):
    df = spark.createDataFrame([(1, None, 4.0), (2, 1, 3.0), (3, 2, None)], "i int, q15 int, q16 double")
    v = rule_violations(df, {"q16": implies_missing("q15", 1, "q16")}, ["i"])
    assert [r["i"] for r in v.collect()] == [1]
    with pytest.raises(ValueError):
        enforce(v, "skip logic")


def test_missing_report(spark):
    df = spark.createDataFrame([(1.0, None), (None, None)], "a double, b double")
    out = {r["variable"]: (r["n_present"], r["n_missing"]) for r in missing_report(df, ["a", "b"]).collect()}
    assert out == {"a": (1, 1), "b": (0, 2)}


def test_tile_with_hot_person_is_salted_and_exact(spark, low_limit):
    rows = [(0 if i % 2 == 0 else i % 9 + 1, i, float(i) if i in (0, 1, 3, 5) else None) for i in range(400)]
    df = spark.createDataFrame(rows, "u int, k int, x double")
    out = tile(df, ["x"], "u")
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "_wp_salt" in plan
    got = {r["k"]: r["x"] for r in out.collect()}
    exp = {0: 0.0, 1: 1.0, 3: 3.0, 5: 5.0}
    for k, u in ((k, 0 if k % 2 == 0 else k % 9 + 1) for k in range(400)):
        want = 0.0 if u == 0 else {2: 1.0, 4: 3.0, 6: 5.0}.get(u)
        assert got[k] == want, (k, u, got[k], want)
    assert out.count() == 400
