"""The importer (full + extract tables) on the survey extract derived from events."""

import pandas as pd
import pytest
from pyspark.sql import functions as F

from wavepanel.plans.catalogue import build_survey_tables
from wavepanel.plans.survey_raw import survey_raw

SMOKE = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def built(spark):
    raw = survey_raw(spark, SMOKE)
    return raw, build_survey_tables(raw)


def test_shapes_and_verdicts(built):
    raw, t = built
    n = raw.count()
    assert t.full.count() == n and t.extract.count() == n
    assert t.verdicts["Q9bv2part2"] == "flip" and t.verdicts["Q31v2part2"] == "ambiguous"
    assert t.verdicts["Q8v2part2"] == "correct"
    assert t.extract.where((F.col("infl_3y") > 0)).join(
        t.full.where(F.col("Q9bv2") == 2).select("userid", "wid"), ["userid", "wid"]).count() == 0


def test_tiled_answers_are_constant_per_person(built):
    _, t = built
    per = t.extract.groupBy("userid").agg(F.countDistinct("age_init").alias("k"),
                                          F.count("age_init").alias("n"), F.count("*").alias("rows"))
    assert per.where("k != 1 or n != rows").count() == 0


def test_household_carry_matches_pandas(built):
    raw, t = built
    r = raw.select("userid", "date", "D1", *[f"Q45new_{i}" for i in range(1, 7)],
                   *[f"D2new_{i}" for i in range(1, 7)]).toPandas().sort_values(["userid", "date"])
    comp = [f"Q45new_{i}" for i in range(1, 7)]
    upd = [f"D2new_{i}" for i in range(1, 7)]
    flag = r["D1"] == 2
    r.loc[flag, comp] = r.loc[flag, upd].to_numpy()
    ok = r[comp].notna().all(axis=1)
    rec = r[comp].where(ok)
    rec["userid"] = r["userid"]
    carried = rec.groupby("userid")[comp].ffill()
    kids = carried[[f"Q45new_{i}" for i in range(2, 6)]].sum(axis=1, min_count=4)
    exp = pd.DataFrame({"userid": r["userid"], "wid": r["date"], "num_kids": kids})
    got = t.extract.select("userid", "wid", "num_kids").toPandas()
    m = exp.merge(got, on=["userid", "wid"], suffixes=("_exp", "_got"))
    assert len(m) == len(exp)
    both = m["num_kids_exp"].isna() == m["num_kids_got"].isna()
    assert both.all()
    assert (m["num_kids_exp"].dropna() == m["num_kids_got"].dropna()).all()


def test_missing_required_column(spark, built):
    raw, _ = built
    with pytest.raises(KeyError):
        build_survey_tables(raw.drop("Q47"))


def test_skip_logic_raises(spark, built):
    raw, _ = built
    bad = raw.withColumn("Q16", F.lit(3.0))
    with pytest.raises(ValueError):
        build_survey_tables(bad)


def test_extract_labels(built):
    from wavepanel.functions.labels import variable_labels
    _, t = built
    assert set(variable_labels(t.extract)) >= set(t.extract.columns) - {"userid", "wid"}


def test_two_answers_of_a_person_stop_the_import(spark, built):
    raw, _ = built
    with pytest.raises(ValueError, match="Q46"):
        build_survey_tables(raw.withColumn("Q46", F.lit(1.0)))


def test_no_sort_for_the_tiles(built):
    _, t = built
    assert "SortAggregate" not in t.extract._jdf.queryExecution().executedPlan().toString()


def test_no_column_is_empty_and_ranks_hit_and_miss(spark):
    from wavepanel.plans.importer import survey_extract, survey_full
    full, extract = survey_full(spark, SMOKE), survey_extract(spark, SMOKE)
    for df in (full, extract):
        n = df.agg(*[F.count(c).alias(c) for c in df.columns]).first().asDict()
        assert all(n.values()), [c for c, k in n.items() if not k]
    ranked = extract.where(F.col("hh_inc_bin").isNotNull())
    assert 0 < ranked.where("hh_inc_bin_rank is null").count() < ranked.count()


def test_extract_is_the_same_on_the_hot_person_path(spark, built):
    """With every person 'hot' (threshold 7 rows), tiles go through the salted
    join and the household carry through segments; the extract must not change."""
    from wavepanel.session import ROWS_PER_SEGMENT_KEY
    raw, t = built
    base = t.extract.toPandas().sort_values(["userid", "wid"]).reset_index(drop=True)
    spark.conf.set(ROWS_PER_SEGMENT_KEY, "7")
    try:
        hot = build_survey_tables(raw).extract.toPandas().sort_values(["userid", "wid"]).reset_index(drop=True)
    finally:
        spark.conf.unset(ROWS_PER_SEGMENT_KEY)
    pd.testing.assert_frame_equal(base, hot)


def test_every_column_of_both_tables_has_a_label(spark):
    from wavepanel.plans.importer import panel_codebook
    from wavepanel.plans.catalogue import EXTRACT_LABELS
    book = panel_codebook(spark, "/root/testdata/sf0.001").collect()
    assert [r.variable for r in book if not r.label] == []
    assert {r.table_name for r in book} == {"full", "extract"}
    by = {(r.table_name, r.variable): r.label for r in book}
    assert by["full", "Q8v2part2"] == by["extract", "infl_1y"] == EXTRACT_LABELS["infl_1y"]
    assert by["full", "Q9_bin7"].endswith("range 7 (%)")


def test_codebook_of_a_table_without_labels_or_rows(spark):
    from wavepanel.operators.checks import codebook
    df = spark.createDataFrame([], "a int, b string")
    assert [tuple(r) for r in codebook(df).orderBy("position").collect()] == [
        (0, "a", "int", None, 0, 0), (1, "b", "string", None, 0, 0)]


def test_codebook_writes_both_tables_from_rows_prepared_once(spark, monkeypatch, capsys):
    """Tiling and carrying take a join and a window over all rows; neither
    table's plan may hold them again."""
    from wavepanel.plans import importer
    plans = []

    def write(df, path, *a, **k):
        df.explain()
        plans.append(capsys.readouterr().out)
        write_panel(df, path, *a, **k)

    write_panel = importer.write_panel
    monkeypatch.setattr(importer, "write_panel", write)
    assert importer.panel_codebook(spark, "/root/testdata/sf0.001").count()
    assert len(plans) == 2 and not [p for p in plans if "Window" in p or "HashAggregate" in p]
