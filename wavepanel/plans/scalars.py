"""Named queries of the scalar operators (recodes, flags, scores, casts,
row sums, family merge, labels) on ``part`` and the ``events`` panel."""

from __future__ import annotations

from pyspark.sql import functions as F

from wavepanel.functions.columns import (any_equals_flag, family_merge, first_present,
                                         interval_recode, member_flag, recode, row_sum,
                                         score_answer, sentinel_fill)
from wavepanel.functions.labels import CODE_LABELS, label
from wavepanel.operators.checks import cast_report
from wavepanel.plans.common import PANEL_SQL, panel, table

# Survey recodes used by the extract.
EDUC4 = {1: 1, 2: 2, 3: 3, 4: 3, 5: 4, 6: 4, 7: 4, 8: 4}
TWO_TO_ONE = {1: 0, 2: 1}
COLLEGE_CODES = (5, 6, 7, 8)


def _codes(spark, sf_dir):
    p = panel(spark, sf_dir, with_tenure=False)
    return p.withColumns({
        "code1": F.when(F.col("event_id") % 3 == 0, F.floor("value").cast("int") % 10),
        "code2": F.when(F.col("event_id") % 5 != 0, F.floor("value").cast("int") % 3),
    })


def recode_map(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey", "p_size", recode("p_size", EDUC4, "int").alias("educ4"),
                    recode("p_size", TWO_TO_ONE, "int").alias("self_emp"))


def q_interval_recode(spark, sf_dir):
    p = table(spark, sf_dir, "part")
    return p.select("p_partkey",
                    interval_recode("p_size", [(0, 9, 0), (10, 11, 1)]).cast("int").alias("college"),
                    interval_recode("p_size", [(49, 50, None)]).cast("int").alias("size_na"))


def q_member_flag(spark, sf_dir):
    return _codes(spark, sf_dir).select("event_id", "code1",
                                        member_flag("code1", COLLEGE_CODES).alias("flag"))


def any_flag(spark, sf_dir):
    return _codes(spark, sf_dir).select("event_id", any_equals_flag(["code1", "code2"], 1).alias("any1"))


def q_score_answer(spark, sf_dir):
    p = panel(spark, sf_dir, with_tenure=False)
    p = p.withColumn("x", F.when(F.col("event_id") % 3 == 0, F.round("value")))
    return p.select("event_id", score_answer("x", 10).alias("x_correct"),
                    score_answer("b", 24.2, tolerance=1e-6).alias("b_correct"))


def q_sentinel_fill(spark, sf_dir):
    return _codes(spark, sf_dir).select("event_id", sentinel_fill("code1").alias("code_filled"))


def coalesce_cols(spark, sf_dir):
    p = panel(spark, sf_dir, with_tenure=False)
    return p.select("event_id", first_present("a", "b", "value").alias("first_present"))


def try_cast_report(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    k = F.regexp_extract("props", r"(\d+)", 1).cast("int")
    return cast_report(ev, {"k2_tinyint": (k * 2, "tinyint"), "k400_smallint": (k * 400, "smallint")})


def row_sum_min_count(spark, sf_dir):
    p = panel(spark, sf_dir)
    parts = ["a", "b", "value", "asked_once"]
    return p.select("event_id", F.round(row_sum(parts), 6).alias("s_all"),
                    F.round(row_sum(parts, min_count=2), 6).alias("s_min2"))


def q_family_merge(spark, sf_dir):
    p = panel(spark, sf_dir, with_tenure=False).select(
        "event_id", F.col("a").alias("HH2_1"), F.col("b").alias("HH2_2"),
        F.when(F.col("event_id") % 7 == 0, F.col("value")).alias("DHH2_1"),
        (F.col("value") * 2).alias("DHH2_2"))
    return p.select("event_id", *family_merge(p))


def label_codes(spark, sf_dir):
    p = table(spark, sf_dir, "part").withColumns({
        "inc_code": (F.col("p_size") % 12).cast("int"), "educ_code": (F.col("p_size") % 10).cast("int")})
    return p.select("p_partkey", "inc_code", label("inc_code", "income_bin").alias("inc_label"),
                    "educ_code", label("educ_code", "education").alias("educ_label"))


QUERIES = {
    "recode_map": recode_map,
    "interval_recode": q_interval_recode,
    "member_flag": q_member_flag,
    "any_flag": any_flag,
    "score_answer": q_score_answer,
    "sentinel_fill": q_sentinel_fill,
    "coalesce_cols": coalesce_cols,
    "try_cast_report": try_cast_report,
    "row_sum_min_count": row_sum_min_count,
    "family_merge": q_family_merge,
    "label_codes": label_codes,
}


def _case(x: str, mapping: dict, quote: bool = False) -> str:
    def lit(v):
        return "'" + str(v).replace("'", "''") + "'" if quote else str(v)
    return f"CASE {x} " + " ".join(f"WHEN {k} THEN {lit(v)}" for k, v in mapping.items()) + " END"


_CODES = f"""
WITH {PANEL_SQL},
c AS (SELECT *,
  CASE WHEN event_id % 3 = 0 THEN CAST(floor(value) AS INTEGER) % 10 END AS code1,
  CASE WHEN event_id % 5 <> 0 THEN CAST(floor(value) AS INTEGER) % 3 END AS code2
  FROM panel)"""

_SUM_PARTS = ["a", "b", "value", "asked_once"]
_PRESENT = " + ".join(f"CAST({c} IS NOT NULL AS INTEGER)" for c in _SUM_PARTS)
_TOTAL = " + ".join(f"coalesce({c}, 0)" for c in _SUM_PARTS)

SQL = {
    "recode_map": f"""
SELECT p_partkey, p_size, CAST({_case('p_size', EDUC4)} AS INTEGER) AS educ4,
  CAST({_case('p_size', TWO_TO_ONE)} AS INTEGER) AS self_emp FROM part""",
    "interval_recode": """
SELECT p_partkey,
  CAST(CASE WHEN p_size BETWEEN 0 AND 9 THEN 0 WHEN p_size BETWEEN 10 AND 11 THEN 1 ELSE p_size END AS INTEGER) AS college,
  CAST(CASE WHEN p_size BETWEEN 49 AND 50 THEN NULL ELSE p_size END AS INTEGER) AS size_na
FROM part""",
    "member_flag": f"{_CODES} SELECT event_id, code1, CAST(code1 IN (5, 6, 7, 8) AS DOUBLE) AS flag FROM c",
    "any_flag": f"""{_CODES}
SELECT event_id, CAST(coalesce(code1 = 1, false) OR coalesce(code2 = 1, false) AS SMALLINT) AS any1 FROM c""",
    "score_answer": f"""
WITH {PANEL_SQL}
SELECT event_id,
  CAST(CASE WHEN event_id % 3 = 0 THEN round(value) END = 10 AS DOUBLE) AS x_correct,
  CAST(abs(b - 24.2) < 1e-6 AS DOUBLE) AS b_correct
FROM panel""",
    "sentinel_fill": f"{_CODES} SELECT event_id, CAST(coalesce(code1, -1) AS TINYINT) AS code_filled FROM c",
    "coalesce_cols": f"WITH {PANEL_SQL} SELECT event_id, coalesce(a, b, value) AS first_present FROM panel",
    "try_cast_report": """
WITH e AS (SELECT CAST(regexp_extract(props, '(\\d+)', 1) AS INTEGER) AS k FROM events)
SELECT 'k2_tinyint' AS variable, 'tinyint' AS dtype, count(k * 2) AS n_present,
  CAST(count_if(k * 2 IS NOT NULL AND TRY_CAST(k * 2 AS TINYINT) IS NULL) AS BIGINT) AS n_failed FROM e
UNION ALL
SELECT 'k400_smallint', 'smallint', count(k * 400),
  CAST(count_if(k * 400 IS NOT NULL AND TRY_CAST(k * 400 AS SMALLINT) IS NULL) AS BIGINT) FROM e""",
    "row_sum_min_count": f"""
WITH {PANEL_SQL}
SELECT event_id,
  round(CASE WHEN {_PRESENT} >= 4 THEN {_TOTAL} END, 6) AS s_all,
  round(CASE WHEN {_PRESENT} >= 2 THEN {_TOTAL} END, 6) AS s_min2
FROM panel""",
    "family_merge": f"""
WITH {PANEL_SQL}
SELECT event_id, coalesce(a, CASE WHEN event_id % 7 = 0 THEN value END) AS HH2_1,
  coalesce(b, value * 2) AS HH2_2
FROM panel""",
    "label_codes": f"""
SELECT p_partkey, CAST(p_size % 12 AS INTEGER) AS inc_code,
  {_case('p_size % 12', CODE_LABELS['income_bin'], True)} AS inc_label,
  CAST(p_size % 10 AS INTEGER) AS educ_code,
  {_case('p_size % 10', CODE_LABELS['education'], True)} AS educ_label
FROM part""",
}
