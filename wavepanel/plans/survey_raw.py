"""A raw survey extract derived from ``events`` so the importer runs on the
test tables at any scale.

One row per (person, day): ``userid = user_id``, ``date`` (the wave) =
yyyymmdd, ``survey_date`` = first event of the day, moved back by whole years
that depend on the person (so that the survey spans years with and without an
income crosswalk).  Answers are fixed rules
of the day's aggregates (first event id ``eid``, mean ``v`` - from exact
integer cents - and max ``vmax`` value), respecting the questionnaire's
routing: once-only questions on the first wave only, follow-ups only where
the routing question allows them, the household update block only on later
waves.  The rules are SQL expressions that Spark and DuckDB evaluate
identically (integer arithmetic, ``floor`` instead of ``round``), so the
importer's oracle can start from the same raw table.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavepanel.operators.segments import running
from wavepanel.plans.common import table
from wavepanel.session import stage


# Survey dates are up to YEARS_BACK - 1 years before the events.
YEARS_BACK = 10


def _code(k: int, seed: int) -> str:
    return f"CAST((eid * 7919 + {seed * 104729}) % {k} + 1 AS DOUBLE)"


def _prob(seed: int) -> str:
    return f"floor(((v * {seed + 3} + {seed}) % 101) * 10) / 10"


def _pct(seed: int) -> str:
    return f"floor(((vmax + {seed}) % 15) * 100) / 100"


def _rules() -> dict[str, str]:
    sparse = "(eid % 4 <> 0)"
    r: dict[str, str] = {
        "tenure": "CAST(tenure AS INT)",
        "weight": "floor((v / 50 + 0.5) * 10000) / 10000",
        "Q1": f"CASE WHEN {sparse} THEN {_code(5, 1)} END", "Q2": _code(5, 2),
        "Q3": _prob(3), "Q4new": _prob(4), "Q5new": f"CASE WHEN {sparse} THEN {_prob(5)} END",
        "Q6new": _prob(6),
        "Q9_probdeflation": "floor((v % 1) * 1000) / 1000",
        "Q9c_probdeflation": "floor((vmax % 1) * 1000) / 1000",
        "Q10_1": "CAST(eid % 2 AS DOUBLE)", "Q10_2": "CAST(eid % 3 = 0 AS DOUBLE)",
        "Q11": f"CASE WHEN eid % 2 = 1 THEN {_code(3, 11)} END",
        "Q12new": _code(2, 12), "Q13new": _prob(13), "Q14new": _prob(14),
        "Q15": f"CASE WHEN eid % 5 <> 0 THEN {_code(2, 15)} END",
        "Q17new": _prob(17), "Q18new": _prob(18), "Q20new": _prob(20), "Q21new": _prob(21),
        "Q22new": _prob(22), "Q28": _code(5, 28), "Q29": _code(5, 29), "Q30new": _prob(30),
        "Q24_1": _prob(241), "Q24_2": _prob(242), "C1_1": _prob(111), "C1_2": _prob(112),
    }
    for s, c in (("mean", 1), ("var", 2), ("cent50", 3), ("iqr", 4)):
        r[f"Q9_{s}"] = _pct(c)
        r[f"Q9c_{s}"] = _pct(c + 4)
    for i in range(1, 11):
        r[f"Q9_bin{i}"] = _prob(100 + i)
        r[f"Q9c_bin{i}"] = _prob(200 + i)
    for i in (1, 2, 3, 5, 8):        # the other bins of this family are absent
        r[f"Q9new2_bin{i}"] = _prob(300 + i)
    # Direction questions and their percent answers: most arrive with the
    # right sign, two need a flip, one is ambiguous.
    pairs = [("Q8v2", 2, "correct"), ("Q9bv2", 2, "flip"), ("Q23v2", 3, "correct"),
             ("Q25v2", 3, "correct"), ("Q26v2", 3, "flip"), ("Q27v2", 3, "correct"),
             ("Q31v2", 3, "ambiguous"), ("C2", 3, "correct"), ("C3", 3, "correct"),
             ("Q1a", 2, "flip")]
    for i, (d, dec, kind) in enumerate(pairs):
        code, mag = _code(3, 30 + i), _pct(30 + i)
        r[d] = code
        val = {"correct": f"CASE WHEN {code} = {dec} THEN -{mag} ELSE {mag} END",
               "flip": mag,
               "ambiguous": f"CASE WHEN eid % 2 = 0 THEN -{mag} ELSE {mag} END"}[kind]
        r[d + "part2"] = f"CASE WHEN {sparse} OR {code} = {dec} THEN {val} END"
    # routing: months unemployed only if looking (Q15 = 1), out of work if not (Q15 = 2)
    r["Q16"] = f"CASE WHEN {r['Q15']} = 1 THEN CAST(eid % 24 AS DOUBLE) END"
    r["Q19"] = f"CASE WHEN {r['Q15']} = 2 THEN CAST(eid % 36 AS DOUBLE) END"
    once = {"QNUM1": "CAST(CASE WHEN eid % 3 = 0 THEN 150 ELSE 100 END AS DOUBLE)",
            "QNUM2": "CAST(CASE WHEN eid % 2 = 0 THEN 242 ELSE 220 END AS DOUBLE)",
            "QNUM3": "CAST(eid % 12 AS DOUBLE)", "QNUM5": "CAST(100 AS DOUBLE)",
            "QNUM6": "CAST(eid % 7 AS DOUBLE)", "QNUM8": _code(3, 8), "QNUM9": _code(2, 9),
            "Q32": "CAST(userid % 60 + 18 AS DOUBLE)", "Q33": _code(2, 33), "Q34": _code(2, 34),
            "Q35_1": f"{_code(2, 351)} - 1", "Q35_2": f"{_code(2, 352)} - 1", "Q36": _code(9, 36),
            "Q37": _code(6, 37), "Q38": _code(2, 38), "HH2_1": f"{_code(2, 381)} - 1",
            "HH2_2": f"{_code(2, 382)} - 1", "Q41": _code(6, 41), "Q42": _code(6, 42),
            "Q43": _code(3, 43), "Q44": _code(2, 44), "Q45b": _code(5, 45), "Q46": _code(3, 46),
            "QRA1": _code(7, 47), "QRA2": _code(10, 49), "Q47": _code(11, 48)}
    for i in range(1, 7):
        once[f"Q45new_{i}"] = f"CAST(eid % {i + 2} AS DOUBLE)"
    r.update({k: f"CASE WHEN tenure = 1 THEN {v} END" for k, v in once.items()})
    d1 = f"CASE WHEN tenure > 1 THEN {_code(2, 61)} END"
    r.update({"D1": d1, "D3": f"CASE WHEN tenure > 1 THEN {_code(2, 62)} END",
              "DSAME": f"CASE WHEN tenure > 1 THEN {_code(3, 63)} END",
              "DQ38": f"CASE WHEN tenure > 1 THEN {_code(2, 64)} END",
              "DHH2_1": f"CASE WHEN tenure > 1 THEN {_code(2, 65)} - 1 END",
              "DHH2_2": f"CASE WHEN tenure > 1 THEN {_code(2, 67)} - 1 END",
              "D6": f"CASE WHEN tenure > 1 THEN {_code(11, 66)} END"})
    for i in range(1, 7):
        r[f"D2new_{i}"] = f"CASE WHEN ({d1}) = 2 THEN CAST(CAST(floor(v) AS BIGINT) % {i + 1} AS DOUBLE) END"
    return r


def raw_sql(events: str = "events") -> str:
    """The same derivation as SQL text over a table named ``events``."""
    cols = ",\n  ".join(f"{expr} AS {name}" for name, expr in _rules().items())
    return f"""
SELECT userid, date, survey_date,
  {cols}
FROM (
  SELECT *, row_number() OVER (PARTITION BY userid ORDER BY date) AS tenure
  FROM (
    SELECT user_id AS userid, CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS date,
      min(ts) - INTERVAL 1 YEAR * (user_id % {YEARS_BACK}) AS survey_date, min(event_id) AS eid,
      CAST(sum(CAST(round(value * 100) AS BIGINT)) AS DOUBLE) / count(*) / 100.0 AS v,
      max(value) AS vmax
    FROM {events}
    GROUP BY 1, 2) d) t"""


def raw_from_events(events: DataFrame) -> DataFrame:
    day = (F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")).cast("int")
    cents = F.round(F.col("value") * 100).cast("long")
    back = F.make_ym_interval((F.col("userid") % YEARS_BACK).cast("int"), F.lit(0))
    daily = (events.groupBy(F.col("user_id").alias("userid"), day.alias("date"))
                   .agg(F.min("ts").alias("_first"), F.min("event_id").alias("eid"),
                        (F.sum(cents).cast("double") / F.count(F.lit(1)) / 100.0).alias("v"),
                        F.max("value").alias("vmax")))
    daily = running(daily, ["userid"], ["date"], {"tenure": ("sum", F.lit(1))})
    return (daily.withColumn("survey_date", F.col("_first") - back)
            .selectExpr("userid", "date", "survey_date",
                        *[f"{expr} AS {name}" for name, expr in _rules().items()]))


def survey_raw(spark, sf_dir, materialise: bool = True) -> DataFrame:
    """The derived extract, staged once as Parquet in the checkpoint folder
    (the importer scans its input several times: sign verdicts, checks,
    hot-key detection), like a stored raw extract would be."""
    raw = raw_from_events(table(spark, sf_dir, "events"))
    return stage(raw, "survey-raw") if materialise else raw
