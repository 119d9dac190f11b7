"""DuckDB oracles of the importer queries, written as plain SQL windows and
CASE expressions (no Spark code involved): sign verdicts as a counting CTE,
tiles as ``max() OVER (PARTITION BY person)``, the household record as
``last_value(... IGNORE NULLS)`` over complete rows, recodes as CASE.
The raw extract is the shared derivation ``survey_raw.raw_sql``."""

from __future__ import annotations

from wavepanel.plans.crosswalk import _sql_crosswalk
from wavepanel.plans.survey_raw import raw_sql

PAIRS = [("Q8v2", 2, "Q8v2part2"), ("Q9bv2", 2, "Q9bv2part2"), ("Q23v2", 3, "Q23v2part2"),
         ("Q25v2", 3, "Q25v2part2"), ("Q26v2", 3, "Q26v2part2"), ("Q27v2", 3, "Q27v2part2"),
         ("Q31v2", 3, "Q31v2part2"), ("C2", 3, "C2part2"), ("C3", 3, "C3part2"),
         ("Q1a", 2, "Q1apart2")]


def _verdicts() -> str:
    parts = []
    for d, code, v in PAIRS:
        neg = f"coalesce({d} = {code}, false)"
        parts.append(
            f"SELECT '{v}' AS variable, "
            f"count_if({neg} AND {v} > 0) AS wn, count_if(NOT {neg} AND {v} < 0) AS wp, "
            f"count_if({neg} AND {v} < 0) AS nl FROM raw")
    return " UNION ALL ".join(parts)


def _flip(d: str, code: int, v: str) -> str:
    return (f"CASE WHEN coalesce({d} = {code}, false) AND "
            f"(SELECT verdict FROM verdicts WHERE variable = '{v}') = 'flip' "
            f"THEN 0.0 - {v} ELSE {v} END")


def _prepared() -> str:
    """CTEs: raw -> verdicts -> prep (flipped, tiled, carried, merged)."""
    # (helper names must not collide case-insensitively with raw columns such as C2)
    comp = ", ".join(f"CASE WHEN coalesce(D1 = 2, false) THEN D2new_{i} ELSE Q45new_{i} END AS hhc{i}"
                     for i in range(1, 7))
    complete = " AND ".join(f"hhc{i} IS NOT NULL" for i in range(1, 7))
    carried = ", ".join(f"last_value(CASE WHEN {complete} THEN hhc{i} END IGNORE NULLS) OVER w AS k{i}"
                        for i in range(1, 7))
    flips = ", ".join(f"{_flip(d, c, v)} AS f_{v}" for d, c, v in PAIRS)
    return f"""
raw AS ({raw_sql()}),
verdicts AS (
  SELECT variable,
    CASE WHEN wn = 0 AND wp = 0 THEN 'correct' WHEN nl = 0 AND wp = 0 THEN 'flip' ELSE 'ambiguous' END AS verdict
  FROM ({_verdicts()}) c),
base AS (
  SELECT *, {comp},
    max(Q32) OVER p AS t_Q32, max(Q33) OVER p AS t_Q33, max(Q34) OVER p AS t_Q34,
    max(Q36) OVER p AS t_Q36, max(Q46) OVER p AS t_Q46, max(QRA1) OVER p AS t_QRA1,
    max(QRA2) OVER p AS t_QRA2,
    max(CASE WHEN Q35_1 IS NOT NULL AND Q35_2 IS NOT NULL THEN Q35_1 END) OVER p AS t_Q35_1,
    max(CASE WHEN Q35_1 IS NOT NULL AND Q35_2 IS NOT NULL THEN Q35_2 END) OVER p AS t_Q35_2,
    {flips}
  FROM raw WINDOW p AS (PARTITION BY userid)),
prep AS (
  SELECT *, {carried},
    coalesce(Q38, DQ38) AS m_Q38, coalesce(Q47, D6) AS m_Q47, coalesce(HH2_1, DHH2_1) AS m_HH2_1,
    coalesce(HH2_2, DHH2_2) AS m_HH2_2,
    CAST(year(survey_date) - CASE WHEN month(CASE WHEN day(survey_date) = 1
           THEN date_trunc('month', survey_date) - INTERVAL 1 MONTH
           ELSE date_trunc('month', survey_date) END) <= 6 THEN 1 ELSE 0 END AS INTEGER) AS ref_year
  FROM base WINDOW w AS (PARTITION BY userid ORDER BY date
                         ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
cw AS (SELECT year + 22 AS year, ibin, round(rank, 3) AS rank FROM ({_sql_crosswalk()}) x),
cwr AS (SELECT year, ibin, CASE WHEN (SELECT max(rank) FROM cw) <= 1.0 THEN rank * 100.0 ELSE rank END AS r
        FROM cw)"""


def _case(x: str, mapping: dict, dtype: str) -> str:
    body = " ".join(f"WHEN {k} THEN {v}" for k, v in mapping.items())
    return f"CAST(CASE {x} {body} END AS {dtype})"


def extract_sql() -> str:
    yes_no = {1: 1, 2: 0}
    educ4 = {1: 1, 2: 2, 3: 3, 4: 3, 5: 4, 6: 4, 7: 4, 8: 4}
    numeracy = [("QNUM1", "num_lit_q1", 150, None), ("QNUM2", "num_lit_q2", 200 * 1.1 ** 2, 1e-6),
                ("QNUM3", "num_lit_q3", 10, None), ("QNUM5", "num_lit_q5", 100, None),
                ("QNUM6", "num_lit_q6", 10000 * 0.0005, None), ("QNUM8", "num_lit_q8", 3, None),
                ("QNUM9", "num_lit_q9", 2, None)]
    num = []
    for raw, stem, right, tol in numeracy:
        test = f"abs({raw} - {right!r}) < {tol!r}" if tol else f"{raw} = {right!r}"
        num.append(f"{raw} AS {stem}, CAST({test} AS DOUBLE) AS {stem}_correct")
    kids = [f"k{i}" for i in range(2, 6)]
    num_kids = (f"CAST(CASE WHEN {' AND '.join(k + ' IS NOT NULL' for k in kids)} "
                f"THEN {' + '.join(kids)} END AS INTEGER)")
    return f"""
WITH {_prepared()}
SELECT userid, date AS wid, survey_date AS date, tenure, weight,
  CAST(coalesce(Q1, -1) AS TINYINT) AS financial_past_12m,
  CAST(coalesce(Q2, -1) AS TINYINT) AS financial_12m,
  Q3 AS prob_move_house, Q4new AS prob_unrate_up, Q5new AS prob_irate_up, Q6new AS prob_stocks_up,
  f_Q8v2part2 AS infl_1y,
  Q9_mean AS infl_1y_bin_mean, Q9_var AS infl_1y_bin_var, Q9_cent50 AS infl_1y_bin_median,
  Q9_iqr AS infl_1y_bin_iqr, Q9_probdeflation * 100.0 AS infl_1y_bin_prob_defl,
  f_Q9bv2part2 AS infl_3y,
  Q9c_mean AS infl_3y_bin_mean, Q9c_var AS infl_3y_bin_var, Q9c_cent50 AS infl_3y_bin_median,
  Q9c_iqr AS infl_3y_bin_iqr, Q9c_probdeflation * 100.0 AS infl_3y_bin_prob_defl,
  f_Q1apart2 AS infl_5y,
  CAST(coalesce(Q10_1 = 1, false) OR coalesce(Q10_2 = 1, false) AS SMALLINT) AS working,
  Q11 AS num_jobs, {_case('Q12new', {1: 0, 2: 1}, 'INTEGER')} AS self_employed,
  Q13new AS prob_lose_job, Q14new AS prob_leave_job,
  CAST(coalesce(Q15 = 1, false) AS INTEGER) AS looking_for_job,
  Q17new AS prob_accept_job_12m, Q18new AS prob_accept_job_3m,
  coalesce(Q16, Q19) AS jobless_length,
  Q20new AS prob_search_job_12m, Q21new AS prob_search_job_3m,
  f_Q23v2part2 AS earnings_change, f_Q25v2part2 AS hh_inc_change,
  f_Q26v2part2 AS hh_spending_change, f_Q27v2part2 AS taxes_change,
  Q28 AS credit_cond_past12m, Q29 AS credit_cond_12m, Q30new AS prob_miss_paym_3m,
  f_Q31v2part2 AS house_price_change, f_C2part2 AS house_price_change_3y, f_C3part2 AS govt_debt_change,
  {", ".join(num)},
  CAST(t_Q32 AS INTEGER) AS age_init,
  {_case('t_Q33', yes_no, 'INTEGER')} AS female, {_case('t_Q34', yes_no, 'INTEGER')} AS hispanic,
  CAST(t_Q35_2 AS SMALLINT) AS black,
  CAST(t_Q36 IN (5, 6, 7, 8) AS DOUBLE) AS college, {_case('t_Q36', educ4, 'INTEGER')} AS educ,
  {_case('Q43', {1: 1, 2: 0, 3: 0}, 'INTEGER')} AS owner,
  TRY_CAST(Q45b AS SMALLINT) AS health, CAST(t_QRA1 AS SMALLINT) AS take_fin_risk,
  CAST(coalesce(D1 = 2, false) AS SMALLINT) AS hh_changed,
  {num_kids} AS num_kids,
  CAST(DSAME IN (1, 2) AS DOUBLE) AS same_employer,
  {_case('m_Q38', yes_no, 'INTEGER')} AS couple,
  CAST(coalesce(m_HH2_1 = 1, false) OR coalesce(m_HH2_2 = 1, false) AS SMALLINT) AS spouse_working,
  TRY_CAST(m_Q47 AS INTEGER) AS hh_inc_bin,
  cwr.r AS hh_inc_bin_rank
FROM prep LEFT JOIN cwr ON prep.ref_year = cwr.year AND TRY_CAST(prep.m_Q47 AS INTEGER) = cwr.ibin"""


def full_sql() -> str:
    copy = (["Q3", "Q4new", "Q5new", "Q6new"] + [f"Q9_bin{i}" for i in range(1, 11)]
            + [f"Q9c_bin{i}" for i in range(1, 11)]
            + [f"Q9new2_bin{i}" for i in (1, 2, 3, 5, 8)]
            + ["Q10_1", "Q10_2", "Q11", "Q12new", "Q13new", "Q14new", "Q15", "Q16", "Q17new", "Q18new",
               "Q19", "Q20new", "Q21new", "Q22new", "Q23v2", "Q24_1", "Q24_2", "Q25v2", "Q26v2", "Q27v2",
               "Q28", "Q29", "Q30new", "Q31v2", "C1_1", "C1_2", "C2", "C3",
               "QNUM1", "QNUM2", "QNUM3", "QNUM5", "QNUM6", "QNUM8", "QNUM9",
               "Q37", "Q41", "Q42", "Q43", "Q44", "Q45b", "D1", "D3", "DSAME"])
    flipped = ", ".join(f"f_{v} AS {v}" for _, _, v in PAIRS)
    carried = ", ".join(f"k{i} AS Q45new_{i}" for i in range(1, 7))
    return f"""
WITH {_prepared()}
SELECT userid, date AS wid, survey_date AS date, tenure, weight,
  CAST(coalesce(Q1, -1) AS TINYINT) AS Q1, CAST(coalesce(Q2, -1) AS TINYINT) AS Q2,
  {", ".join(copy)}, {flipped},
  CAST(t_Q32 AS INTEGER) AS Q32, CAST(t_Q33 AS SMALLINT) AS Q33, CAST(t_Q34 AS SMALLINT) AS Q34,
  CAST(t_Q35_1 AS SMALLINT) AS Q35_1, CAST(t_Q35_2 AS SMALLINT) AS Q35_2,
  CAST(t_Q36 AS SMALLINT) AS Q36, m_Q38 AS Q38, m_HH2_1 AS HH2_1, m_HH2_2 AS HH2_2, {carried},
  CAST(t_Q46 AS SMALLINT) AS Q46, CAST(t_QRA1 AS SMALLINT) AS QRA1,
  CAST(t_QRA2 AS SMALLINT) AS QRA2, m_Q47 AS Q47,
  cwr.r AS Q47_rank
FROM prep LEFT JOIN cwr ON prep.ref_year = cwr.year AND prep.m_Q47 = cwr.ibin"""


EXTRACT_VARS = [
    "tenure", "weight", "financial_past_12m", "financial_12m", "prob_move_house", "prob_unrate_up",
    "prob_irate_up", "prob_stocks_up", "infl_1y", "infl_1y_bin_mean", "infl_1y_bin_var",
    "infl_1y_bin_median", "infl_1y_bin_iqr", "infl_1y_bin_prob_defl", "infl_3y", "infl_3y_bin_mean",
    "infl_3y_bin_var", "infl_3y_bin_median", "infl_3y_bin_iqr", "infl_3y_bin_prob_defl", "infl_5y", "working",
    "num_jobs", "self_employed", "prob_lose_job", "prob_leave_job", "looking_for_job",
    "prob_accept_job_12m", "prob_accept_job_3m", "jobless_length", "prob_search_job_12m",
    "prob_search_job_3m", "earnings_change", "hh_inc_change", "hh_spending_change", "taxes_change",
    "credit_cond_past12m", "credit_cond_12m", "prob_miss_paym_3m", "house_price_change",
    "house_price_change_3y", "govt_debt_change",
    *[f"num_lit_q{i}{s}" for i in (1, 2, 3, 5, 6, 8, 9) for s in ("", "_correct")],
    "age_init", "female", "hispanic", "black", "college", "educ", "owner", "health", "take_fin_risk",
    "hh_changed", "num_kids", "same_employer", "couple", "spouse_working", "hh_inc_bin",
    "hh_inc_bin_rank"]


def extract_wave_stats_sql() -> str:
    casts = ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in EXTRACT_VARS)
    return f"""
WITH e AS (SELECT wid, {casts} FROM ({extract_sql()}) x),
u AS (SELECT wid, variable, val FROM (UNPIVOT e ON {", ".join(EXTRACT_VARS)} INTO NAME variable VALUE val))
SELECT wid, variable, round(quantile_cont(val, 0.25), 6) AS p25, round(quantile_cont(val, 0.5), 6) AS p50,
  round(quantile_cont(val, 0.75), 6) AS p75,
  CAST(sum(CAST(round(val * 10000) AS BIGINT)) AS DOUBLE) / 10000.0 / count(val) AS mean
FROM u GROUP BY wid, variable"""


def codebook_sql() -> str:
    from wavepanel.functions.columns import numbered
    from wavepanel.plans.catalogue import (EXTRACT_LABELS, KEY_LABELS, REQUIRED, SIGN_PAIRS, TILES,
                                           full_labels)
    stems = ("Q9_bin", "Q9c_bin", "Q9new2_bin", "Q10_", "Q24_", "C1_", "Q35_", "HH2_", "Q45new_")
    columns = {*REQUIRED, *(t for t, _ in TILES), *(c for d, _, v, _ in SIGN_PAIRS for c in (d, v)),
               *KEY_LABELS, "Q47_rank", *(c for x in stems for c in numbered(x, 1, 10))}
    labels = {"full": full_labels(sorted(columns)), "extract": {**KEY_LABELS, **EXTRACT_LABELS}}

    def quoted(x: str) -> str:
        return "'" + x.replace("'", "''") + "'"

    values = ", ".join(f"('{t}', '{c}', {quoted(x)})" for t, m in labels.items() for c, x in m.items())
    counts = " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, variable, n_present, (SELECT count(*) FROM t_{t}) - n_present AS n_missing "
        f"FROM (UNPIVOT (SELECT count(COLUMNS(*)) FROM t_{t}) ON COLUMNS(*) INTO NAME variable VALUE n_present)"
        for t in labels)
    return f"""
WITH t_full AS MATERIALIZED ({full_sql()}), t_extract AS MATERIALIZED ({extract_sql()}),
l(table_name, variable, label) AS (VALUES {values}),
n AS ({counts})
SELECT table_name, variable, label, n_present, n_missing FROM n LEFT JOIN l USING (table_name, variable)"""
