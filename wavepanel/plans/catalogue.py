"""The survey variable catalogue: raw panel extract -> (full, extract) tables.

A declarative client of the operator library.  The build is a short plan,
whatever the number of variables:

1. keys and NaN -> NULL on the raw table (one projection);
2. ONE aggregate decides the sign convention of all direction/percent pairs;
3. ONE per-person aggregate + left join tiles the once-only answers;
4. ONE running "last complete record" per person carries the household
   composition forward (after overwriting it on rows that report a change);
5. two projections emit the full table (raw names) and the extract
   (analysis names); the income rank is a broadcast left join on
   (reference year, income bin).

Skip-logic checks run as one violation count.  Deviations from the
behaviour being reproduced are listed in README.md (carry stays within a
person, flipped house-price change, spouse flag from the merged family,
races tiled in both tables, schema independent of the data).
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavepanel.functions.columns import (any_equals_flag, columns_matching, equals_flag, existing,
                                         first_present, member_flag, numbered, recode, rescale,
                                         row_sum, score_answer, sentinel_fill, try_cast)
from wavepanel.functions.labels import with_variable_labels
from wavepanel.operators.checks import implies_missing, rule_violations
from wavepanel.operators.panel import carry_forward, tile
from wavepanel.operators.segments import hot_keys
from wavepanel.session import rows_per_segment, stage
from wavepanel.operators.ranks import attach_rank, validated_crosswalk
from wavepanel.operators.signs import decide, flipped, negative_mask
from wavepanel.functions.columns import reference_year

ID, WID = "userid", "wid"

# Direction questions, the code meaning "decrease", the percent
# column whose sign they fix, and the extract name of the result.
SIGN_PAIRS = [
    ("Q8v2", 2, "Q8v2part2", "infl_1y"),
    ("Q9bv2", 2, "Q9bv2part2", "infl_3y"),
    ("Q1a", 2, "Q1apart2", "infl_5y"),
    ("Q23v2", 3, "Q23v2part2", "earnings_change"),
    ("Q25v2", 3, "Q25v2part2", "hh_inc_change"),
    ("Q26v2", 3, "Q26v2part2", "hh_spending_change"),
    ("Q27v2", 3, "Q27v2part2", "taxes_change"),
    ("Q31v2", 3, "Q31v2part2", "house_price_change"),
    ("C2", 3, "C2part2", "house_price_change_3y"),
    ("C3", 3, "C3part2", "govt_debt_change"),
]
OPTIONAL_SIGN_PAIRS = {"Q1a"}

# Once-only answers tiled to all waves of a person, with type.
TILES = [("Q32", "int"), ("Q33", "smallint"), ("Q34", "smallint"), ("Q36", "smallint"),
         ("Q46", "smallint"), ("QRA1", "smallint"), ("QRA2", "smallint")]
OPTIONAL_TILES = {"QRA1", "QRA2"}

# Plain copies into the extract (extract name, raw name).
COPIES = [
    ("prob_move_house", "Q3"), ("prob_unrate_up", "Q4new"), ("prob_irate_up", "Q5new"),
    ("prob_stocks_up", "Q6new"),
    ("infl_1y_bin_mean", "Q9_mean"), ("infl_1y_bin_var", "Q9_var"),
    ("infl_1y_bin_median", "Q9_cent50"), ("infl_1y_bin_iqr", "Q9_iqr"),
    ("infl_3y_bin_mean", "Q9c_mean"), ("infl_3y_bin_var", "Q9c_var"),
    ("infl_3y_bin_median", "Q9c_cent50"), ("infl_3y_bin_iqr", "Q9c_iqr"),
    ("num_jobs", "Q11"), ("prob_lose_job", "Q13new"), ("prob_leave_job", "Q14new"),
    ("prob_accept_job_12m", "Q17new"), ("prob_accept_job_3m", "Q18new"),
    ("prob_search_job_12m", "Q20new"), ("prob_search_job_3m", "Q21new"),
    ("credit_cond_past12m", "Q28"), ("credit_cond_12m", "Q29"), ("prob_miss_paym_3m", "Q30new"),
]

# Numeracy questions (raw name, extract stem, right answer, tolerance).
NUMERACY = [
    ("QNUM1", "num_lit_q1", 150, None),
    ("QNUM2", "num_lit_q2", 200 * 1.1 ** 2, 1e-6),
    ("QNUM3", "num_lit_q3", 10, None),
    ("QNUM5", "num_lit_q5", 100, None),
    ("QNUM6", "num_lit_q6", 10000 * 0.0005, None),
    ("QNUM8", "num_lit_q8", 3, None),
    ("QNUM9", "num_lit_q9", 2, None),
]

# Code recodes of the extract.
YES_NO = {1: 1, 2: 0}
EMPLOYER = {1: 0, 2: 1}
EDUC4 = {1: 1, 2: 2, 3: 3, 4: 3, 5: 4, 6: 4, 7: 4, 8: 4}
OWNER = {1: 1, 2: 0, 3: 0}
COLLEGE_CODES = (5, 6, 7, 8)
SAME_EMPLOYER_CODES = (1, 2)
KIDS = numbered("Q45new_", 2, 5)

REQUIRED = (["date", "survey_date", "tenure", "weight", "Q1", "Q2", "Q3", "Q4new", "Q5new", "Q6new",
             "Q9_mean", "Q9_var", "Q9_cent50", "Q9_iqr", "Q9_probdeflation",
             "Q9c_mean", "Q9c_var", "Q9c_cent50", "Q9c_iqr", "Q9c_probdeflation",
             "Q10_1", "Q10_2", "Q11", "Q12new", "Q13new", "Q14new", "Q15", "Q16", "Q17new", "Q18new",
             "Q19", "Q20new", "Q21new", "Q22new", "Q28", "Q29", "Q30new",
             "Q35_2", "Q37", "Q38", "Q41", "Q42", "Q43", "Q44", "Q45b", "Q47",
             "D1", "D3", "DSAME", "DQ38", "D6"]
            + numbered("Q9_bin", 1, 10) + numbered("Q9c_bin", 1, 10) + KIDS
            + [q for q, *_ in NUMERACY]
            + [c for d, _, v, _ in SIGN_PAIRS if d not in OPTIONAL_SIGN_PAIRS for c in (d, v)]
            + [t for t, _ in TILES if t not in OPTIONAL_TILES])

# Variable labels of the extract (attached as column comments).
EXTRACT_LABELS = {
    "date": "Interview date", "tenure": "Waves in panel", "weight": "Survey weight",
    "financial_past_12m": "Financially better/worse off than 12 months ago (-1 = missing)",
    "financial_12m": "Financially better/worse off 12 months from now (-1 = missing)",
    "prob_move_house": "Chance of moving house within 12 months (%)",
    "prob_unrate_up": "Chance that unemployment is higher in 12 months (%)",
    "prob_irate_up": "Chance that savings rates are higher in 12 months (%)",
    "prob_stocks_up": "Chance that stock prices are higher in 12 months (%)",
    **{f"infl_{y}_bin_{s}": f"Inflation {when}: {what} of the person's density"
       for y, when in (("1y", "in 12 months"), ("3y", "in 24-36 months"))
       for s, what in (("mean", "mean"), ("var", "variance"), ("median", "median"),
                       ("iqr", "interquartile range"),
                       ("prob_defl", "probability of deflation (%)"))},
    "num_jobs": "Number of jobs held", "prob_lose_job": "Chance of losing the main job (%)",
    "prob_leave_job": "Chance of leaving the main job by choice (%)",
    "prob_accept_job_12m": "Chance of finding an acceptable job within 12 months (%)",
    "prob_accept_job_3m": "Chance of finding an acceptable job within 3 months (%)",
    "prob_search_job_12m": "Chance of looking for work within 12 months (%)",
    "prob_search_job_3m": "Chance of looking for work within 3 months (%)",
    "credit_cond_past12m": "Getting credit now against 12 months ago (1 harder - 5 easier)",
    "credit_cond_12m": "Getting credit in 12 months against now (1 harder - 5 easier)",
    "prob_miss_paym_3m": "Chance of missing a debt payment within 3 months (%)",
    **{stem: f"Numeracy question {stem[-1]}: answer" for _, stem, _, _ in NUMERACY},
    **{f"{stem}_correct": f"Numeracy question {stem[-1]}: answered correctly"
       for _, stem, _, _ in NUMERACY},
    "infl_1y": "Expected inflation, next 12 months (%)",
    "infl_3y": "Expected inflation, 24-36 months ahead (%)",
    "infl_5y": "Expected inflation, 48-60 months ahead (%)",
    "working": "Working full- or part-time", "self_employed": "Self-employed",
    "looking_for_job": "Looking for a job", "jobless_length": "Months without work",
    "earnings_change": "Expected earnings change (%)", "hh_inc_change": "Expected household income change (%)",
    "hh_spending_change": "Expected household spending change (%)", "taxes_change": "Expected tax change (%)",
    "house_price_change": "Expected house price change, 12 months (%)",
    "house_price_change_3y": "Expected house price change, 24-36 months (%)",
    "govt_debt_change": "Expected government debt change (%)",
    "age_init": "Age at first interview", "female": "Female", "hispanic": "Hispanic", "black": "Black",
    "college": "Bachelor's degree or higher", "educ": "Education, 4 groups", "owner": "Owns residence",
    "health": "Self-reported health", "take_fin_risk": "Willingness to take financial risk",
    "hh_changed": "Household changed since last interview", "num_kids": "Children in household",
    "same_employer": "Same employer as last interview", "couple": "Married or living with partner",
    "spouse_working": "Partner working", "hh_inc_bin": "Family income bin (1-11)",
    "hh_inc_bin_rank": "Median national income rank of the bin (0-100)",
}

KEY_LABELS = {ID: "Person", WID: "Wave (year and month)"}

# Labels of the raw answers that have no extract variable of the same content;
# {} stands for the number at the end of the name.
QUESTION_LABELS = [
    (r"Q9_bin(\d+)", "Inflation in 12 months: chance of range {} (%)"),
    (r"Q9c_bin(\d+)", "Inflation in 24-36 months: chance of range {} (%)"),
    (r"Q9new2_bin(\d+)", "Inflation in 48-60 months: chance of range {} (%)"),
    (r"Q10_(\d+)", "Employment status {} applies"),
    (r"Q12new", "Employer: someone else (1) or own business (2)"),
    (r"Q15", "Without a job: looking for one (1) or not (2)"),
    (r"Q16", "Months of looking for a job"),
    (r"Q19", "Months since the last job"),
    (r"Q22new", "Chance of finding a job within 3 months after losing the present one (%)"),
    (r"Q23v2", "Earnings: rise, stay or fall"),
    (r"Q24_(\d+)", "Earnings: chance of change range {} (%)"),
    (r"Q25v2", "Household income: rise, stay or fall"),
    (r"Q26v2", "Household spending: rise, stay or fall"),
    (r"Q27v2", "Taxes: rise, stay or fall"),
    (r"Q31v2", "House prices in 12 months: rise, stay or fall"),
    (r"C1_(\d+)", "House prices: chance of change range {} (%)"),
    (r"C2", "House prices in 24-36 months: rise, stay or fall"),
    (r"C3", "Government debt: rise, stay or fall"),
    (r"Q33", "Gender code"),
    (r"Q34", "Hispanic, Latino or Spanish (1 yes, 2 no)"),
    (r"Q35_(\d+)", "Race: group {} applies"),
    (r"Q36", "Highest schooling, survey code"),
    (r"Q37", "Tenure of the present job, code"),
    (r"Q38", "Married or living with partner (1 yes, 2 no)"),
    (r"HH2_(\d+)", "Partner's employment status {} applies"),
    (r"Q41", "State of residence, years there, code"),
    (r"Q42", "Present home, years there, code"),
    (r"Q43", "Home: owned (1), rented (2), other (3)"),
    (r"Q44", "Other homes owned, code"),
    (r"Q45new_(\d+)", "Household members of group {}"),
    (r"Q46", "Decides on the household's finances, code"),
    (r"QRA2", "Willingness to take risks in daily life"),
    (r"Q47", "Family income bin (1-11), latest answer"),
    (r"Q47_rank", "Median national income rank of the bin (0-100)"),
    (r"D1", "Household members since the last interview: same (1) or changed (2)"),
    (r"D3", "Job since the last interview: same (1) or changed (2)"),
    (r"DSAME", "Employer since the last interview: code of same or other"),
]


def full_labels(columns: Sequence[str]) -> dict[str, str]:
    """Labels of the full table's columns: an answer that the extract copies
    has its variable's label, the others have one of their own."""
    same = {raw: EXTRACT_LABELS[name] for name, raw in COPIES}
    same |= {percent: EXTRACT_LABELS[name] for _, _, percent, name in SIGN_PAIRS}
    same |= {raw: EXTRACT_LABELS[stem] for raw, stem, _, _ in NUMERACY}
    same |= {c: EXTRACT_LABELS[c] for c in ("date", "tenure", "weight")}
    same |= {"Q1": EXTRACT_LABELS["financial_past_12m"], "Q2": EXTRACT_LABELS["financial_12m"],
             "Q32": EXTRACT_LABELS["age_init"], "Q45b": EXTRACT_LABELS["health"],
             "QRA1": EXTRACT_LABELS["take_fin_risk"], **KEY_LABELS}
    out = {}
    for c in columns:
        found = [(m, text) for p, text in QUESTION_LABELS if (m := re.fullmatch(p, c))]
        if c in same:
            out[c] = same[c]
        elif found:
            out[c] = found[0][1].format(*found[0][0].groups())
    return out


@dataclass
class SurveyTables:
    full: DataFrame
    extract: DataFrame
    verdicts: dict[str, str] = field(default_factory=dict)


def _nan_to_null(df: DataFrame) -> DataFrame:
    fl = {f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))}
    return df.select(*[(F.when(~F.isnan(c), F.col(c)).alias(c) if c in fl else F.col(c))
                       for c in df.columns])


def check_required(raw: DataFrame) -> None:
    missing = [c for c in [ID, "date"] + REQUIRED if c not in raw.columns]
    if "Q1a" in raw.columns and "Q1apart2" not in raw.columns:
        missing.append("Q1apart2")
    if missing:
        raise KeyError(f"raw extract lacks required columns: {missing}")


# Skip logic: months unemployed only when looking (Q15 = 1), months out of
# work only when not looking (Q15 = 2).
def skip_rules() -> dict[str, Column]:
    return {"Q16_needs_Q15_eq_1": implies_missing("Q15", 1, "Q16"),
            "Q19_needs_Q15_eq_2": implies_missing("Q15", 2, "Q19")}


def skip_logic(prepared: DataFrame) -> DataFrame:
    """Rows breaking the skip-logic rules (one output row per row and rule)."""
    return rule_violations(prepared, skip_rules(), [ID, WID])


def prepare(raw: DataFrame, checks: str = "raise") -> tuple[DataFrame, dict[str, str]]:
    """Cleaned wide table under raw names (plus ``hh_changed_flag``)."""
    check_required(raw)
    df = _nan_to_null(raw.withColumnsRenamed({"date": WID, "survey_date": "date"}))
    cols = set(df.columns)

    # 2. signs: one aggregate for all pairs
    pairs = {v: (v, negative_mask(d, code)) for d, code, v, _ in SIGN_PAIRS
             if d in cols and v in cols}
    # the skip-logic check rides along in the same aggregate
    rules = skip_rules() if checks == "raise" else {}
    decided = decide(df, pairs, {k: F.count_if(c) for k, c in rules.items()})
    verdicts = {v: decided[v] for v in pairs}
    bad = [k for k in rules if decided[k]]
    if bad:
        raise ValueError(f"skip-logic violation ({', '.join(bad)}): Q16/Q19 filled for the wrong Q15 answer")
    df = df.withColumns({v: flipped(v, neg, verdicts[v]) for v, (_, neg) in pairs.items()})

    # 3. tiles: once-only answers (one aggregate + join); races as one record
    # one skew check per person key, shared by the tile join and the carry window
    hot = hot_keys(df, [ID], rows_per_segment(df.sparkSession))
    tiles = {t: dt for t, dt in TILES if t in cols}
    df = tile(df, list(tiles), ID, dtypes=tiles,
              records={"_races": columns_matching(df, r"Q35.*")}, record_dtype="smallint", hot=hot,
              check="eager" if checks == "raise" else "lazy")

    # 4. household composition: overwrite on change, carry last complete record
    flag = F.coalesce(F.col("D1") == 2, F.lit(False))
    comp = columns_matching(df, r"Q45new_.*")
    upd = columns_matching(df, r"D2new_.*")
    if comp:
        if upd:
            if len(upd) != len(comp):
                raise ValueError(f"D2new_* ({len(upd)}) and Q45new_* ({len(comp)}) differ in length")
            df = df.withColumns({o: F.when(flag, F.col(n)).otherwise(F.col(o)) for o, n in zip(comp, upd)})
        df = carry_forward(df, comp, ID, [WID], hot=hot)

    # merges of later-wave updates into the first-wave answers
    merged = {"Q38": first_present("Q38", "DQ38"), "Q47": first_present("Q47", "D6")}
    for d in columns_matching(df, r"^DHH2_[\d]+$"):
        base = d[1:]
        merged[base] = first_present(base, d) if base in df.columns else F.col(d)
    return df.withColumns(merged), verdicts


def full_columns(prep: DataFrame) -> list[Column]:
    cols = set(prep.columns)
    out = ["date", "tenure", "weight"]
    sel = [F.col(c) for c in out]
    sel += [sentinel_fill("Q1").alias("Q1"), sentinel_fill("Q2").alias("Q2")]
    names = ["Q3", "Q4new", "Q5new", "Q6new", "Q8v2part2", *numbered("Q9_bin", 1, 10),
             "Q9bv2part2", *numbered("Q9c_bin", 1, 10)]
    if "Q1a" in cols:
        names += ["Q1apart2", *existing(prep, numbered("Q9new2_bin", 1, 10))]
    names += columns_matching(prep, r"Q10_.*")
    names += ["Q11", "Q12new", "Q13new", "Q14new", "Q15", "Q16", "Q17new", "Q18new", "Q19",
              "Q20new", "Q21new", "Q22new", "Q23v2", "Q23v2part2", *columns_matching(prep, r"Q24_.*"),
              "Q25v2", "Q25v2part2", "Q26v2", "Q26v2part2", "Q27v2", "Q27v2part2", "Q28", "Q29",
              "Q30new", "Q31v2", "Q31v2part2", *columns_matching(prep, r"C1_.*"), "C2", "C2part2",
              "C3", "C3part2", *[q for q, *_ in NUMERACY], "Q32", "Q33", "Q34",
              *columns_matching(prep, r"Q35.*"), "Q36", "Q37", "Q38",
              *columns_matching(prep, r"^HH2_[\d]+$"), "Q41", "Q42", "Q43", "Q44",
              *columns_matching(prep, r"Q45new_.*"), "Q45b", "Q46",
              *existing(prep, ["QRA1", "QRA2"]), "Q47", "D1", "D3", "DSAME"]
    seen = set(out + ["Q1", "Q2"])
    for n in names:
        if n not in seen:
            sel.append(F.col(n))
            seen.add(n)
    return sel


def extract_columns(prep: DataFrame) -> list[Column]:
    cols = set(prep.columns)
    sel: list[Column] = [F.col("date"), F.col("tenure"), F.col("weight"),
                         sentinel_fill("Q1").alias("financial_past_12m"),
                         sentinel_fill("Q2").alias("financial_12m")]
    copies = dict(COPIES)
    sign_out = {out: v for d, _, v, out in SIGN_PAIRS if v in cols}

    def add(name, expr):
        sel.append(expr.alias(name))

    for name in ["prob_move_house", "prob_unrate_up", "prob_irate_up", "prob_stocks_up"]:
        add(name, F.col(copies[name]))
    add("infl_1y", F.col(sign_out["infl_1y"]))
    for s in ("mean", "var", "median", "iqr"):
        add(f"infl_1y_bin_{s}", F.col(copies[f"infl_1y_bin_{s}"]))
    add("infl_1y_bin_prob_defl", rescale("Q9_probdeflation", 100.0))
    add("infl_3y", F.col(sign_out["infl_3y"]))
    for s in ("mean", "var", "median", "iqr"):
        add(f"infl_3y_bin_{s}", F.col(copies[f"infl_3y_bin_{s}"]))
    add("infl_3y_bin_prob_defl", rescale("Q9c_probdeflation", 100.0))
    if "Q1a" in cols:
        add("infl_5y", F.col(sign_out["infl_5y"]))
    add("working", any_equals_flag(["Q10_1", "Q10_2"], 1, "smallint"))
    add("num_jobs", F.col("Q11"))
    add("self_employed", recode("Q12new", EMPLOYER, "int"))
    add("prob_lose_job", F.col("Q13new"))
    add("prob_leave_job", F.col("Q14new"))
    add("looking_for_job", equals_flag("Q15", 1, "int"))
    for name in ["prob_accept_job_12m", "prob_accept_job_3m"]:
        add(name, F.col(copies[name]))
    add("jobless_length", first_present("Q16", "Q19"))
    for name in ["prob_search_job_12m", "prob_search_job_3m"]:
        add(name, F.col(copies[name]))
    for out in ["earnings_change", "hh_inc_change", "hh_spending_change", "taxes_change"]:
        add(out, F.col(sign_out[out]))
    for name in ["credit_cond_past12m", "credit_cond_12m", "prob_miss_paym_3m"]:
        add(name, F.col(copies[name]))
    for out in ["house_price_change", "house_price_change_3y", "govt_debt_change"]:
        add(out, F.col(sign_out[out]))
    for raw, stem, right, tol in NUMERACY:
        add(stem, F.col(raw))
        add(f"{stem}_correct", score_answer(raw, right, tolerance=tol))
    add("age_init", F.col("Q32"))
    add("female", recode("Q33", YES_NO, "int"))
    add("hispanic", recode("Q34", YES_NO, "int"))
    add("black", F.col("Q35_2"))
    add("college", member_flag("Q36", COLLEGE_CODES))
    add("educ", recode("Q36", EDUC4, "int"))
    add("owner", recode("Q43", OWNER, "int"))
    add("health", try_cast("Q45b", "smallint"))
    if "QRA1" in cols:
        add("take_fin_risk", F.col("QRA1"))
    add("hh_changed", equals_flag("D1", 2, "smallint"))
    add("num_kids", row_sum(KIDS).try_cast("int"))
    add("same_employer", member_flag("DSAME", SAME_EMPLOYER_CODES))
    add("couple", recode("Q38", YES_NO, "int"))
    if "HH2_1" in cols and "HH2_2" in cols:
        add("spouse_working", any_equals_flag(["HH2_1", "HH2_2"], 1, "smallint"))
    add("hh_inc_bin", F.col("Q47").try_cast("int"))
    return sel


def build_survey_tables(raw: DataFrame, crosswalk: DataFrame | None = None,
                        checks: str = "raise", both: bool = False) -> SurveyTables:
    """Full and extract tables (keys ``userid``, ``wid`` as columns).

    With a ``crosswalk`` (year, ibin, lbound, rank), both tables get the
    income rank of their income bin: ``Q47_rank`` and ``hh_inc_bin_rank``.
    A caller that reads ``both`` tables, or one of them several times, has the
    prepared rows staged, so that they are tiled and carried once.
    """
    prep, verdicts = prepare(raw, checks)
    if both:
        prep = stage(prep, "survey-prepared")
    keys = [F.col(ID), F.col(WID)]
    full = prep.select(*keys, *full_columns(prep))
    extract = prep.select(*keys, *extract_columns(prep))
    if crosswalk is not None:
        cw = validated_crosswalk(crosswalk)
        full = _with_rank(full, "Q47", cw)
        extract = _with_rank(extract, "hh_inc_bin", cw)
    return SurveyTables(with_variable_labels(full, full_labels(full.columns)),
                        with_variable_labels(extract, {**KEY_LABELS, **EXTRACT_LABELS}), verdicts)


def _with_rank(df: DataFrame, bin_col: str, crosswalk: DataFrame) -> DataFrame:
    y = "_wp_ref_year"
    out = attach_rank(df.withColumn(y, reference_year("date")), crosswalk, bin_col, year_col=y)
    return out.drop(y)
