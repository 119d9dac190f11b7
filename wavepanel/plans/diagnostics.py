"""Named queries of the diagnostics program (counts, wave statistics,
outlier screening) and of the weighted statistics of the crosswalk program."""

from __future__ import annotations

from pyspark.sql import functions as F

from wavepanel.operators.checks import missing_report
from wavepanel.operators.diagnostics import (append_counts, coverage_reports, median_timestamp,
                                             nobs_histogram, nonmissing_counts, outlier_counts,
                                             outlier_flags, read_counts, to_long, trimmed_means,
                                             value_counts, wave_stats)
from wavepanel.operators.stats import (distinct_levels, extreme_values, weighted_mean_se,
                                       weighted_summary, weighted_tabulate)
from wavepanel.plans.common import PANEL_SQL, panel, table
from wavepanel.session import scratch_dir, stage

COUNT_VARS = ["value", "a", "b", "asked_once"]
WAVE_VARS = ["v", "a", "b"]


def _panel_v(spark, sf_dir):
    p = panel(spark, sf_dir, with_tenure=False)
    return p.withColumn("v", F.when(F.col("event_id") % 500 == 0, F.col("value") * 100000)
                              .otherwise(F.col("value")))


def nobs_by_person(spark, sf_dir):
    return nonmissing_counts(panel(spark, sf_dir), "user_id", COUNT_VARS)


def nobs_by_wave(spark, sf_dir):
    return nonmissing_counts(panel(spark, sf_dir), "wid", COUNT_VARS)


def q_nobs_histogram(spark, sf_dir):
    return nobs_histogram(panel(spark, sf_dir), "user_id", COUNT_VARS)


def q_missing_report(spark, sf_dir):
    return missing_report(panel(spark, sf_dir), COUNT_VARS)


def q_coverage_reports(spark, sf_dir):
    """The counts per person, per wave and per variable, from one scan."""
    r = coverage_reports(panel(spark, sf_dir), "user_id", "wid", COUNT_VARS)
    n = [f"n_{c}" for c in COUNT_VARS]
    parts = [t.select(F.lit(name).alias("report"), F.col(key).cast("long").alias("id"), "n_rows", *n)
             .unpivot(["report", "id", "n_rows"], n, "variable", "n_present")
             .select("report", "id", F.expr("substr(variable, 3)").alias("variable"), "n_present",
                     (F.col("n_rows") - F.col("n_present")).alias("n_missing"))
             for name, t, key in (("person", r.by_person, "user_id"), ("wave", r.by_wave, "wid"))]
    whole = r.missing.select(F.lit("all").alias("report"), F.lit(None).cast("long").alias("id"),
                             "variable", "n_present", "n_missing")
    return parts[0].unionByName(parts[1]).unionByName(whole)


def _long(spark, sf_dir):
    p = _panel_v(spark, sf_dir).select("event_id", "user_id", "wid", *WAVE_VARS)
    return to_long(p, ["wid"], WAVE_VARS)


def wave_quartiles(spark, sf_dir):
    s = wave_stats(_long(spark, sf_dir), "wid")
    return s.select("wid", "variable", *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75", "mean")])


def median_date(spark, sf_dir):
    ev = table(spark, sf_dir, "events").withColumn(
        "wid", (F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")).cast("int"))
    return median_timestamp(ev, "wid", "ts")


def outlier_mask(spark, sf_dir):
    counts = value_counts(_long(spark, sf_dir), "wid")
    return outlier_counts(outlier_flags(counts, "wid", freq="n"), "n")


def trimmed_wave_mean(spark, sf_dir):
    counts = value_counts(_long(spark, sf_dir), "wid")
    t = trimmed_means(outlier_flags(counts, "wid", freq="n"), "wid", freq="n")
    return t.withColumn("mean_trimmed", F.round("mean_trimmed", 6))


# Days whose events come with the first delivery; the second brings the rest,
# among them rows of days that the first one had begun.
FIRST_DELIVERY = "2024-01-16 12:00:00"


def wave_stats_stored(spark, sf_dir):
    """The diagnostics from stored counts: the first delivery's are kept, the
    second one's are added (twice, as after a failure) without rereading."""
    path = scratch_dir(spark, "stored-counts")
    p = _panel_v(spark, sf_dir).select("event_id", "ts", "wid", *WAVE_VARS)
    early = F.col("ts") < F.lit(FIRST_DELIVERY).cast("timestamp_ntz")
    for batch, rows in (("first", early), ("second", ~early), ("second", ~early)):
        append_counts(to_long(p.where(rows), ["wid"], WAVE_VARS, with_row_hash=False), path, batch, "wid")
    counts = stage(read_counts(spark, path, "wid"), "all-counts")
    flagged = outlier_flags(counts, "wid", freq="n")
    out = F.coalesce(F.sum(F.when(F.col("outlier"), F.col("n"))), F.lit(0)).alias("n_outliers")
    screened = flagged.groupBy("wid", "variable").agg(out, F.max("iqr").alias("iqr"))
    stats = (wave_stats(counts, "wid", freq="n").join(screened, ["wid", "variable"])
             .join(trimmed_means(flagged, "wid", freq="n"), ["wid", "variable"]))
    return stats.select("wid", "variable", "n_outliers", *[
        F.round(c, 6).alias(c) for c in ("p25", "p50", "p75", "mean", "iqr", "mean_trimmed")])


def q_extreme_values(spark, sf_dir):
    """The four least and greatest discounted prices per return flag."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_returnflag", F.col("l_quantity").cast("int").alias("w"),
        F.when(F.col("l_linenumber") != 3, F.col("l_extendedprice")).alias("x"))
    return extreme_values(li.withColumn("w", F.col("w") - 1), ["l_returnflag"], "x", "w")


def _lineitem(spark, sf_dir):
    return table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_returnflag", "l_discount", "l_quantity", "l_shipdate",
        F.col("l_quantity").cast("int").alias("w"))


def q_weighted_tabulate(spark, sf_dir):
    t = weighted_tabulate(_lineitem(spark, sf_dir), "l_returnflag", "w")
    return t.select("l_returnflag", "freq", F.round("percent", 6).alias("percent"),
                    F.round("cum_percent", 6).alias("cum_percent"))


def weighted_mean(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    m = weighted_mean_se(li, ["l_returnflag"], "l_discount", "w",
                         where=F.col("l_quantity").between(18, 27))
    return m.select("l_returnflag", "n", F.round("mean", 6).alias("mean"), F.round("se", 6).alias("se"))


def q_weighted_summary(spark, sf_dir):
    li = _lineitem(spark, sf_dir)
    tb = F.col("l_orderkey") * 10 + F.col("l_linenumber")
    parts = []
    for flag, w in ((0, None), (1, "w")):
        s = weighted_summary(li.withColumn("_tb", tb), ["l_returnflag"], "l_discount", w, "_tb")
        parts.append(s.withColumn("weighted", F.lit(flag)))
    out = parts[0].unionByName(parts[1])
    dbl = [c for c in out.columns if c not in ("l_returnflag", "weighted", "n")]
    return out.select("l_returnflag", "weighted", F.col("n").cast("double").alias("n"),
                      *[F.round(c, 6).alias(c) for c in dbl])


def weighted_summary_all(spark, sf_dir):
    """Of all rows, over a column with a large mean and a small spread."""
    li = _lineitem(spark, sf_dir).withColumn("x", F.col("l_discount") * 100 + 1e8)
    s = weighted_summary(li, [], "x", "w")
    dbl = [c for c in s.columns if c != "n"]
    return s.select(F.col("n").cast("double").alias("n"), *[F.round(c, 4).alias(c) for c in dbl])


def q_distinct_levels(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return distinct_levels(li, F.year("l_shipdate"), where=F.col("l_returnflag") == "R")


QUERIES = {
    "nobs_by_person": nobs_by_person,
    "nobs_by_wave": nobs_by_wave,
    "nobs_histogram": q_nobs_histogram,
    "missing_report": q_missing_report,
    "wave_quartiles": wave_quartiles,
    "median_date": median_date,
    "outlier_mask": outlier_mask,
    "trimmed_wave_mean": trimmed_wave_mean,
    "weighted_tabulate": q_weighted_tabulate,
    "weighted_mean": weighted_mean,
    "weighted_summary": q_weighted_summary,
    "weighted_summary_all": weighted_summary_all,
    "distinct_levels": q_distinct_levels,
    "coverage_reports": q_coverage_reports,
    "wave_stats_stored": wave_stats_stored,
    "extreme_values": q_extreme_values,
}

_COUNTS = ", ".join(f"count({c}) AS n_{c}" for c in COUNT_VARS)
_LONG = f"""
WITH {PANEL_SQL},
pv AS (SELECT wid, CASE WHEN event_id % 500 = 0 THEN value * 100000 ELSE value END AS v, a, b FROM panel),
u AS (SELECT wid, variable, val FROM (UNPIVOT pv ON v, a, b INTO NAME variable VALUE val))"""
_Q = """
q AS (SELECT wid, variable, quantile_cont(val, 0.25) AS q25, quantile_cont(val, 0.75) AS q75
      FROM u GROUP BY wid, variable),
f AS (SELECT u.wid, u.variable, u.val,
        coalesce((u.val > q.q25 + 100 * greatest(q.q75 - q.q25, 1.0))
              OR (u.val < q.q75 - 100 * greatest(q.q75 - q.q25, 1.0)), false) AS outlier
      FROM u JOIN q ON u.wid = q.wid AND u.variable = q.variable)"""


def _mom_sql(weighted: bool) -> str:
    w = "CAST(CAST(l_quantity AS INTEGER) AS DOUBLE)" if weighted else "1.0"
    return f"""
  SELECT l_returnflag, {1 if weighted else 0} AS weighted, sum(w) AS n,
    sum(w * x) / sum(w) AS mean,
    sum(w * (x - m) ^ 2) / (sum(w) - 1) AS variance,
    sqrt(sum(w * (x - m) ^ 2) / (sum(w) - 1)) AS sd,
    (sum(w * (x - m) ^ 3) / sum(w)) / ((sum(w * (x - m) ^ 2) / sum(w)) ^ 1.5) AS skewness,
    (sum(w * (x - m) ^ 4) / sum(w)) / ((sum(w * (x - m) ^ 2) / sum(w)) ^ 2) AS kurtosis
  FROM (SELECT l_returnflag, l_discount AS x, {w} AS w,
          sum({w} * l_discount) OVER (PARTITION BY l_returnflag) / sum({w}) OVER (PARTITION BY l_returnflag) AS m
        FROM lineitem) t
  GROUP BY l_returnflag"""


def _pct_sql(weighted: bool) -> str:
    w = "CAST(l_quantity AS INTEGER)" if weighted else "1"
    pcols = []
    for p in (1, 5, 10, 25, 50, 75, 90, 95, 99):
        a = f"max(CASE WHEN (cw - w) * 100 <= tw * {p} AND tw * {p} < cw * 100 THEN x END)"
        e = f"bool_or(CASE WHEN (cw - w) * 100 <= tw * {p} AND tw * {p} < cw * 100 THEN (cw - w) * 100 = tw * {p} END)"
        b = f"max(CASE WHEN cw * 100 = tw * {p} THEN x END)"
        pcols.append(f"CASE WHEN {e} THEN ({a} + {b}) / 2 ELSE {a} END AS p{p}")
    ext = []
    for i in range(4):
        ext.append(f"max(CASE WHEN pos = {i} THEN x END) AS smallest{i + 1}")
    for i in range(4):
        ext.append(f"max(CASE WHEN pos = tn - 1 - {i} THEN x END) AS largest{i + 1}")
    return f"""
  SELECT l_returnflag, {1 if weighted else 0} AS weighted, {", ".join(pcols)}, {", ".join(ext)}
  FROM (SELECT l_returnflag, l_discount AS x, CAST({w} AS BIGINT) AS w,
          sum(CAST({w} AS BIGINT)) OVER (PARTITION BY l_returnflag ORDER BY l_discount, l_orderkey * 10 + l_linenumber
                 ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS cw,
          sum(CAST({w} AS BIGINT)) OVER (PARTITION BY l_returnflag) AS tw,
          row_number() OVER (PARTITION BY l_returnflag ORDER BY l_discount, l_orderkey * 10 + l_linenumber) - 1 AS pos,
          count(*) OVER (PARTITION BY l_returnflag) AS tn
        FROM lineitem) t
  GROUP BY l_returnflag"""


_SUMMARY_COLS = (["mean", "variance", "sd", "skewness", "kurtosis"]
                 + [f"p{p}" for p in (1, 5, 10, 25, 50, 75, 90, 95, 99)]
                 + [f"smallest{i}" for i in range(1, 5)] + [f"largest{i}" for i in range(1, 5)])

SQL = {
    "nobs_by_person": f"WITH {PANEL_SQL} SELECT user_id, {_COUNTS} FROM panel GROUP BY user_id",
    "nobs_by_wave": f"WITH {PANEL_SQL} SELECT wid, {_COUNTS} FROM panel GROUP BY wid",
    "nobs_histogram": f"""
WITH {PANEL_SQL},
pp AS (SELECT user_id, count(*) AS rows_, {", ".join(f"count({c}) AS {c}" for c in COUNT_VARS)}
       FROM panel GROUP BY user_id),
nm AS (SELECT max(rows_) AS nmax FROM pp),
u AS (SELECT variable, n FROM (UNPIVOT (SELECT user_id, {", ".join(COUNT_VARS)} FROM pp)
      ON {", ".join(COUNT_VARS)} INTO NAME variable VALUE n))
SELECT variable, least(n, (SELECT nmax FROM nm) - 1) AS bin, count(*) AS n_persons
FROM u GROUP BY ALL""",
    "missing_report": f"WITH {PANEL_SQL} " + " UNION ALL ".join(
        f"SELECT '{c}' AS variable, count({c}) AS n_present, "
        f"CAST(count_if({c} IS NULL) AS BIGINT) AS n_missing FROM panel" for c in COUNT_VARS),
    "wave_quartiles": f"""{_LONG}
SELECT wid, variable, round(quantile_cont(val, 0.25), 6) AS p25, round(quantile_cont(val, 0.5), 6) AS p50,
  round(quantile_cont(val, 0.75), 6) AS p75, round(avg(val), 6) AS mean
FROM u GROUP BY wid, variable""",
    "median_date": """
SELECT wid, median_us, make_timestamp(CAST(floor(median_us) AS BIGINT)) AS median_ts
FROM (SELECT CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS wid,
        quantile_cont(epoch_us(ts), 0.5) AS median_us
      FROM events GROUP BY 1) t""",
    "outlier_mask": f"""{_LONG}, {_Q}
SELECT variable, CAST(count_if(outlier) AS BIGINT) AS n_outliers FROM f
GROUP BY variable HAVING count_if(outlier) > 0""",
    "trimmed_wave_mean": f"""{_LONG}, {_Q}
SELECT wid, variable, round(avg(CASE WHEN NOT outlier THEN val END), 6) AS mean_trimmed
FROM f GROUP BY wid, variable""",
    "weighted_tabulate": """
SELECT l_returnflag, freq, round(freq * 100.0 / sum(freq) OVER (), 6) AS percent,
  round(sum(freq) OVER (ORDER BY l_returnflag ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) * 100.0
        / sum(freq) OVER (), 6) AS cum_percent
FROM (SELECT l_returnflag, CAST(sum(CAST(l_quantity AS INTEGER)) AS BIGINT) AS freq
      FROM lineitem GROUP BY l_returnflag) t""",
    "weighted_mean": """
WITH s AS (SELECT l_returnflag, l_discount AS x, CAST(CAST(l_quantity AS INTEGER) AS DOUBLE) AS w
           FROM lineitem WHERE l_quantity BETWEEN 18 AND 27),
m AS (SELECT l_returnflag, count(*) AS n, sum(w) AS tw, sum(w * x) / sum(w) AS mean FROM s GROUP BY l_returnflag)
SELECT m.l_returnflag, m.n, round(m.mean, 6) AS mean,
  round(sqrt(m.n / (m.n - 1.0) * sum((s.w / m.tw) ^ 2 * (s.x - m.mean) ^ 2)), 6) AS se
FROM s JOIN m ON s.l_returnflag = m.l_returnflag
GROUP BY m.l_returnflag, m.n, m.mean, m.tw""",
    "weighted_summary": f"""
WITH mo AS ({_mom_sql(False)} UNION ALL {_mom_sql(True)}),
pc AS ({_pct_sql(False)} UNION ALL {_pct_sql(True)})
SELECT mo.l_returnflag, mo.weighted, CAST(mo.n AS DOUBLE) AS n,
  {", ".join(f"round({'mo' if c in ('mean', 'variance', 'sd', 'skewness', 'kurtosis') else 'pc'}.{c}, 6) AS {c}" for c in _SUMMARY_COLS)}
FROM mo JOIN pc ON mo.l_returnflag = pc.l_returnflag AND mo.weighted = pc.weighted""",
    "weighted_summary_all": f"""
WITH li AS (SELECT 'all' AS l_returnflag, l_discount * 100 + 1e8 AS l_discount, l_quantity, l_orderkey,
              l_linenumber FROM lineitem),
mo AS ({_mom_sql(True).replace("FROM lineitem", "FROM li")}),
pc AS ({_pct_sql(True).replace("FROM lineitem", "FROM li")})
SELECT CAST(mo.n AS DOUBLE) AS n,
  {", ".join(f"round({'mo' if c in ('mean', 'variance', 'sd', 'skewness', 'kurtosis') else 'pc'}.{c}, 4) AS {c}" for c in _SUMMARY_COLS)}
FROM mo JOIN pc ON mo.l_returnflag = pc.l_returnflag""",
    "coverage_reports": f"WITH {PANEL_SQL} " + " UNION ALL ".join(
        f"SELECT '{name}' AS report, CAST({key} AS BIGINT) AS id, '{c}' AS variable, count({c}) AS n_present, "
        f"CAST(count_if({c} IS NULL) AS BIGINT) AS n_missing FROM panel {group}"
        for name, key, group in (("person", "user_id", "GROUP BY user_id"), ("wave", "wid", "GROUP BY wid"),
                                 ("all", "NULL", "")) for c in COUNT_VARS),
    "wave_stats_stored": f"""{_LONG}, {_Q}
SELECT wid, variable, CAST(count_if(outlier) AS BIGINT) AS n_outliers,
  round(quantile_cont(val, 0.25), 6) AS p25, round(quantile_cont(val, 0.5), 6) AS p50,
  round(quantile_cont(val, 0.75), 6) AS p75, round(avg(val), 6) AS mean,
  round(greatest(quantile_cont(val, 0.75) - quantile_cont(val, 0.25), 1.0), 6) AS iqr,
  round(avg(CASE WHEN NOT outlier THEN val END), 6) AS mean_trimmed
FROM f GROUP BY wid, variable""",
    "extreme_values": f"""
WITH s AS (SELECT l_returnflag, l_extendedprice AS x,
             row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice) AS up,
             row_number() OVER (PARTITION BY l_returnflag ORDER BY l_extendedprice DESC) AS down
           FROM lineitem
           WHERE l_linenumber <> 3 AND l_extendedprice IS NOT NULL AND CAST(l_quantity AS INTEGER) > 1)
SELECT l_returnflag, {", ".join(f"max(CASE WHEN up = {i} THEN x END) AS smallest{i}" for i in range(1, 5))},
  {", ".join(f"max(CASE WHEN down = {i} THEN x END) AS largest{i}" for i in range(1, 5))}
FROM s GROUP BY l_returnflag""",
    "distinct_levels": """
SELECT DISTINCT CAST(year(l_shipdate) AS INTEGER) AS level FROM lineitem WHERE l_returnflag = 'R'""",
}
