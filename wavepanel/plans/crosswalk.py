"""Named queries of the rank-crosswalk program on the test tables.

``orders`` stands in for the person microdata: group = year of
``o_orderdate``, income = ``o_totalprice``, frequency weight
``1 + o_orderkey % 5``, tie-break ``o_orderkey``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from pyspark.sql import types as T

from wavepanel.functions.columns import clamp_low, cut, cut_index, interval_recode, reference_year
from wavepanel.operators.ranks import (attach_rank, key_duplicates, rank_crosswalk,
                                       small_cell_filter, weighted_ecdf)
from wavepanel.plans.common import (ACCTBAL_EDGES, ORDER_VALUE_EDGES, order_weight,
                                    sql_cut, sql_cut_index, table)
from wavepanel.sources.files import read_crosswalk, write_crosswalk_csv
from wavepanel.session import scratch_dir, stage

SMALL_CELL_MIN = 400

# By-college crosswalk for a young age range, on orders: educ = o_custkey % 12,
# age = 18 + (o_custkey // 7) % 60 (not tied to educ), order values in [450000, 460000] act as the
# "not available" income codes.
AGE_MIN, AGE_MAX = 18, 27
ADULT = 18
NA_CODES = (450000.0, 460000.0)
COLLEGE_CELL_MIN = 100


def _orders(spark, sf_dir):
    return (table(spark, sf_dir, "orders")
            .select("o_orderkey", "o_totalprice", "o_orderdate", "o_orderpriority",
                    F.year("o_orderdate").alias("year"), order_weight().alias("w")))


def cut_bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = table(spark, sf_dir, "customer")
    x = clamp_low("c_acctbal", 0.0)
    return c.select("c_custkey", x.alias("acctbal"), cut(x, ACCTBAL_EDGES).alias("lbound"))


def weighted_ecdf_rows(spark, sf_dir):
    o = _orders(spark, sf_dir)
    r = weighted_ecdf(o, "o_totalprice", "w", ["year"], "o_orderkey", ties="rows")
    return r.select("o_orderkey", "year", F.round("rank", 6).alias("rank"))


def weighted_ecdf_equal(spark, sf_dir):
    o = _orders(spark, sf_dir)
    r = weighted_ecdf(o, "o_totalprice", "w", ["year"], "o_orderkey", ties="equal")
    return r.select("o_orderkey", "year", F.round("rank", 6).alias("rank"))


def _crosswalk(spark, sf_dir, cells=(), count_col=None):
    o = _orders(spark, sf_dir)
    return rank_crosswalk(o, "o_totalprice", "w", ["year", *cells], "o_orderkey",
                          edges=ORDER_VALUE_EDGES, count_col=count_col)


def q_rank_crosswalk(spark, sf_dir):
    cw = _crosswalk(spark, sf_dir)
    return cw.withColumn("rank", F.round("rank", 6))


def rank_crosswalk_equal(spark, sf_dir):
    """Equal incomes share one rank; incomes in whole thousands, so that ties
    are the rule."""
    o = _orders(spark, sf_dir).withColumn("income", F.floor(F.col("o_totalprice") / 1000) * 1000.0)
    cw = rank_crosswalk(o, "income", "w", ["year"], "o_orderkey", edges=ORDER_VALUE_EDGES,
                        ties="equal", count_col="nobs")
    return cw.withColumn("rank", F.round("rank", 6))


def crosswalk_export(spark, sf_dir):
    """Write the crosswalk as one CSV (year, ibin, lbound, rank to 3 places)
    and read it back with a fixed schema."""
    path = scratch_dir(spark, "crosswalk")
    write_crosswalk_csv(_crosswalk(spark, sf_dir), path, ["year", "ibin", "lbound", "rank"])
    return read_crosswalk(spark, path)


def rank_crosswalk_cells(spark, sf_dir):
    cw = _crosswalk(spark, sf_dir, cells=["o_orderpriority"], count_col="nobs")
    return cw.withColumn("rank", F.round("rank", 6))


def q_small_cell_filter(spark, sf_dir):
    cw = _crosswalk(spark, sf_dir, cells=["o_orderpriority"], count_col="nobs")
    kept = small_cell_filter(cw, ["year", "o_orderpriority"], "nobs", SMALL_CELL_MIN)
    return kept.withColumn("rank", F.round("rank", 6))


def rank_crosswalk_college(spark, sf_dir):
    """Crosswalk by (year, college) for ages AGE_MIN..AGE_MAX: education
    recoded to a college flag, special income codes set missing, small cells
    (< COLLEGE_CELL_MIN ranked people over all bins) dropped, exported as CSV
    (year, college, ibin, lbound, rank to 3 places, nobs) and read back."""
    o = table(spark, sf_dir, "orders")
    micro = o.select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), order_weight().alias("w"),
        interval_recode(F.col("o_custkey") % 12, [(0, 9, 0), (10, 11, 1)]).cast("int").alias("college"),
        (F.floor(F.col("o_custkey") / 7) % 60 + 18).cast("int").alias("age"))
    young = micro.where(F.col("age").between(AGE_MIN, AGE_MAX))
    cw = rank_crosswalk(young, "o_totalprice", "w", ["year", "college"], "o_orderkey",
                        edges=ORDER_VALUE_EDGES, missing_codes=NA_CODES, count_col="nobs")
    kept = small_cell_filter(cw, ["year", "college"], "nobs", COLLEGE_CELL_MIN)
    path = scratch_dir(spark, "crosswalk-college")
    write_crosswalk_csv(kept, path, ["year", "college", "ibin", "lbound", "rank", "nobs"])
    return read_crosswalk(spark, path, COLLEGE_CROSSWALK_SCHEMA)


def rank_crosswalk_adults(spark, sf_dir):
    """Pooled crosswalk of adults and of people whose age is missing, which
    the original's "18 or above" does not drop."""
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", F.year("o_orderdate").alias("year"), order_weight().alias("w"),
        F.when(F.col("o_custkey") % 11 != 0, 10 + F.floor(F.col("o_custkey") / 7) % 60).alias("age"))
    adults = o.where((F.col("age") >= ADULT) | F.col("age").isNull())
    cw = rank_crosswalk(adults, "o_totalprice", "w", ["year"], "o_orderkey",
                        edges=ORDER_VALUE_EDGES, count_col="nobs")
    return cw.withColumn("rank", F.round("rank", 6))


def max_bin_index(spark, sf_dir):
    """Largest bin index present per year, and overall (the axis range of
    the crosswalk chart)."""
    per_year = stage(_crosswalk(spark, sf_dir).groupBy("year").agg(F.max("ibin").alias("max_ibin")),
                     "max-bins")
    overall = per_year.select(F.max("max_ibin")).scalar()
    return per_year.select("year", "max_ibin", overall.alias("max_ibin_all"))


def rank_lookup(spark, sf_dir):
    """Reference year + income bin of every order, joined (left, m:1) to the
    crosswalk as stored on disk (rank to 3 places, rescaled to 0-100)."""
    path = scratch_dir(spark, "crosswalk")
    write_crosswalk_csv(_crosswalk(spark, sf_dir), path, ["year", "ibin", "lbound", "rank"])
    cw = read_crosswalk(spark, path)
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", reference_year("o_orderdate").alias("ref_year"),
        cut_index("o_totalprice", ORDER_VALUE_EDGES).alias("inc_bin"))
    out = attach_rank(o, cw, "inc_bin", year_col="ref_year", rank_name="inc_bin_rank")
    return out.select("o_orderkey", "ref_year", "inc_bin",
                      F.round("inc_bin_rank", 6).alias("inc_bin_rank"))


def q_reference_year(spark, sf_dir):
    o = table(spark, sf_dir, "orders")
    return o.select("o_orderkey", "o_orderdate", reference_year("o_orderdate").alias("ref_year"))


def join_key_duplicates(spark, sf_dir):
    li = table(spark, sf_dir, "lineitem")
    return key_duplicates(li, ["l_orderkey", "l_linenumber"], "n")


COLLEGE_CROSSWALK_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()), T.StructField("college", T.IntegerType()),
    T.StructField("ibin", T.IntegerType()), T.StructField("lbound", T.DoubleType()),
    T.StructField("rank", T.DoubleType()), T.StructField("nobs", T.LongType())])

QUERIES = {
    "cut_bins": cut_bins,
    "weighted_ecdf": weighted_ecdf_rows,
    "weighted_ecdf_equal": weighted_ecdf_equal,
    "rank_crosswalk": q_rank_crosswalk,
    "rank_crosswalk_adults": rank_crosswalk_adults,
    "rank_crosswalk_equal": rank_crosswalk_equal,
    "crosswalk_export": crosswalk_export,
    "rank_crosswalk_cells": rank_crosswalk_cells,
    "small_cell_filter": q_small_cell_filter,
    "rank_crosswalk_college": rank_crosswalk_college,
    "rank_lookup": rank_lookup,
    "max_bin_index": max_bin_index,
    "reference_year": q_reference_year,
    "join_key_duplicates": join_key_duplicates,
}

# --- DuckDB oracles ----------------------------------------------------------

_ECDF_ROWS = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  round(sum(1 + o_orderkey % 5) OVER (PARTITION BY year(o_orderdate)
          ORDER BY o_totalprice, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        / sum(1 + o_orderkey % 5) OVER (PARTITION BY year(o_orderdate)), 6) AS rank
FROM orders"""

_ECDF_EQUAL = """
SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year,
  round(sum(1 + o_orderkey % 5) OVER (PARTITION BY year(o_orderdate)
          ORDER BY o_totalprice RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
        / sum(1 + o_orderkey % 5) OVER (PARTITION BY year(o_orderdate)), 6) AS rank
FROM orders"""


def _sql_crosswalk(cells: str = "", with_count: bool = False) -> str:
    cell_cols = f", {cells}" if cells else ""
    part = f"year(o_orderdate){cell_cols}"
    lb = sql_cut("greatest(0, o_totalprice)", ORDER_VALUE_EDGES)
    cnt = ", CAST(count(rank) AS BIGINT) AS nobs" if with_count else ""
    return f"""
WITH r AS (
  SELECT CAST(year(o_orderdate) AS INTEGER) AS year{cell_cols}, o_totalprice,
    sum(1 + o_orderkey % 5) OVER (PARTITION BY {part}
        ORDER BY o_totalprice, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      / sum(1 + o_orderkey % 5) OVER (PARTITION BY {part}) AS rank
  FROM orders),
b AS (SELECT *, {lb} AS lbound FROM r),
m AS (SELECT year{cell_cols}, lbound, median(rank) AS rank{cnt}
      FROM b WHERE lbound IS NOT NULL GROUP BY ALL)
SELECT year{cell_cols},
  CAST(row_number() OVER (PARTITION BY year{cell_cols} ORDER BY lbound) AS INTEGER) AS ibin,
  lbound, rank{", nobs" if with_count else ""}
FROM m"""


def _round_rank(inner: str, digits: int = 6) -> str:
    return f"SELECT * REPLACE (round(rank, {digits}) AS rank) FROM ({inner}) q"


_COLLEGE = f"""
WITH m AS (
  SELECT o_orderkey, CAST(year(o_orderdate) AS INTEGER) AS year, 1 + o_orderkey % 5 AS w,
    CAST(CASE WHEN o_custkey % 12 BETWEEN 0 AND 9 THEN 0 WHEN o_custkey % 12 BETWEEN 10 AND 11 THEN 1
              ELSE o_custkey % 12 END AS INTEGER) AS college,
    CASE WHEN o_totalprice BETWEEN {NA_CODES[0]!r} AND {NA_CODES[1]!r} THEN NULL ELSE o_totalprice END AS x
  FROM orders WHERE (o_custkey // 7) % 60 + 18 BETWEEN {AGE_MIN} AND {AGE_MAX}),
r AS (
  SELECT year, college, x,
    CASE WHEN x IS NOT NULL THEN
      sum(CASE WHEN x IS NOT NULL THEN w ELSE 0 END) OVER (PARTITION BY year, college
          ORDER BY x NULLS FIRST, o_orderkey ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
      / sum(CASE WHEN x IS NOT NULL THEN w END) OVER (PARTITION BY year, college) END AS rank
  FROM m),
b AS (SELECT *, {sql_cut('greatest(0, coalesce(x, 0))', ORDER_VALUE_EDGES)} AS lbound FROM r),
c AS (SELECT year, college, lbound, median(rank) AS rank, CAST(count(rank) AS BIGINT) AS nobs
      FROM b WHERE lbound IS NOT NULL GROUP BY ALL),
i AS (SELECT *, CAST(row_number() OVER (PARTITION BY year, college ORDER BY lbound) AS INTEGER) AS ibin,
        sum(nobs) OVER (PARTITION BY year, college) AS cell_total FROM c)
SELECT year, college, ibin, lbound, round(rank, 3) AS rank, nobs FROM i WHERE cell_total >= {COLLEGE_CELL_MIN}"""

SQL = {
    "rank_crosswalk_college": _COLLEGE,
    "max_bin_index": f"""
SELECT year, max(ibin) AS max_ibin, max(max(ibin)) OVER () AS max_ibin_all
FROM ({_sql_crosswalk()}) c GROUP BY year""",
    "cut_bins": f"""
SELECT c_custkey, greatest(0, c_acctbal) AS acctbal,
  {sql_cut('greatest(0, c_acctbal)', ACCTBAL_EDGES)} AS lbound
FROM customer""",
    "weighted_ecdf": _ECDF_ROWS,
    "weighted_ecdf_equal": _ECDF_EQUAL,
    "rank_crosswalk": _round_rank(_sql_crosswalk()),
    "rank_crosswalk_adults": _round_rank(_sql_crosswalk(with_count=True).replace("FROM orders)", f"""
  FROM (SELECT *, CASE WHEN o_custkey % 11 <> 0 THEN 10 + (o_custkey // 7) % 60 END AS age FROM orders) o
  WHERE age >= {ADULT} OR age IS NULL)""")),
    "rank_crosswalk_equal": f"""
SELECT year, CAST(row_number() OVER (PARTITION BY year ORDER BY lbound) AS INTEGER) AS ibin,
  lbound, round(median(rank), 6) AS rank, count(*) AS nobs
FROM (SELECT year, rank, {sql_cut('x', ORDER_VALUE_EDGES)} AS lbound
      FROM (SELECT CAST(year(o_orderdate) AS INTEGER) AS year, floor(o_totalprice / 1000) * 1000.0 AS x,
              sum(1 + o_orderkey % 5) OVER (PARTITION BY year(o_orderdate)
                ORDER BY floor(o_totalprice / 1000) RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)
              / sum(1 + o_orderkey % 5) OVER (PARTITION BY year(o_orderdate)) AS rank
            FROM orders) a) b
WHERE lbound IS NOT NULL GROUP BY year, lbound""",
    "crosswalk_export": _round_rank(_sql_crosswalk(), 3),
    "rank_crosswalk_cells": _round_rank(_sql_crosswalk("o_orderpriority", True)),
    "small_cell_filter": f"""
SELECT year, o_orderpriority, ibin, lbound, round(rank, 6) AS rank, nobs FROM (
  SELECT *, sum(nobs) OVER (PARTITION BY year, o_orderpriority) AS tot
  FROM ({_sql_crosswalk("o_orderpriority", True)}) c) s
WHERE tot >= {SMALL_CELL_MIN}""",
    "rank_lookup": f"""
WITH cw AS ({_sql_crosswalk()}),
o AS (
  SELECT o_orderkey,
    CAST(year(o_orderdate) - CASE WHEN month(CASE WHEN day(o_orderdate) = 1
           THEN date_trunc('month', o_orderdate) - INTERVAL 1 MONTH
           ELSE date_trunc('month', o_orderdate) END) <= 6 THEN 1 ELSE 0 END AS INTEGER) AS ref_year,
    {sql_cut_index('o_totalprice', ORDER_VALUE_EDGES)} AS inc_bin
  FROM orders)
SELECT o.o_orderkey, o.ref_year, o.inc_bin,
  round(CASE WHEN (SELECT max(round(rank, 3)) FROM cw) <= 1.0
             THEN round(cw.rank, 3) * 100.0 ELSE round(cw.rank, 3) END, 6) AS inc_bin_rank
FROM o LEFT JOIN cw ON o.ref_year = cw.year AND o.inc_bin = cw.ibin""",
    "reference_year": """
SELECT o_orderkey, o_orderdate,
  CAST(year(o_orderdate) - CASE WHEN month(CASE WHEN day(o_orderdate) = 1
         THEN date_trunc('month', o_orderdate) - INTERVAL 1 MONTH
         ELSE date_trunc('month', o_orderdate) END) <= 6 THEN 1 ELSE 0 END AS INTEGER) AS ref_year
FROM orders""",
    "join_key_duplicates": """
SELECT l_orderkey, l_linenumber, count(*) AS n
FROM lineitem GROUP BY l_orderkey, l_linenumber HAVING count(*) > 1""",
}
