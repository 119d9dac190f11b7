"""Shared pieces of the named queries: table access, the panel view of
``events``, and SQL text helpers for the DuckDB oracles."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


# Fixed values of the test recipes: 50k-wide order-value bins
# with an open top edge, and 1000-wide account-balance bins.
ORDER_VALUE_EDGES = [0, 50000, 100000, 150000, 200000, 250000, 300000, 350000,
                     400000, 450000, 1e20]
ACCTBAL_EDGES = [0, 1000, 2000, 3000, 4000, 5000, 6000, 7000, 8000, 9000, 1e20]


def order_weight():
    return F.lit(1) + F.col("o_orderkey") % 5


def panel(spark: SparkSession, sf_dir: str, with_tenure: bool = True) -> DataFrame:
    """Panel view of ``events``: person ``user_id``, order ``(ts, event_id)``.

    ``tenure`` (1 = first row of the person) is a running count, computed
    with the skew-safe running aggregate (skipped with ``with_tenure=False``);
    ``wid`` is the day as yyyymmdd.
    Sparse answers are derived by rule: ``asked_once`` only on the first row,
    ``a`` on every third event, ``b`` on four events out of five.
    """
    from wavepanel.operators.segments import running

    ev = table(spark, sf_dir, "events").withColumns({
        "wid": (F.year("ts") * 10000 + F.month("ts") * 100 + F.dayofmonth("ts")).cast("int"),
        "a": F.when(F.col("event_id") % 3 == 0, F.col("value")),
        "b": F.when(F.col("event_id") % 5 != 0, F.col("value")),
    })
    if not with_tenure:      # queries that never look at the first wave skip the running count
        return ev
    ev = running(ev, ["user_id"], ["ts", "event_id"], {"tenure": ("sum", F.lit(1))})
    return ev.withColumns({"tenure": F.col("tenure").cast("long")}).withColumn(
        "asked_once", F.when(F.col("tenure") == 1, F.col("value")))


PANEL_SQL = """
panel AS (
  SELECT *,
    CASE WHEN tenure = 1 THEN value END AS asked_once,
    CASE WHEN event_id % 3 = 0 THEN value END AS a,
    CASE WHEN event_id % 5 <> 0 THEN value END AS b
  FROM (
    SELECT *,
      CAST(row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS BIGINT) AS tenure,
      CAST(year(ts) * 10000 + month(ts) * 100 + day(ts) AS INTEGER) AS wid
    FROM events) t
)"""


def sql_cut(x: str, edges: Sequence[float]) -> str:
    parts = [f"CASE WHEN {x} < {float(edges[0])!r} THEN NULL"]
    for lo, hi in zip(edges[:-1], edges[1:]):
        parts.append(f"WHEN {x} < {float(hi)!r} THEN CAST({float(lo)!r} AS DOUBLE)")
    parts.append("END")
    return " ".join(parts)


def sql_cut_index(x: str, edges: Sequence[float]) -> str:
    parts = [f"CASE WHEN {x} < {float(edges[0])!r} THEN NULL"]
    for i, hi in enumerate(edges[1:], start=1):
        parts.append(f"WHEN {x} < {float(hi)!r} THEN {i}")
    parts.append("END")
    return " ".join(parts)
