"""The importer as named queries: the survey extract derived from
``events``, cleaned into the full and extract tables, with the income rank
looked up in the crosswalk built from ``orders`` (written and read back as
CSV, like the stored crosswalk).  The crosswalk's years are moved by
CROSSWALK_SHIFT, so that some survey years find it and some do not."""

from __future__ import annotations

from wavepanel.plans.catalogue import build_survey_tables
from wavepanel.plans.common import ORDER_VALUE_EDGES, order_weight, table
from wavepanel.plans.survey_raw import raw_sql, survey_raw
from wavepanel.operators.checks import codebook
from wavepanel.operators.diagnostics import to_long, wave_stats
from wavepanel.operators.ranks import rank_crosswalk
from wavepanel.session import scratch_dir
from wavepanel.sources.files import (read_crosswalk, read_panel, write_crosswalk_csv,
                                     write_panel)
from pyspark.sql import functions as F

# Years from an order to the crosswalk year it counts for.
CROSSWALK_SHIFT = 22


def _crosswalk(spark, sf_dir):
    o = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_totalprice", (F.year("o_orderdate") + CROSSWALK_SHIFT).alias("year"),
        order_weight().alias("w"))
    path = scratch_dir(spark, "crosswalk")
    write_crosswalk_csv(rank_crosswalk(o, "o_totalprice", "w", ["year"], "o_orderkey",
                                       edges=ORDER_VALUE_EDGES), path, ["year", "ibin", "lbound", "rank"])
    return read_crosswalk(spark, path)


def survey_full(spark, sf_dir):
    return build_survey_tables(survey_raw(spark, sf_dir), _crosswalk(spark, sf_dir)).full


def survey_extract(spark, sf_dir):
    return build_survey_tables(survey_raw(spark, sf_dir), _crosswalk(spark, sf_dir)).extract


def q_survey_raw(spark, sf_dir):
    return survey_raw(spark, sf_dir, materialise=False)


# Variables the diagnostics leave out (keys and the interview date).
DIAG_EXCLUDE = ("userid", "wid", "date")


def panel_store_reload(spark, sf_dir):
    """The full table stored by year of the interview and read back."""
    full = survey_full(spark, sf_dir).withColumn("wave_year", F.year("date"))
    path = scratch_dir(spark, "panel-full")
    write_panel(full, path, partition_by=["wave_year"])
    return read_panel(spark, path).select(*full.columns)


def extract_wave_stats(spark, sf_dir):
    """The diagnostics program on the stored extract: exact quartiles and the
    mean of every extract variable per wave, from value counts."""
    path = scratch_dir(spark, "panel-extract")
    write_panel(survey_extract(spark, sf_dir), path)
    ext = read_panel(spark, path)
    cols = [c for c in ext.columns if c not in DIAG_EXCLUDE]
    long = to_long(ext.select("userid", "wid", *cols), ["wid"], cols)
    q = wave_stats(long, "wid").drop("mean")
    # Mean from an exact integer sum (answers have at most 4 decimals), so
    # it does not depend on summation order; no rounding of the result.
    scaled = F.round(F.col("val") * 10000).cast("long")
    m = long.groupBy("wid", "variable").agg(
        (F.sum(scaled).cast("double") / 10000.0 / F.count("val")).alias("mean"))
    return q.join(m, ["wid", "variable"]).select(
        "wid", "variable", *[F.round(c, 6).alias(c) for c in ("p25", "p50", "p75")], "mean")


def panel_codebook(spark, sf_dir):
    """Both tables stored and read back: the label of every column, as it came
    with the files, and how many answers the column holds."""
    tables = build_survey_tables(survey_raw(spark, sf_dir), _crosswalk(spark, sf_dir), both=True)
    out = None
    for name, df in (("full", tables.full), ("extract", tables.extract)):
        path = scratch_dir(spark, f"labelled-{name}")
        write_panel(df, path)
        book = codebook(read_panel(spark, path)).select(
            F.lit(name).alias("table_name"), "variable", "label", "n_present", "n_missing")
        out = book if out is None else out.unionByName(book)
    return out


QUERIES = {"panel_codebook": panel_codebook, "survey_raw": q_survey_raw, "survey_full": survey_full, "survey_extract": survey_extract,
           "panel_store_reload": panel_store_reload, "extract_wave_stats": extract_wave_stats}
def _sql() -> dict[str, str]:
    from wavepanel.plans.importer_sql import (codebook_sql, extract_sql, extract_wave_stats_sql,
                                              full_sql)
    return {"panel_codebook": codebook_sql(), "survey_raw": raw_sql(), "survey_extract": extract_sql(), "survey_full": full_sql(),
            "panel_store_reload": f"SELECT *, CAST(year(date) AS INTEGER) AS wave_year FROM ({full_sql()}) f",
            "extract_wave_stats": extract_wave_stats_sql()}


SQL: dict[str, str] = _sql()
