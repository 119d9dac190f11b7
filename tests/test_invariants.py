"""Invariants of SURVEY section 5 on the smallest test tables."""

from pyspark.sql import functions as F

import __spark_entry__ as entry
from wavepanel.operators.ranks import weighted_ecdf
from wavepanel.operators.signs import decide, flip_signs, negative_mask

SMOKE = "/root/testdata/sf0.001"


def test_ecdf_reaches_one_in_every_group(spark):
    o = spark.read.parquet(f"{SMOKE}/orders.parquet").withColumn("y", F.year("o_orderdate"))
    r = weighted_ecdf(o, "o_totalprice", F.col("o_orderkey") % 5 + 1, ["y"], "o_orderkey")
    per = r.groupBy("y").agg(F.max("rank").alias("m"), F.min("rank").alias("lo"))
    assert per.where("abs(m - 1.0) > 1e-12 or lo <= 0").count() == 0


def test_rank_lookup_keeps_every_row(spark):
    out = entry.queries()["rank_lookup"](spark, SMOKE)
    n = spark.read.parquet(f"{SMOKE}/orders.parquet").count()
    assert out.count() == n and out.select("o_orderkey").distinct().count() == n


def test_sign_correction_is_idempotent(spark):
    ev = spark.read.parquet(f"{SMOKE}/events.parquet").select("event_type", "value")
    pairs = {"value": ("value", negative_mask("event_type", "error"))}
    once = flip_signs(ev, pairs)
    assert decide(ev, pairs)["value"] == "flip"
    assert decide(once, pairs)["value"] == "correct"
    twice = flip_signs(once, pairs)
    a = sorted(r[0] for r in once.select("value").collect())
    b = sorted(r[0] for r in twice.select("value").collect())
    assert a == b


def test_carried_record_comes_from_the_same_person(spark):
    out = entry.queries()["carry_forward_record"](spark, SMOKE).where("a IS NOT NULL")
    p = (spark.read.parquet(f"{SMOKE}/events.parquet")
         .where("event_id % 3 = 0 AND event_id % 5 <> 0")
         .select("user_id", F.col("value").alias("a")))
    missing = out.join(p, ["user_id", "a"], "left_anti")
    assert missing.count() == 0
