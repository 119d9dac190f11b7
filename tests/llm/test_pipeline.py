"""The pipeline's stages one after another on the smallest tables."""

import corpus_pipeline
from pyspark.sql import functions as F

import __spark_entry__ as entry

SMOKE = "/root/testdata/sf0.001"


def test_stages(spark):
    docs = corpus_pipeline.read(spark, SMOKE, "documents")
    before = {r.doc_id for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = spark.createDataFrame(
            stage(spark, docs, SMOKE).collect(), docs.schema)
        assert docs.columns == corpus_pipeline.COLUMNS
        now = {r.doc_id for r in docs.collect()}
        assert now <= before and len(now) > 0.5 * len(before), name
        before = now
    pieces = corpus_pipeline.packing(spark, docs, SMOKE)
    assert {r.doc_id for r in pieces.collect()} == before
    assert pieces.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_registered():
    names = set(entry.queries())
    assert "pipeline" in names and {f"op{n}" for n in range(1, 11)} <= {x.split("_")[0] for x in names}
