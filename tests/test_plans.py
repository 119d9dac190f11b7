"""Plan shape: no Python evaluation in query plans, keyed windows stay keyed."""

import pytest

import __spark_entry__ as entry
from wavepanel.plans import all_queries

SMOKE = "/root/testdata/sf0.001"
NAMES = sorted(all_queries())


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", NAMES)
def test_no_python_udf_in_plan(spark, name):
    plan = _plan(entry.queries()[name](spark, SMOKE))
    for node in ("BatchEvalPython", "ArrowEvalPython", "MapInPandas", "MapInArrow", "FlatMapGroupsInPandas"):
        assert node not in plan, f"{name} runs Python: {node}"


@pytest.mark.parametrize("name", ["weighted_ecdf", "carry_forward_record", "rank_crosswalk",
                                  "wave_quartiles", "weighted_summary", "tile_constant"])
def test_keyed_windows_are_partitioned(spark, name):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = _plan(entry.queries()[name](spark, SMOKE))
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line and "windowspecdefinition(specifiedwindowframe" not in line:
            below = "\n".join(lines[i:i + 6])
            assert "SinglePartition" not in below, f"{name}: window over a single partition"


def test_ecdf_reads_only_needed_columns(spark):
    plan = _plan(entry.queries()["weighted_ecdf"](spark, SMOKE))
    assert "ReadSchema: struct<o_orderkey:bigint,o_totalprice:double,o_orderdate:timestamp_ntz>" in plan
