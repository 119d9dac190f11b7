"""Named queries of the panel core on the ``events`` panel view:
sign verdicts, tiling, carrying records forward, skip-logic checks."""

from __future__ import annotations

from pyspark.sql import functions as F

from wavepanel.functions.columns import family_overwrite
from wavepanel.operators.checks import implies_missing, rule_violations
from wavepanel.operators.panel import (carry_forward, complete_rows, spell_lengths,
                                       tile, tile_violations)
from wavepanel.operators.signs import flip_signs, negative_mask, sign_verdicts
from wavepanel.plans.common import PANEL_SQL, panel, table
from wavepanel.session import scratch_dir
from wavepanel.sources.files import write_bucketed_panel

# Buckets of the stored panel (a cluster takes about one per 128 MB).
PANEL_BUCKETS = 16


def _sign_input(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    neg = F.coalesce(F.col("event_type") == "error", F.lit(False))
    return ev.select(
        "event_id", "event_type",
        F.when(neg, -F.col("value")).otherwise(F.col("value")).alias("s_correct"),
        F.col("value").alias("s_flip"),
        F.when(F.col("event_id") % 2 == 0, -F.col("value")).otherwise(F.col("value")).alias("s_ambig"))


def _pairs():
    neg = negative_mask("event_type", "error")
    return {"s_correct": ("s_correct", neg), "s_flip": ("s_flip", neg), "s_ambig": ("s_ambig", neg)}


def sign_verdict(spark, sf_dir):
    return sign_verdicts(_sign_input(spark, sf_dir), _pairs())


def sign_flip(spark, sf_dir):
    return flip_signs(_sign_input(spark, sf_dir), _pairs()).select(
        "event_id", "s_correct", "s_flip", "s_ambig")


def tile_constant(spark, sf_dir):
    p = panel(spark, sf_dir).select("event_id", "user_id", "asked_once")
    return tile(p, ["asked_once"], "user_id").select("event_id", "user_id", "asked_once")


def q_tile_violations(spark, sf_dir):
    return tile_violations(panel(spark, sf_dir, with_tenure=False), "a", "user_id", "n")


def carry_forward_record(spark, sf_dir):
    p = panel(spark, sf_dir, with_tenure=False).select("event_id", "user_id", "ts", "a", "b")
    return carry_forward(p, ["a", "b"], "user_id", ["ts", "event_id"]).select(
        "event_id", "user_id", "a", "b")


def stored_panel_clean(spark, sf_dir):
    """The panel stored in buckets by person, then cleaned: tiled and carried
    forward without moving a row."""
    path = scratch_dir(spark, "bucketed-panel")
    name = path.rsplit("/", 1)[1].replace("-", "_")
    p = panel(spark, sf_dir).select("event_id", "user_id", "ts", "asked_once", "a", "b")
    stored = write_bucketed_panel(p, name, path, "user_id", "ts", PANEL_BUCKETS)
    out = carry_forward(tile(stored, ["asked_once"], "user_id"), ["a", "b"], "user_id",
                        ["ts", "event_id"])
    spark.sql(f"DROP TABLE {name}")                    # of the catalogue; the files stay
    return out.select("event_id", "user_id", "asked_once", "a", "b")


def q_complete_rows(spark, sf_dir):
    p = panel(spark, sf_dir, with_tenure=False)
    return complete_rows(p.select("event_id", "user_id", "a", "b"), ["a", "b"])


def q_family_overwrite(spark, sf_dir):
    p = panel(spark, sf_dir, with_tenure=False).withColumns({
        "c1": F.when(F.col("event_id") % 2 == 0, F.col("value")),
        "c2": F.col("value") * 2})
    flag = F.col("event_type") == "purchase"
    return p.select("event_id", *family_overwrite(flag, ["a", "b"], ["c1", "c2"]))


def skip_logic_violations(spark, sf_dir):
    p = panel(spark, sf_dir, with_tenure=False).withColumn("cond", F.when(F.col("event_id") % 3 == 0, F.lit(1)))
    rules = {"a_requires_cond": implies_missing("cond", 1, "a"),
             "b_requires_cond": implies_missing("cond", 1, "b")}
    return rule_violations(p, rules, ["event_id", "user_id"])


def q_spell_lengths(spark, sf_dir):
    return spell_lengths(table(spark, sf_dir, "events"), "user_id")


QUERIES = {
    "sign_verdict": sign_verdict,
    "sign_flip": sign_flip,
    "tile_constant": tile_constant,
    "tile_violations": q_tile_violations,
    "carry_forward_record": carry_forward_record,
    "stored_panel_clean": stored_panel_clean,
    "complete_rows": q_complete_rows,
    "family_overwrite": q_family_overwrite,
    "skip_logic_violations": skip_logic_violations,
    "spell_lengths": q_spell_lengths,
}

_SIGN_INPUT = """
s AS (
  SELECT event_id, coalesce(event_type = 'error', false) AS neg,
    CASE WHEN coalesce(event_type = 'error', false) THEN -value ELSE value END AS s_correct,
    value AS s_flip,
    CASE WHEN event_id % 2 = 0 THEN -value ELSE value END AS s_ambig
  FROM events)"""


def _sign_counts(c: str) -> str:
    return (f"SELECT '{c}' AS variable, CAST(count_if(neg AND {c} > 0) AS BIGINT) AS wrong_neg, "
            f"CAST(count_if(NOT neg AND {c} < 0) AS BIGINT) AS wrong_pos, "
            f"CAST(count_if(neg AND {c} < 0) AS BIGINT) AS neg_lt0, "
            f"count(CASE WHEN neg THEN {c} END) AS n_neg, count(CASE WHEN NOT neg THEN {c} END) AS n_pos "
            f"FROM s")


_VERDICT = ("CASE WHEN wrong_neg = 0 AND wrong_pos = 0 THEN 'correct' "
            "WHEN neg_lt0 = 0 AND wrong_pos = 0 THEN 'flip' ELSE 'ambiguous' END")

_SIGN_VERDICT = f"""
WITH {_SIGN_INPUT},
c AS ({_sign_counts('s_correct')} UNION ALL {_sign_counts('s_flip')} UNION ALL {_sign_counts('s_ambig')})
SELECT *, {_VERDICT} AS verdict FROM c"""

_SIGN_FLIP = f"""
WITH {_SIGN_INPUT},
c AS ({_sign_counts('s_correct')} UNION ALL {_sign_counts('s_flip')} UNION ALL {_sign_counts('s_ambig')}),
v AS (SELECT variable, {_VERDICT} AS verdict FROM c)
SELECT event_id,
  CASE WHEN neg AND (SELECT verdict FROM v WHERE variable = 's_correct') = 'flip'
       THEN 0.0 - s_correct ELSE s_correct END AS s_correct,
  CASE WHEN neg AND (SELECT verdict FROM v WHERE variable = 's_flip') = 'flip'
       THEN 0.0 - s_flip ELSE s_flip END AS s_flip,
  CASE WHEN neg AND (SELECT verdict FROM v WHERE variable = 's_ambig') = 'flip'
       THEN 0.0 - s_ambig ELSE s_ambig END AS s_ambig
FROM s"""

SQL = {
    "sign_verdict": _SIGN_VERDICT,
    "sign_flip": _SIGN_FLIP,
    "tile_constant": f"""
WITH {PANEL_SQL}
SELECT event_id, user_id, max(asked_once) OVER (PARTITION BY user_id) AS asked_once FROM panel""",
    "tile_violations": f"""
WITH {PANEL_SQL}
SELECT user_id, count(a) AS n FROM panel GROUP BY user_id HAVING count(a) > 1""",
    "carry_forward_record": f"""
WITH {PANEL_SQL}
SELECT event_id, user_id,
  last_value(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a END IGNORE NULLS) OVER w AS a,
  last_value(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN b END IGNORE NULLS) OVER w AS b
FROM panel
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "stored_panel_clean": f"""
WITH {PANEL_SQL}
SELECT event_id, user_id, max(asked_once) OVER (PARTITION BY user_id) AS asked_once,
  last_value(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN a END IGNORE NULLS) OVER w AS a,
  last_value(CASE WHEN a IS NOT NULL AND b IS NOT NULL THEN b END IGNORE NULLS) OVER w AS b
FROM panel
WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "complete_rows": f"""
WITH {PANEL_SQL}
SELECT event_id, user_id, a, b FROM panel WHERE a IS NOT NULL AND b IS NOT NULL""",
    "family_overwrite": f"""
WITH {PANEL_SQL}
SELECT event_id,
  CASE WHEN coalesce(event_type = 'purchase', false) THEN CASE WHEN event_id % 2 = 0 THEN value END ELSE a END AS a,
  CASE WHEN coalesce(event_type = 'purchase', false) THEN value * 2 ELSE b END AS b
FROM panel""",
    "skip_logic_violations": f"""
WITH {PANEL_SQL},
c AS (SELECT *, CASE WHEN event_id % 3 = 0 THEN 1 END AS cond FROM panel)
SELECT 'a_requires_cond' AS rule, event_id, user_id FROM c
  WHERE NOT (cond IS NOT DISTINCT FROM 1) AND a IS NOT NULL
UNION ALL
SELECT 'b_requires_cond' AS rule, event_id, user_id FROM c
  WHERE NOT (cond IS NOT DISTINCT FROM 1) AND b IS NOT NULL""",
    "spell_lengths": """
SELECT spell_length, count(*) AS n_persons
FROM (SELECT user_id, count(*) AS spell_length FROM events GROUP BY user_id) t
GROUP BY spell_length""",
}
