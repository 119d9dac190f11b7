"""Named queries of loading and projecting raw extracts: union with schema
drift, column families by pattern, optional columns, the renaming
projection, preamble-skipping text load, and changed-file detection."""

from __future__ import annotations

from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavepanel.functions.digest import BASE, PRIME
from wavepanel.functions.columns import columns_matching, existing, numbered, rescale, sentinel_fill
from wavepanel.plans.common import table
from wavepanel.session import scratch_dir, stage
from wavepanel.sources.files import (changed_files as changed_files_op, file_hashes,
                                     load_extracts, union_extracts, write_extracts)

SPLIT_TS = "2024-01-16 00:00:00"
LICENSE_LINE = "# Licensed for research use only; redistribution prohibited."

# The first column makes every record start like a preamble line.
EXTRACT_SCHEMA = T.StructType([
    T.StructField("note", T.StringType()),
    T.StructField("event_id", T.LongType()),
    T.StructField("ts", T.TimestampNTZType()),
    T.StructField("user_id", T.LongType()),
    T.StructField("event_type", T.StringType()),
    T.StructField("value", T.DoubleType()),
])


def union_by_name(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    early = ev.where(F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz"))
    late = (ev.where(F.col("ts") >= F.lit(SPLIT_TS).cast("timestamp_ntz"))
              .drop("props").withColumn("value", F.col("value").cast("float")))
    return union_extracts([early, late])


def _wide(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    return ev.select(
        "event_id", F.col("value").alias("Q10_1"),
        F.when(F.col("event_id") % 3 == 0, F.col("value")).alias("Q10_2"),
        (F.col("value") * 2).alias("XQ10_3"), F.col("user_id").alias("Q100"),
        F.col("value").alias("Q9new2_bin1"), (F.col("value") + 1).alias("Q9new2_bin2"),
        (F.col("value") + 2).alias("Q9new2_bin3"))


def columns_by_pattern(spark, sf_dir):
    w = _wide(spark, sf_dir)
    return w.select("event_id", *columns_matching(w, r"Q10_.*"))


def optional_columns(spark, sf_dir):
    w = _wide(spark, sf_dir)
    fam = existing(w, numbered("Q9new2_bin", 1, 10))
    extra = existing(w, ["QRA1", "QRA2"])
    return w.select("event_id", *fam, *extra)


def extract_project(spark, sf_dir):
    ev = table(spark, sf_dir, "events")
    code = F.when(F.col("event_id") % 4 != 0, (F.col("user_id") % 5 + 1).cast("int"))
    return ev.select(
        F.col("event_id").alias("id"), F.col("ts").alias("date"),
        F.col("value").alias("prob_move_house"),
        rescale(F.col("value") / 500.0, 100.0).alias("infl_1y_bin_prob_defl"),
        sentinel_fill(code).alias("financial_past_12m"))


def _write_event_extracts(spark, sf_dir, name):
    path = scratch_dir(spark, name)
    ev = (table(spark, sf_dir, "events").withColumn("note", F.concat(F.lit("#"), "event_type"))
          .select(*[f.name for f in EXTRACT_SCHEMA.fields]))
    write_extracts(ev, path, LICENSE_LINE)
    return path


def load_preamble(spark, sf_dir):
    """Write ``events`` as text extracts (license line + header per file),
    then load them back the way raw extracts are loaded."""
    path = _write_event_extracts(spark, sf_dir, "extracts")
    df = load_extracts(spark, path, EXTRACT_SCHEMA, preamble_prefix="#",
                       timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS")
    return df.drop("_source_file", "part")


def loaded_spell_report(spark, sf_dir):
    """From raw files to the report of the importer: two deliveries, the second
    without one column and with the others in another order, are loaded as one
    panel, and the lengths of the persons' spells are counted."""
    ev = table(spark, sf_dir, "events").withColumn("note", F.concat(F.lit("#"), "event_type"))
    split = F.col("ts") < F.lit(SPLIT_TS).cast("timestamp_ntz")
    early, late = scratch_dir(spark, "early"), scratch_dir(spark, "late")
    columns = [f.name for f in EXTRACT_SCHEMA.fields]
    write_extracts(ev.where(split).select(*columns), early, LICENSE_LINE)
    write_extracts(ev.where(~split).select(*[c for c in columns[::-1] if c != "value"]), late,
                   LICENSE_LINE)
    loaded = load_extracts(spark, [early, late], EXTRACT_SCHEMA, preamble_prefix="#",
                           timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS", missing="null")
    per_person = loaded.groupBy("user_id").agg(
        F.count(F.lit(1)).alias("spell_length"), F.count("value").alias("n_value"))
    return per_person.groupBy("spell_length").agg(F.count(F.lit(1)).alias("n_persons"),
                                                  F.sum("n_value").alias("n_value"))


# Events of all types that share a file, by their ids.
FILE_EVENTS = 20_000
FILE_HEADER = "event_id,user_id,event_type"
# What becomes of the files of these types after they were loaded.
TURNED, HEADER_LAST = "signup", "error"


def _write_type_files(spark, sf_dir, path, later):
    """One file per event type and FILE_EVENTS ids: a header, then the events
    by id.  ``later``: those of one type in reverse, the header of another one
    at the end."""
    ev = table(spark, sf_dir, "events").select(
        "event_type", F.floor(F.col("event_id") / FILE_EVENTS).alias("chunk"),
        F.col("event_id").alias("at"),
        F.concat_ws(",", "event_id", "user_id", "event_type").alias("value"))
    last = F.lit(1 << 62)
    head = (ev.select("event_type", "chunk").distinct()
            .withColumns({"at": -last, "value": F.lit(FILE_HEADER)}))
    rows = ev.unionByName(head)
    if later:
        rows = rows.withColumn("at", F.when((F.col("event_type") == TURNED) & (F.col("at") >= 0),
                                            -F.col("at"))
                               .when((F.col("event_type") == HEADER_LAST) & (F.col("at") < 0), last)
                               .otherwise(F.col("at")))
    key = ["event_type", "chunk"]
    (rows.repartition(*key).sortWithinPartitions(*key, "at")
     .select(*key, "value").write.mode("overwrite").partitionBy(*key).text(path))


def changed_files(spark, sf_dir):
    """Extract files, loaded once and then delivered again: the files with the
    same lines in another order come back, the others do not."""
    first, again = scratch_dir(spark, "delivered"), scratch_dir(spark, "delivered-again")
    _write_type_files(spark, sf_dir, first, later=False)
    _write_type_files(spark, sf_dir, again, later=True)
    manifest = stage(file_hashes(spark, first, "*.txt"), "file-hashes")
    found = changed_files_op(spark, again, manifest, "*.txt")
    return found.select(F.regexp_extract("path", r"event_type=([^/]+)", 1).alias("event_type"),
                        F.regexp_extract("path", r"chunk=(\d+)", 1).cast("long").alias("chunk"),
                        "bytes", "lines", "digest")


QUERIES = {
    "union_by_name": union_by_name,
    "columns_by_pattern": columns_by_pattern,
    "optional_columns": optional_columns,
    "extract_project": extract_project,
    "load_preamble": load_preamble,
    "changed_files": changed_files,
    "loaded_spell_report": loaded_spell_report,
}

SQL = {
    "union_by_name": f"""
SELECT event_id, ts, user_id, event_type, value, props FROM events WHERE ts < TIMESTAMP '{SPLIT_TS}'
UNION ALL BY NAME
SELECT event_id, ts, user_id, event_type, CAST(CAST(value AS FLOAT) AS DOUBLE) AS value
FROM events WHERE ts >= TIMESTAMP '{SPLIT_TS}'""",
    "columns_by_pattern": """
SELECT event_id, value AS Q10_1, CASE WHEN event_id % 3 = 0 THEN value END AS Q10_2, value * 2 AS XQ10_3
FROM events""",
    "optional_columns": """
SELECT event_id, value AS Q9new2_bin1, value + 1 AS Q9new2_bin2, value + 2 AS Q9new2_bin3 FROM events""",
    "extract_project": """
SELECT event_id AS id, ts AS date, value AS prob_move_house, value / 500.0 * 100.0 AS infl_1y_bin_prob_defl,
  CAST(coalesce(CASE WHEN event_id % 4 <> 0 THEN CAST(user_id % 5 + 1 AS INTEGER) END, -1) AS TINYINT)
    AS financial_past_12m
FROM events""",
    "loaded_spell_report": f"""
SELECT spell_length, count(*) AS n_persons, CAST(sum(n_value) AS BIGINT) AS n_value
FROM (SELECT user_id, count(*) AS spell_length,
        count(CASE WHEN ts < TIMESTAMP '{SPLIT_TS}' THEN value END) AS n_value
      FROM events GROUP BY user_id) t
GROUP BY spell_length""",
    "changed_files": f"""
WITH e AS (
  SELECT event_type, CAST(event_id // {FILE_EVENTS} AS BIGINT) AS chunk, event_id AS pos,
    concat_ws(',', event_id, user_id, event_type) AS line
  FROM events WHERE event_type IN ('{TURNED}', '{HEADER_LAST}')),
l AS (
  SELECT event_type, chunk, CASE WHEN event_type = '{TURNED}' THEN -pos ELSE pos END AS pos, line FROM e
  UNION ALL
  SELECT DISTINCT event_type, chunk,
    CASE WHEN event_type = '{TURNED}' THEN -{1 << 62} ELSE {1 << 62} END, '{FILE_HEADER}' FROM e),
f AS (
  SELECT event_type, chunk, CAST(sum(strlen(line) + 1) AS BIGINT) AS bytes, count(*) AS lines,
    list(CAST(CAST('0x' || substr(md5(line), 1, 15) AS BIGINT) + 1 AS HUGEINT) ORDER BY pos DESC) AS hashes
  FROM l GROUP BY event_type, chunk)
SELECT event_type, chunk, bytes, lines,
  CAST(list_reduce(hashes, lambda d, h: (d * {BASE} + h) % {PRIME}) AS BIGINT) AS digest
FROM f""",
    "load_preamble": "SELECT '#' || event_type AS note, event_id, ts, user_id, event_type, value FROM events",
}


def stream_ingest(spark, sf_dir):
    """Write ``events`` as extract files, ingest them with the streaming
    loader (one catch-up trigger), and read the resulting table."""
    from wavepanel.streaming.ingest import ingest_available
    src = _write_event_extracts(spark, sf_dir, "stream-src")
    target = scratch_dir(spark, "stream-out")
    ingest_available(spark, src, EXTRACT_SCHEMA, target, scratch_dir(spark, "stream-ckpt"),
                     preamble_prefix="#", timestamp_format="yyyy-MM-dd HH:mm:ss.SSSSSS")
    return spark.read.parquet(target).drop("_source_file", "ingest_batch")


QUERIES["stream_ingest"] = stream_ingest
SQL["stream_ingest"] = SQL["load_preamble"]
