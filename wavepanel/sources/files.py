"""Sources and sinks.

* ``load_extracts`` (S1): delimited text extracts whose files start with one
  preamble line (a license notice) above the header.  Read with
  ``spark.read.text`` (splittable); one aggregate learns the first lines of
  each file, the header is matched by name, and one scan parses the rows with
  ``from_csv``.
* ``union_extracts`` (S2): union by name over drifting schemas.
* ``changed_files`` (S3): files whose content digest, which depends on the
  order of the lines, is not yet in a manifest.
* ``read_crosswalk`` / ``write_crosswalk_csv`` (S4, S7).
* ``write_panel`` / ``read_panel`` (S6, S8): Parquet, keys as columns;
  ``write_bucketed_panel`` / ``open_bucketed_panel``: a table bucketed by person.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from wavepanel.functions.digest import PRIME, line_hash, mulmod, power_of_any, with_power_times
from wavepanel.session import max_broadcast_rows, stage

CROSSWALK_SCHEMA = T.StructType([
    T.StructField("year", T.IntegerType()),
    T.StructField("ibin", T.IntegerType()),
    T.StructField("lbound", T.DoubleType()),
    T.StructField("rank", T.DoubleType()),
])


# --- S4 / S7 ----------------------------------------------------------------

def write_crosswalk_csv(cw: DataFrame, path: str, order: Sequence[str],
                        rank_digits: int = 3) -> None:
    """CSV with a header, columns in ``order``, rank rounded: one file, if the
    crosswalk is counted small enough to be broadcast to its lookups (it has
    cells x bins rows), else a file per partition."""
    out = cw.select(*order).withColumn("rank", F.round("rank", rank_digits))
    few = stage(out, "crosswalk-rows")
    if few.count() <= max_broadcast_rows(cw.sparkSession):
        few = few.repartition(1)
    few.write.mode("overwrite").option("header", True).csv(path)


def read_crosswalk(spark: SparkSession, path: str,
                   schema: T.StructType = CROSSWALK_SCHEMA) -> DataFrame:
    return spark.read.schema(schema).option("header", True).csv(path)


# --- S1 ---------------------------------------------------------------------

# Different headers that one pass over the rows parses.
HEADERS_PER_PASS = 50


def load_extracts(spark: SparkSession, paths: str | Sequence[str], schema: T.StructType,
                  preamble_prefix: str | None = None, sep: str = ",",
                  timestamp_format: str | None = None, malformed: str = "raise",
                  missing: str = "raise") -> DataFrame:
    """Parse delimited extracts that carry one preamble line above the header.

    With ``preamble_prefix`` the first line of every file must start with it
    and is dropped; without, files start with their header.  The header names
    the columns of its file in any order, quoted or not; columns that the
    schema does not have are ignored, and one that a file lacks raises, or is
    NULL in that file's rows with ``missing="null"``.  Every other line is a
    record, whatever it starts with.  ``malformed="null"`` turns records that
    do not fit the schema into NULLs instead of raising.  NaN counts as
    missing.  The file of each row is kept in ``_source_file``.  Folders are
    searched recursively.

    One aggregate learns each file's first lines (one row a file); then one
    scan parses the rows.  Files with the same header are parsed alike, by one
    scan for each ``HEADERS_PER_PASS`` different headers.
    """
    skip = 1 if preamble_prefix else 0
    reader = spark.read.option("recursiveFileLookup", "true")
    lines = reader.text(paths if isinstance(paths, str) else list(paths)).select(
        F.regexp_replace("value", "\r$", "").alias("value"),
        F.col("_metadata.file_path").alias("_source_file"),
        F.col("_metadata.file_block_start").alias("_block"),
        F.monotonically_increasing_id().alias("_line"))
    files, known = _file_table(lines, skip, preamble_prefix)
    if not known:                            # no file has a header line
        return spark.createDataFrame([], schema).withColumn("_source_file", F.lit(""))
    opts = {"sep": sep, "mode": "FAILFAST" if malformed == "raise" else "PERMISSIVE"}
    if timestamp_format:
        opts["timestampNTZFormat"] = timestamp_format
    many = files.count()
    out = None
    for at in range(0, len(known), HEADERS_PER_PASS):
        group = known[at:at + HEADERS_PER_PASS]
        mine = files if len(known) == len(group) else files.where(F.col("_header").isin(group))
        side = F.broadcast(mine) if many <= max_broadcast_rows(spark) else mine
        record = F
        for h in group:
            record = record.when(F.col("_header") == h, _record(h, schema, sep, opts, missing))
        # a line's place in the file's first block is its distance from the first
        body = (F.col("_block") > 0) | (F.col("_line") - F.col("_first") > skip)
        rows = (lines.join(side, "_source_file").where(body & (F.length("value") > 0))
                .select(record.alias("r"), "_source_file").select("r.*", "_source_file"))
        out = rows if out is None else out.unionByName(rows)
    real = [f.name for f in schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return out.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in real}) if real else out


def _file_table(lines: DataFrame, skip: int, preamble_prefix: str | None
                ) -> tuple[DataFrame, list[str]]:
    """((file, first line number, header), the different headers).

    The lines of a file's first block are numbered without gaps.  So with one
    preamble line the header's number is the other one, odd or even, than the
    first line's, and it is the smallest of these: one aggregate finds both.
    """
    turn = F.col("_line") % (skip + 1)
    heads = lines.where(F.col("_block") == 0).groupBy("_source_file").agg(
        F.min("_line").alias("_first"),
        *[F.min(F.when(turn == i, F.struct("_line", "value"))).alias(f"_at{i}")
          for i in range(skip + 1)])
    place = F.col("_first") % (skip + 1)
    first, header = F.col("_at0.value"), F.col("_at0.value")
    if skip:
        first = F.when(place == 0, F.col("_at0.value")).otherwise(F.col("_at1.value"))
        header = F.when(place == 0, F.col("_at1.value")).otherwise(F.col("_at0.value"))
    files = stage(heads.select("_source_file", "_first", header.alias("_header"),
                               first.alias("_preamble")), "extract-files")
    if preamble_prefix:
        wrong = files.where(~F.col("_preamble").startswith(preamble_prefix)).first()
        if wrong:
            raise ValueError(f"{wrong['_source_file']} does not start with {preamble_prefix!r}")
    files = files.where(F.col("_header").isNotNull()).drop("_preamble")
    return files, sorted(r["_header"] for r in files.select("_header").distinct().collect())


def _record(header: str, schema: T.StructType, sep: str, opts: dict, missing: str):
    """A line of a file with this header as a struct in the schema's order."""
    import csv
    names = [n.strip() for n in next(csv.reader([header.lstrip("\ufeff")], delimiter=sep), [])]
    lacks = [f.name for f in schema.fields if f.name not in names]
    if lacks and missing == "raise":
        raise ValueError(f"header {header!r} lacks {', '.join(lacks)}")
    kinds = {f.name: f.dataType for f in schema.fields}
    there = T.StructType([T.StructField(n if n in kinds else f"_other{i}",
                                        kinds.get(n, T.StringType())) for i, n in enumerate(names)])
    parsed = F.from_csv(F.col("value"), there.simpleString(), opts)
    return F.struct(*[(F.lit(None).cast(f.dataType) if f.name in lacks else parsed[f.name])
                      .alias(f.name) for f in schema.fields])


def write_extracts(df: DataFrame, path: str, preamble: str, n_files: int = 8,
                   sep: str = ",") -> None:
    """Write ``df`` as text extracts, each file starting with ``preamble`` and a header.

    Rows are dealt to ``n_files`` files by a hash; a file's two first lines
    sort before its rows.  The files lie in sub-folders of ``path``.
    """
    spark = df.sparkSession
    text = F.to_csv(F.struct(*df.columns), {"sep": sep,
                    "timestampNTZFormat": "yyyy-MM-dd HH:mm:ss.SSSSSS"})
    rows = df.select(F.pmod(F.xxhash64(*df.columns), F.lit(n_files)).cast("int").alias("part"),
                     F.lit(2).alias("_at"), text.alias("value"))
    for at, line in ((0, preamble), (1, sep.join(df.columns))):
        rows = rows.unionByName(spark.range(n_files).select(
            F.col("id").cast("int").alias("part"), F.lit(at).alias("_at"),
            F.lit(line).alias("value")))
    (rows.repartition(n_files, "part").sortWithinPartitions("part", "_at").select("part", "value")
     .write.mode("overwrite").partitionBy("part").text(path))


# --- S2 ---------------------------------------------------------------------

def union_extracts(frames: Sequence[DataFrame]) -> DataFrame:
    """Union by column name; a column missing from an extract is NULL there.

    Numeric columns whose type drifts between extracts are widened first
    (``unionByName`` resolves to the wider type).
    """
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


# --- S3 ---------------------------------------------------------------------

def file_hashes(spark: SparkSession, paths: str | Sequence[str],
                name_glob: str | None = None) -> DataFrame:
    """(path, bytes, lines, digest) of every text file.

    The digest depends on the lines and their order (``functions.digest``): a
    file with two lines swapped, or with its header moved, has another one.
    Each split of a file is digested by the task that reads it, and one row per
    split is put together by its place in the file, so the result does not
    depend on how Spark cuts the files.  ``bytes`` tells apart files that
    differ in the last line break only.  A directory is searched recursively;
    ``name_glob`` keeps matching file names only (e.g. ``"*.csv"``).  An empty
    file has no row.
    """
    reader = (spark.read.format("text").option("recursiveFileLookup", "true")
              .option("lineSep", "\n"))
    if name_glob:
        reader = reader.option("pathGlobFilter", name_glob)
    src = reader.load(paths if isinstance(paths, str) else list(paths))
    # lines of one split have consecutive numbers in their task
    lines = src.select(F.col("_metadata.file_path").alias("path"),
                       F.col("_metadata.file_size").alias("bytes"),
                       F.col("_metadata.file_block_start").alias("block"),
                       line_hash(F.col("value")).alias("h"),
                       F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1)).alias("at"))
    # sums of 2^61 numbers overflow a long, so halves are added up
    splits = with_power_times(lines, "at", "h", "d").groupBy("path", "bytes", "block").agg(
            F.count(F.lit(1)).alias("n"), F.min("at").alias("first"),
            F.sum(F.shiftright("d", 30)).alias("hi"),
            F.sum(F.col("d").bitwiseAND(F.lit((1 << 30) - 1))).alias("lo"))
    before = Window.partitionBy("path").orderBy("block").rowsBetween(
        Window.unboundedPreceding, -1)                       # splits of one file
    placed = splits.select(
        "path", "bytes", "n",
        ((mulmod(F.col("hi") % PRIME, F.lit(1 << 30).cast("long")) + F.col("lo") % PRIME) % PRIME)
        .alias("s"),
        power_of_any(F.coalesce(F.sum("n").over(before), F.lit(0)) - F.col("first")).alias("shift"))
    total = F.sum(F.col("d").cast("decimal(38,0)")) % F.lit(PRIME).cast("decimal(19,0)")
    return (placed.select("path", "bytes", "n", mulmod(F.col("s"), F.col("shift")).alias("d"))
            .groupBy("path", "bytes").agg(F.sum("n").alias("lines"),
                                          total.cast("long").alias("digest")))


def changed_files(spark: SparkSession, paths: str | Sequence[str], manifest: DataFrame,
                  name_glob: str | None = None) -> DataFrame:
    """Files whose (bytes, lines, digest) is not in ``manifest``: the ones that
    must be (re)loaded.  A left-anti join; what a file is called and where it
    lies does not count."""
    known = ["bytes", "lines", "digest"]
    return (file_hashes(spark, paths, name_glob)
            .join(manifest.select(*known).distinct(), known, "left_anti"))


# --- S6 / S8 ----------------------------------------------------------------

def write_panel(df: DataFrame, path: str, id_col: str = "userid", wave_col: str = "wid",
                partition_by: Sequence[str] = ()) -> None:
    """Store a panel table as Parquet, rows clustered by person and wave.

    Ranges of (partition columns, person, wave) keep the write parallel and
    split a person with very many rows.  As the ranges follow the partition
    columns first, each task writes one or a few of their folders: there are
    about as many files as ranges, plus one for each folder that begins within
    a range.  Parquet min/max statistics let later reads skip row groups.
    """
    order = [*partition_by, id_col, wave_col]
    w = (df.repartitionByRange(*order).sortWithinPartitions(*order)
         .write.mode("overwrite"))
    if partition_by:
        w = w.partitionBy(*partition_by)
    w.parquet(path)


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def write_bucketed_panel(df: DataFrame, table: str, path: str, id_col: str = "userid",
                         wave_col: str = "wid", buckets: int = 200) -> DataFrame:
    """Store a panel as a table of ``buckets`` buckets by person and return it.

    What is grouped, joined or windowed by person on such a table needs no
    exchange.  The rows are ranged by (bucket, person, wave) first: each task
    writes few buckets, and a bucket that holds a person with very many rows
    is written by several tasks, each in (person, wave) order.
    """
    bucket = F.pmod(F.hash(id_col), F.lit(buckets))          # as Spark deals its buckets
    n = max(buckets, int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    (df.withColumn("_wp_bucket", bucket).repartitionByRange(n, "_wp_bucket", id_col, wave_col)
     .sortWithinPartitions("_wp_bucket", id_col, wave_col).drop("_wp_bucket")
     .write.mode("overwrite").option("path", path).bucketBy(buckets, id_col)
     .sortBy(id_col, wave_col).saveAsTable(table))
    return df.sparkSession.table(table)


def open_bucketed_panel(spark: SparkSession, table: str, path: str, schema: T.StructType,
                        id_col: str = "userid", wave_col: str = "wid", buckets: int = 200
                        ) -> DataFrame:
    """The table that ``write_bucketed_panel`` wrote to ``path``, in a session
    whose catalogue does not know it (yet)."""
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
    spark.sql(f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet "
              f"CLUSTERED BY (`{id_col}`) SORTED BY (`{id_col}`, `{wave_col}`) "
              f"INTO {buckets} BUCKETS LOCATION '{path}'")
    return spark.table(table)
