"""Panel diagnostics: observation counts per person and per wave, histogram
of per-person counts, wave quartiles and means, outlier screening.

The wave statistics work on a long (wave, variable, value) form made with
``unpivot``, so every variable is handled by the same few aggregates instead
of one job per column.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from wavepanel.operators.segments import join_keys
from wavepanel.operators.stats import exact_quantiles
from wavepanel.session import stage, ensure_checkpoint_dir, max_broadcast_rows


def nonmissing_counts(df: DataFrame, by: str | Sequence[str], cols: Sequence[str],
                      prefix: str = "n_") -> DataFrame:
    """Non-missing count of every column per ``by`` (person or wave)."""
    by = [by] if isinstance(by, str) else list(by)
    return df.groupBy(*by).agg(*[F.count(c).alias(f"{prefix}{c}") for c in cols])


@dataclass(frozen=True)
class CoverageReports:
    """What one scan of the panel tells about missing answers."""
    by_person: DataFrame        # person, n_rows, n_<column>...
    by_wave: DataFrame          # wave, n_rows, n_<column>...
    missing: DataFrame          # variable, n_present, n_missing


def coverage_counts(df: DataFrame, person: str, wave: str, cols: Sequence[str]) -> DataFrame:
    """Rows and non-missing counts per person, per wave and in all, by one
    aggregate over grouping sets: level ("person", "wave" or "all"), person,
    wave, n_rows, n_<column>.  A missing person or wave is a group like others."""
    sets = df.groupingSets([[F.col(person)], [F.col(wave)], []], person, wave)
    level = (F.when(F.grouping(person) == 0, "person").when(F.grouping(wave) == 0, "wave")
             .otherwise("all"))
    return sets.agg(level.alias("level"), F.count(F.lit(1)).alias("n_rows"),
                    *[F.count(c).alias(f"n_{c}") for c in cols])


def coverage_reports(df: DataFrame, person: str, wave: str, cols: Sequence[str]) -> CoverageReports:
    """The counts per person, per wave and per variable from one scan."""
    counts = stage(coverage_counts(df, person, wave, cols), "coverage")
    n = [f"n_{c}" for c in cols]
    # one row, also for an empty table, which has no grouping set at all
    whole = counts.where("level = 'all'").agg(
        *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in ("n_rows", *n)])
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"n_{c}").alias("n_present"),
                              (F.col("n_rows") - F.col(f"n_{c}")).alias("n_missing")) for c in cols])
    return CoverageReports(counts.where("level = 'person'").select(person, "n_rows", *n),
                           counts.where("level = 'wave'").select(wave, "n_rows", *n),
                           whole.select(F.inline(rows)))


def nobs_histogram(df: DataFrame, by: str, cols: Sequence[str]) -> DataFrame:
    """Histogram of per-person non-missing counts for each column.

    Bins are the integers ``0..nmax-1`` with ``nmax`` the largest number of
    rows of any person; the last bin is closed, so counts ``nmax-1`` and
    ``nmax`` share it.  Output ``variable, bin, n_persons`` (non-empty bins).
    ``nmax`` is a scalar subquery over the per-person table.
    """
    per = df.groupBy(by).agg(F.count(F.lit(1)).alias("_rows"),
                             *[F.count(c).alias(c) for c in cols])
    nmax = per.select(F.max("_rows")).scalar()
    long = per.unpivot(by, list(cols), "variable", "n")
    return (long.withColumn("bin", F.least(F.col("n"), nmax - 1))
                .groupBy("variable", "bin").agg(F.count(F.lit(1)).alias("n_persons")))


def to_long(df: DataFrame, keys: Sequence[str], cols: Sequence[str],
            value: str = "val", with_row_hash: bool = True) -> DataFrame:
    """(keys..., variable, val) rows for the non-missing values of ``cols``;
    ``_row`` is a hash of the source row (a tie-break for exact quantiles)."""
    keys = list(keys)
    src = df
    if with_row_hash:
        src = df.withColumn("_row", F.xxhash64(*[F.col(c) for c in df.columns]))
        ids = keys + ["_row"]
    else:
        ids = keys
    casted = src.select(*ids, *[F.col(c).cast("double").alias(c) for c in cols])
    return casted.unpivot(ids, list(cols), "variable", value).where(F.col(value).isNotNull())


def wave_stats(long: DataFrame, wave: str, value: str = "val",
               probs: Sequence[float] = (0.25, 0.5, 0.75), method: str = "exact",
               accuracy: int = 10_000, freq: str | None = None) -> DataFrame:
    """Per (wave, variable): quartiles ``p25 p50 p75`` and ``mean``.

    ``freq`` names the counts if ``long`` is a table of value counts.

    ``method="exact"`` (default) reads them by position after one sort per
    (wave, variable); ``"approx"`` uses ``percentile_approx`` (one
    aggregate, rank error about 1/accuracy) for very large waves.
    """
    keys = [wave, "variable"]
    if method == "approx":
        q = F.percentile_approx(value, list(probs), accuracy)
        return long.groupBy(*keys).agg(q.alias("_q"), F.avg(value).alias("mean")).select(
            *keys, *[F.col("_q")[i].alias(n) for i, n in enumerate(["p25", "p50", "p75"])], "mean")
    if method != "exact":
        raise ValueError("method must be 'exact' or 'approx'")
    return exact_quantiles(long, keys, value, probs, ["p25", "p50", "p75"], mean_name="mean",
                           freq=freq)


def _attach_small(big: DataFrame, small: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Join a per-(wave, variable) table back onto rows.

    The small table is materialised once in the checkpoint folder (so its
    window pass is not repeated by the join), counted, and broadcast when
    the count allows it."""
    ensure_checkpoint_dir(big.sparkSession)
    small = small.checkpoint(eager=True)
    n = small.count()
    if n <= max_broadcast_rows(big.sparkSession):
        return big.join(F.broadcast(small), list(keys), "left")
    from wavepanel.operators.panel import attach_per_key
    return attach_per_key(big, small, keys)        # salted for hot (wave, variable)


def value_counts(long: DataFrame, wave: str, value: str = "val", freq: str = "n") -> DataFrame:
    """One row per (wave, variable, value) with its count, written once.

    The outlier counts and trimmed means below need no more than this."""
    return stage(long.groupBy(wave, "variable", value).agg(F.count(F.lit(1)).alias(freq)),
                 "value-counts")


def append_counts(long: DataFrame, path: str, batch: str, wave: str, value: str = "val",
                  freq: str = "n") -> None:
    """Add the value counts of one batch of rows (a new file, say) to the store
    at ``path``.  Earlier batches are not read; a batch that is appended again,
    after a failure or a corrected delivery, replaces its former counts."""
    (long.groupBy(wave, "variable", value).agg(F.count(F.lit(1)).alias(freq))
     .write.mode("overwrite").parquet(f"{path.rstrip('/')}/batch={batch}"))


def read_counts(spark: SparkSession, path: str, wave: str, value: str = "val",
                freq: str = "n", changed_by: str | None = None) -> DataFrame:
    """The counts of all batches added up, one row per (wave, variable, value).

    Waves that got rows from several batches are merged.  With ``changed_by``
    only the waves that this batch has rows of come back: the only ones whose
    statistics it changed.  Waves are few, so that list is joined broadcast if
    it is counted small.
    """
    every = spark.read.parquet(path).withColumn("batch", F.col("batch").cast("string"))
    if changed_by is not None:
        waves = every.where(F.col("batch") == changed_by).select(wave).distinct()
        every = join_keys(every, stage(waves, "changed-waves"), [wave], "left_semi", waves.count())
    return every.groupBy(wave, "variable", value).agg(F.sum(freq).alias(freq))


def outlier_flags(long: DataFrame, wave: str, value: str = "val", k: float = 100.0,
                  min_iqr: float = 1.0, freq: str | None = None) -> DataFrame:
    """Add ``outlier``: value above ``q25 + k*IQR`` or below ``q75 - k*IQR``
    within its (wave, variable), with ``IQR = max(q75 - q25, min_iqr)``.

    The bands deliberately start at the opposite quartile (as the screening
    being reproduced does), i.e. they lie (k-1)*IQR beyond the usual fences.
    """
    keys = [wave, "variable"]
    q = exact_quantiles(long, keys, value, [0.25, 0.75], ["q25", "q75"], freq=freq)
    iqr = F.greatest(F.col("q75") - F.col("q25"), F.lit(min_iqr))
    q = q.select(*keys, "q25", "q75", iqr.alias("iqr"))
    x = F.col(value)
    flag = (x > F.col("q25") + k * F.col("iqr")) | (x < F.col("q75") - k * F.col("iqr"))
    return _attach_small(long, q, keys).withColumn("outlier", F.coalesce(flag, F.lit(False)))


def outlier_counts(flagged: DataFrame, freq: str | None = None) -> DataFrame:
    """Outliers per variable, non-zero only, largest first."""
    n = F.count_if("outlier") if freq is None else F.sum(F.when(F.col("outlier"), F.col(freq)))
    return (flagged.groupBy("variable").agg(n.alias("n_outliers"))
                   .where(F.col("n_outliers") > 0).orderBy(F.desc("n_outliers"), "variable"))


def trimmed_means(flagged: DataFrame, wave: str, value: str = "val",
                  freq: str | None = None) -> DataFrame:
    """Mean per (wave, variable) with outliers set to missing."""
    if freq is not None:
        kept = ~F.col("outlier")
        return flagged.groupBy(wave, "variable").agg(
            F.try_divide(F.sum(F.when(kept, F.col(value) * F.col(freq))),
                         F.sum(F.when(kept, F.col(freq)))).alias("mean_trimmed"))
    return flagged.groupBy(wave, "variable").agg(
        F.avg(F.when(~F.col("outlier"), F.col(value))).alias("mean_trimmed"))


def median_timestamp(df: DataFrame, by: str | Sequence[str], ts: str | Column) -> DataFrame:
    """Median timestamp per group: ``median_us`` (microseconds since the
    epoch, exact half-microsecond) and ``median_ts`` (floor to the microsecond)."""
    by = [by] if isinstance(by, str) else list(by)
    t = F.col(ts) if isinstance(ts, str) else ts
    # Zone-free arithmetic on wall-clock timestamps (no session time zone).
    epoch = F.lit("1970-01-01 00:00:00").cast("timestamp_ntz")
    us = F.timestamp_diff("MICROSECOND", epoch, t.cast("timestamp_ntz"))
    q = exact_quantiles(df.withColumn("_us", us), by, "_us", [0.5], ["median_us"])
    return q.withColumn("median_ts",
                        F.timestamp_add("MICROSECOND", F.floor("median_us").cast("long"), epoch))
