"""Person-level panel operators: tile a once-only answer to all rows of the
person, carry the last complete record forward, spell lengths.

Plans.  ``tile`` aggregates per person (map-side partial aggregation, so a
person with a third of the rows costs nothing special) and joins the
per-person result back with ``attach_per_key``: a plain join for ordinary
persons, a salted join for hot ones (AQE's skew-join split does not apply
here, because the per-person side comes out of an aggregate that already
shares the join's partitioning).  ``carry_forward`` is a running "last
complete record" per person (``segments.running``), so a hot person is
sorted by many tasks.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavepanel.operators.segments import hot_keys, join_keys, running
from wavepanel.session import rows_per_segment


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


def tile(df: DataFrame, values: Mapping[str, str | Column] | Sequence[str], by: str | Sequence[str],
         dtype: str | None = None, check: str | None = "lazy", allow_equal: bool = False,
         dtypes: Mapping[str, str] | None = None,
         records: Mapping[str, Sequence[str]] | None = None,
         record_dtype: str | None = None, hot: tuple | None = None) -> DataFrame:
    """Spread a value given once per person to every row of the person.

    ``values`` maps output names to source columns (a list keeps names).
    Persons without a value get NULL.  More than one non-missing row for a
    person is an error - also when the values are equal, unless
    ``allow_equal`` (then only distinct values conflict).  ``dtypes`` gives a
    per-column safe cast (``dtype`` one for all).

    ``records`` tiles groups of columns as one record each in the same pass
    (see ``tile_record``): only rows with all of a group's columns present
    count.

    ``check``: ``"lazy"`` folds the check into the tiled column (error when
    it is computed), ``"eager"`` runs a violation count first, ``None`` skips
    (of several values the largest is taken, in a record field by field).
    All columns are tiled by ONE per-person aggregate and ONE left join.
    """
    by = [by] if isinstance(by, str) else list(by)
    if not isinstance(values, Mapping):
        values = {v: v for v in values}
    records = {k: list(v) for k, v in (records or {}).items() if v}
    aggs = []
    for out, src in values.items():
        s = _c(src)
        aggs.append(F.max(s).alias(f"_t_{out}"))
        n = F.count_distinct(s) if allow_equal else F.count(s)
        aggs.append(n.alias(f"_n_{out}"))
    for name, cols in records.items():
        complete = F.lit(True)
        for c in cols:
            complete = complete & F.col(c).isNotNull()
        # field by field: a maximum of structs would sort all rows
        aggs += [F.max(F.when(complete, F.col(c))).alias(f"_t_{name}_{c}") for c in cols]
        aggs.append(F.count(F.when(complete, 1)).alias(f"_n_{name}"))
    stats = df.groupBy(*by).agg(*aggs)
    names = list(values) + list(records)
    if check == "eager":
        bad = F.lit(False)
        for out in names:
            bad = bad | (F.col(f"_n_{out}") > 1)
        if stats.where(bad).limit(1).count():
            raise ValueError("Multiple non-missing values per person: " + ", ".join(names))

    def guarded(out, v):
        if check != "lazy":
            return v
        return F.when(F.col(f"_n_{out}") <= 1, v).otherwise(
            F.raise_error(F.lit(f"Multiple non-missing values per person in {out}")))

    cols = {}
    for out in values:
        v = F.col(f"_t_{out}")
        cast_to = (dtypes or {}).get(out, dtype)
        cols[out] = guarded(out, v.try_cast(cast_to) if cast_to else v)
    for name, rcols in records.items():
        for c in rcols:
            v = F.col(f"_t_{name}_{c}")
            cols[c] = guarded(name, v.try_cast(record_dtype) if record_dtype else v)
    stats = stats.select(*by, *[c.alias(k) for k, c in cols.items()])
    base = df.drop(*[k for k in cols if k in df.columns])
    return attach_per_key(base, stats, by, hot=hot)


def attach_per_key(df: DataFrame, stats: DataFrame, by: Sequence[str],
                   limit: int | None = None, hot: tuple | None = None) -> DataFrame:
    """LEFT join of a per-key table (one row per key) back onto the rows,
    safe when one key holds a large share of the rows.

    A plain shuffle join sends every row of a key to one task.  Keys with
    more than ``wavepanel.rowsPerSegment`` rows (found by one aggregate;
    at most rows / limit of them, so the list is broadcast) are salted: their
    rows are spread over ``ceil(rows / limit)`` salts by a hash of the row
    content (deterministic on recomputation), and only their stats rows are
    replicated to the same salts - at most about 2 * rows / limit extra rows.
    ``hot`` is a ``hot_keys`` result for the same rows and keys, if known.
    """
    by = list(by)
    spark = df.sparkSession
    limit = limit or rows_per_segment(spark)
    hot, n_hot, _ = hot if hot is not None else hot_keys(df, by, limit)
    if hot is None:
        return df.join(stats, by, "left")
    flags = hot.select(*by, F.ceil(F.col("_wp_n") / F.lit(limit)).cast("int").alias("_wp_ns"))
    row_hash = F.xxhash64(*[F.col(c) for c in df.columns])
    salted = (join_keys(df, flags, by, "left", n_hot)
                .withColumn("_wp_salt", F.when(F.col("_wp_ns").isNull(), F.lit(0))
                            .otherwise(F.pmod(row_hash, F.col("_wp_ns")).cast("int")))
                .drop("_wp_ns"))
    fanned = (join_keys(stats, flags, by, "left", n_hot)
                   .withColumn("_wp_salt", F.explode(
                       F.when(F.col("_wp_ns").isNull(), F.array(F.lit(0)))
                        .otherwise(F.sequence(F.lit(0), F.col("_wp_ns") - 1))))
                   .drop("_wp_ns"))
    return salted.join(fanned, by + ["_wp_salt"], "left").drop("_wp_salt")


def tile_record(df: DataFrame, cols: Sequence[str], by: str | Sequence[str],
                dtype: str | None = None, check: str | None = "lazy") -> DataFrame:
    """Tile several columns as one record: only rows with ALL of ``cols``
    present count, and at most one such row per person is allowed."""
    return tile(df, {}, by, check=check, records={"_record": list(cols)}, record_dtype=dtype)


def tile_violations(df: DataFrame, value: str | Column, by: str | Sequence[str],
                    count_col: str = "n", allow_equal: bool = False) -> DataFrame:
    """Persons with more than one non-missing value (the rows ``tile`` rejects)."""
    by = [by] if isinstance(by, str) else list(by)
    n = F.count_distinct(_c(value)) if allow_equal else F.count(_c(value))
    return df.groupBy(*by).agg(n.alias(count_col)).where(F.col(count_col) > 1)


def carry_forward(df: DataFrame, cols: Sequence[str], by: str | Sequence[str],
                  order: Sequence[str], complete: bool = True,
                  limit: int | None = None, hot: tuple | None = None) -> DataFrame:
    """Replace ``cols`` by the latest record at or before each row of the person.

    With ``complete=True`` only rows where all ``cols`` are present are
    records (a row with a gap is skipped as a whole, never mixed field by
    field); rows before the first record get NULL.  The carry never crosses
    persons.  ``order`` is one or two sortable columns (wave, tie-break).
    """
    by = [by] if isinstance(by, str) else list(by)
    ok = F.lit(True)
    for c in cols:
        ok = (ok & F.col(c).isNotNull()) if complete else (ok | F.col(c).isNotNull())
    rec = F.when(ok, F.struct(*[F.col(c).alias(c) for c in cols]))
    out = running(df, by, list(order), {"_wp_rec": ("last", rec)}, limit=limit, hot=hot)
    return out.withColumns({c: F.col("_wp_rec")[c] for c in cols}).drop("_wp_rec")


def complete_rows(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Rows where every one of ``cols`` is present."""
    return df.dropna(how="any", subset=list(cols))


def spell_lengths(df: DataFrame, by: str | Sequence[str], length_col: str = "spell_length",
                  count_col: str = "n_persons") -> DataFrame:
    """Distribution of rows per person: (rows, number of persons), sorted."""
    by = [by] if isinstance(by, str) else list(by)
    per = df.groupBy(*by).agg(F.count(F.lit(1)).alias(length_col))
    return (per.groupBy(length_col).agg(F.count(F.lit(1)).alias(count_col))
               .orderBy(length_col))
