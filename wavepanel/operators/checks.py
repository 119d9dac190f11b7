"""Data checks that return their violations as DataFrames.

A check is a DataFrame of offending rows (empty = passed); ``enforce`` turns
it into an error with one small job (``limit(1)``).  Guards are never
written as an unread ``raise_error`` column, which the optimizer would prune.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from wavepanel.functions.labels import variable_labels
from wavepanel.functions.columns import cast_failures


def rule_violations(df: DataFrame, rules: Mapping[str, Column], keep: Sequence[str]) -> DataFrame:
    """Rows breaking any rule, one output row per (row, rule): ``rule, *keep``.

    ``rules`` maps a name to a condition that must NOT hold.  All rules are
    tested in one scan (an array of matching rule names, exploded).
    """
    names = F.array(*[F.when(F.coalesce(cond, F.lit(False)), F.lit(name)) for name, cond in rules.items()])
    hits = F.filter(names, lambda x: x.isNotNull())
    return (df.select(*keep, hits.alias("_wp_rules"))
              .where(F.size("_wp_rules") > 0)
              .select(F.explode("_wp_rules").alias("rule"), *keep))


def implies_missing(condition_col: str | Column, allowed_value, dependent: str | Column) -> Column:
    """Skip-logic rule: ``dependent`` must be missing unless
    ``condition_col == allowed_value``; a missing condition counts as "not
    equal" (so a filled dependent is then a violation)."""
    cc = F.col(condition_col) if isinstance(condition_col, str) else condition_col
    dc = F.col(dependent) if isinstance(dependent, str) else dependent
    return ~cc.eqNullSafe(F.lit(allowed_value)) & dc.isNotNull()


def enforce(violations: DataFrame, message: str) -> None:
    """Raise ``ValueError(message)`` when the violation frame has any row."""
    if violations.limit(1).count():
        raise ValueError(message)


def missing_report(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Per column: ``variable, n_present, n_missing`` (one aggregate)."""
    wide = df.agg(F.count(F.lit(1)).alias("__n"), *[F.count(c).alias(f"{c}__p") for c in cols])
    rows = F.array(*[F.struct(F.lit(c).alias("variable"), F.col(f"{c}__p").alias("n_present"),
                              (F.col("__n") - F.col(f"{c}__p")).alias("n_missing")) for c in cols])
    return wide.select(F.inline(rows))


def codebook(df: DataFrame) -> DataFrame:
    """Per column, in order: ``position, variable, dtype, label, n_present,
    n_missing``.  The labels are those that came with the table (column
    comments, which Parquet files and catalogue tables keep); one aggregate
    counts."""
    labels = variable_labels(df)
    rows = [(i, f.name, f.dataType.simpleString(), labels.get(f.name))
            for i, f in enumerate(df.schema.fields)]           # one row a column
    named = df.sparkSession.createDataFrame(
        rows, "position int, variable string, dtype string, label string")
    return (named.join(missing_report(df, df.columns), "variable")
            .select("position", "variable", "dtype", "label", "n_present", "n_missing"))


def cast_report(df: DataFrame, casts: Mapping[str, tuple[str | Column, str]]) -> DataFrame:
    """Per target: ``variable, dtype, n_present, n_failed`` where failed means
    a present value that the safe cast turns into NULL."""
    aggs, structs = [], []
    for name, (src, dtype) in casts.items():
        s = F.col(src) if isinstance(src, str) else src
        aggs += [F.count(s).alias(f"{name}__p"), cast_failures(s, dtype).alias(f"{name}__f")]
        structs.append(F.struct(F.lit(name).alias("variable"), F.lit(dtype).alias("dtype"),
                                F.col(f"{name}__p").alias("n_present"),
                                F.col(f"{name}__f").alias("n_failed")))
    return df.agg(*aggs).select(F.inline(F.array(*structs)))
