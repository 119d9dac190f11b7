"""Column-level operators: each returns a ``Column`` built from Spark
expressions only, so it compiles into whole-stage codegen.

pandas treats a missing value as "not equal" and "not in"; Spark's SQL logic
is three-valued.  Each helper states which of the two it follows.
"""

from __future__ import annotations

import re
from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _c(x: str | Column) -> Column:
    return F.col(x) if isinstance(x, str) else x


# --- column families (P3-P5, P15, P16) -------------------------------------

def columns_matching(df_or_cols: DataFrame | Sequence[str], pattern: str,
                     anchored: bool = False) -> list[str]:
    """Column names matching a regular expression, in table order.

    The default is an unanchored *search* (``Q10_.*`` also takes ``XQ10_2``),
    which is what a pandas ``filter(regex=...)`` does; ``anchored=True``
    requires the whole name to match.
    """
    cols = df_or_cols.columns if isinstance(df_or_cols, DataFrame) else list(df_or_cols)
    rx = re.compile(pattern)
    test = rx.fullmatch if anchored else rx.search
    return [c for c in cols if test(c)]


def numbered(prefix: str, first: int, last: int, suffix: str = "") -> list[str]:
    """``prefix{i}suffix`` for i in first..last (a fixed numbered family)."""
    return [f"{prefix}{i}{suffix}" for i in range(first, last + 1)]


def existing(df: DataFrame, names: Iterable[str]) -> list[str]:
    """The subset of ``names`` present in ``df``, in the order given."""
    have = set(df.columns)
    return [n for n in names if n in have]


def family_merge(df: DataFrame, update_pattern: str = r"^D(HH2_\d+)$") -> list[Column]:
    """Merge an update family into its base family by name.

    Each column matching ``update_pattern`` fills the gaps of the base column
    named by the pattern's first group (``DHH2_1`` -> ``HH2_1``).  Returns the
    merged columns aliased to the base names; a base column that does not
    exist is created from the update column alone.
    """
    rx = re.compile(update_pattern)
    out = []
    for name in df.columns:
        m = rx.fullmatch(name)
        if not m:
            continue
        base = m.group(1)
        src = F.coalesce(F.col(base), F.col(name)) if base in df.columns else F.col(name)
        out.append(src.alias(base))
    return out


def family_overwrite(flag: Column, old: Sequence[str], new: Sequence[str]) -> list[Column]:
    """On rows where ``flag`` is true take ``new[i]`` for ``old[i]`` (by position)."""
    if len(old) != len(new):
        raise ValueError(f"families differ in length: {len(old)} vs {len(new)}")
    f = F.coalesce(flag, F.lit(False))
    return [F.when(f, F.col(n)).otherwise(F.col(o)).alias(o) for o, n in zip(old, new)]


# --- value recodes (P6, P8-P12, P14, P17-P19) -------------------------------

def sentinel_fill(x: str | Column, sentinel: int = -1, dtype: str = "tinyint") -> Column:
    """Missing -> ``sentinel``, then narrow to a small integer type."""
    return F.coalesce(_c(x), F.lit(sentinel)).cast(dtype)


def recode(x: str | Column, mapping: Mapping, dtype: str | None = None) -> Column:
    """Value map; unmapped and missing values become NULL."""
    xc = _c(x)
    expr = None
    for k, v in mapping.items():
        expr = (F.when(xc == F.lit(k), F.lit(v)) if expr is None
                else expr.when(xc == F.lit(k), F.lit(v)))
    if expr is None:
        expr = F.lit(None)
    return expr.cast(dtype) if dtype else expr


def member_flag(x: str | Column, values: Iterable, dtype: str = "double") -> Column:
    """1 if ``x`` is one of ``values``, 0 if not, NULL if ``x`` is missing."""
    return _c(x).isin(list(values)).cast(dtype)


def equals_flag(x: str | Column, value, dtype: str = "smallint") -> Column:
    """1 if ``x == value`` else 0; a missing ``x`` counts as not equal."""
    return F.coalesce(_c(x) == F.lit(value), F.lit(False)).cast(dtype)


def any_equals_flag(cols: Sequence[str | Column], value=1, dtype: str = "smallint") -> Column:
    """1 if any of ``cols`` equals ``value`` else 0 (missing -> not equal)."""
    cond = F.lit(False)
    for c in cols:
        cond = cond | F.coalesce(_c(c) == F.lit(value), F.lit(False))
    return cond.cast(dtype)


def not_equal_or_missing(x: str | Column, value) -> Column:
    """pandas ``x != value``: true when ``x`` is missing."""
    return ~_c(x).eqNullSafe(F.lit(value))


def score_answer(x: str | Column, correct, tolerance: float | None = None,
                 dtype: str = "double") -> Column:
    """1/0 for a right/wrong answer, NULL when unanswered.

    With ``tolerance`` the answer is right when ``|x - correct| < tolerance``.
    """
    xc = _c(x)
    ok = (F.abs(xc - F.lit(correct)) < F.lit(tolerance)) if tolerance is not None else (xc == F.lit(correct))
    return ok.cast(dtype)


def first_present(*cols: str | Column) -> Column:
    """First non-missing value of several columns (left to right)."""
    return F.coalesce(*[_c(c) for c in cols])


def row_sum(cols: Sequence[str | Column], min_count: int | None = None) -> Column:
    """Row-wise sum of the non-missing parts; NULL when fewer than
    ``min_count`` parts are present (default: all of them)."""
    cs = [_c(c) for c in cols]
    need = len(cs) if min_count is None else min_count
    present = sum((c.isNotNull().cast("int") for c in cs), F.lit(0))
    total = sum((F.coalesce(c, F.lit(0)) for c in cs), F.lit(0))
    return F.when(present >= F.lit(need), total)


def interval_recode(x: str | Column, rules: Sequence[tuple], otherwise: str = "keep") -> Column:
    """Recode closed integer intervals: ``rules = [(lo, hi, new), ...]``.

    ``new=None`` makes the interval missing.  Values matching no rule pass
    through unchanged (``otherwise="keep"``) or become NULL (``"null"``).
    """
    xc = _c(x)
    expr = None
    for lo, hi, new in rules:
        val = F.lit(new)
        cond = xc.between(F.lit(lo), F.lit(hi))
        expr = F.when(cond, val) if expr is None else expr.when(cond, val)
    rest = xc if otherwise == "keep" else F.lit(None)
    return rest if expr is None else expr.otherwise(rest)


def clamp_low(x: str | Column, low: float = 0.0) -> Column:
    """``max(low, x)``; a missing value becomes ``low`` (Stata ``max`` semantics)."""
    return F.greatest(F.lit(low), _c(x))


def cut(x: str | Column, edges: Sequence[float]) -> Column:
    """Left-closed binning to the lower edge: ``e[i] <= x < e[i+1]`` -> ``e[i]``.

    Values below the first edge, at or above the last one, or missing give
    NULL.  Compiled as a CASE chain (codegen-friendly, no array function).
    """
    xc = _c(x)
    edges = list(edges)
    expr = F.when(xc < F.lit(edges[0]), F.lit(None).cast("double"))
    for lo, hi in zip(edges[:-1], edges[1:]):
        expr = expr.when(xc < F.lit(hi), F.lit(float(lo)))
    return expr


def cut_index(x: str | Column, edges: Sequence[float]) -> Column:
    """1-based index of the bin of ``x`` under ``cut`` (NULL outside)."""
    xc = _c(x)
    edges = list(edges)
    expr = F.when(xc < F.lit(edges[0]), F.lit(None).cast("int"))
    for i, hi in enumerate(edges[1:], start=1):
        expr = expr.when(xc < F.lit(hi), F.lit(i))
    return expr


def rescale(x: str | Column, factor: float = 100.0) -> Column:
    return _c(x) * F.lit(factor)


# --- dates (P21) -------------------------------------------------------------

def reference_year(d: str | Column, anchor: str = "roll_back") -> Column:
    """Calendar year most of a trailing-12-month report falls into.

    The report period is taken to end at the start of the interview month;
    an interview dated on the 1st rolls back one whole month first (the
    behaviour of subtracting a month-begin offset).  The year is the
    interview year, minus one when that month start is in January..June.
    ``anchor="month_start"`` skips the roll-back of dates on the 1st.
    """
    dc = _c(d)
    month_start = F.trunc(F.to_date(dc), "MM")
    if anchor == "roll_back":
        beg = F.when(F.dayofmonth(dc) == 1, F.add_months(month_start, -1)).otherwise(month_start)
    elif anchor == "month_start":
        beg = month_start
    else:
        raise ValueError("anchor must be 'roll_back' or 'month_start'")
    return (F.year(dc) - (F.month(beg) <= 6).cast("int")).cast("int")


# --- safe casts (P13) --------------------------------------------------------

def try_cast(x: str | Column, dtype: str) -> Column:
    """Cast that gives NULL instead of an error on overflow or bad input."""
    return _c(x).try_cast(dtype)


def cast_failures(x: str | Column, dtype: str) -> Column:
    """Aggregate: rows whose value is present but does not survive the cast."""
    xc = _c(x)
    return F.count_if(xc.isNotNull() & xc.try_cast(dtype).isNull())
