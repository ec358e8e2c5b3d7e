"""Column helpers for projections, predicates and scalar functions.

All are built-in Spark expressions (JVM side, whole-stage codegen); no
Python runs per row.  MySQL semantics that differ from Spark's defaults
are spelled out (NULL-propagating GREATEST, whole-month differences,
full day names).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def _c(x) -> Column:
    return F.col(x) if isinstance(x, str) else x


def band(x, thresholds: Sequence[tuple[float, str]], else_: str) -> Column:
    """Ordered CASE: the first ``x >= min`` in list order wins (PRJ-03, AG-17)."""
    x = _c(x)
    out = None
    for lo, label in thresholds:
        out = F.when(x >= lo, F.lit(label)) if out is None else out.when(x >= lo, F.lit(label))
    return out.otherwise(F.lit(else_)) if out is not None else F.lit(else_)


def in_period(x, start: str, end: str) -> Column:
    """Half-open ``start <= x < end`` (FLT-05); both bounds reach the scan."""
    x = _c(x)
    return (x >= F.lit(start).cast("timestamp_ntz")) & (x < F.lit(end).cast("timestamp_ntz"))


def is_blank(x) -> Column:
    """``x IS NULL OR TRIM(x) = ''`` (FLT-07)."""
    x = _c(x)
    return x.isNull() | (F.trim(x) == "")


def not_accepted(x, values: Sequence) -> Column:
    """``x NOT IN (values) OR x IS NULL`` (FLT-08, DQ-20)."""
    x = _c(x)
    return ~x.isin(list(values)) | x.isNull()


def changed(old, new, null_counts: bool = False) -> Column:
    """``old <> new``; with NULL on either side it never matches unless asked (FLT-09)."""
    old, new = _c(old), _c(new)
    if null_counts:
        return ~old.eqNullSafe(new)
    return F.coalesce(old != new, F.lit(False))


def greatest_strict(*cols) -> Column:
    """MySQL GREATEST: NULL when any argument is NULL (T6)."""
    cs = [_c(c) for c in cols]
    any_null = cs[0].isNull()
    for c in cs[1:]:
        any_null = any_null | c.isNull()
    return F.when(~any_null, F.greatest(*cs))


def timestampdiff(unit: str, start: str, end: str) -> Column:
    """TIMESTAMPDIFF(unit, start, end) on column names: whole units (T4).

    Spark counts complete units like MySQL (31 Jan -> 28 Feb is 0 months).
    """
    return F.expr(f"timestampdiff({unit}, `{start}`, `{end}`)")


def make_ts(date_col, hour, minute, second) -> Column:
    """TIMESTAMP(date, MAKETIME(h, m, s)) as TIMESTAMP_NTZ (FN-16)."""
    d = _c(date_col)
    return F.make_timestamp_ntz(F.year(d), F.month(d), F.dayofmonth(d), _c(hour), _c(minute), _c(second))


def first_upper(x) -> Column:
    """``UPPER(LEFT(x,1)) || LOWER(SUBSTRING(x,2))`` (FN-05)."""
    x = _c(x)
    return F.concat(F.upper(F.left(x, F.lit(1))), F.lower(F.substring(x, 2, 1 << 30)))
