"""Column-expression builders (all JVM-side, codegen-friendly).

Each returns a ``Column``; none needs a Python UDF.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from rxlake.schemas import GERIATRIC_FROM_AGE, PEDIATRIC_BELOW_AGE


def _c(col) -> Column:
    return F.col(col) if isinstance(col, str) else col


def month_start(col) -> Column:
    """First day of the month as DATE (timestamp/date input)."""
    return F.date_trunc("month", _c(col)).cast("date")


def default_zero(col) -> Column:
    """coalesce(x, 0)."""
    return F.coalesce(_c(col), F.lit(0))


def is_pediatric(age="patient_age") -> Column:
    """Age < 18 (null age -> null)."""
    return _c(age) < PEDIATRIC_BELOW_AGE


def is_geriatric(age="patient_age") -> Column:
    """Age >= 65 (null age -> null)."""
    return _c(age) >= GERIATRIC_FROM_AGE


def variance(shipped="units_shipped", sold="units_sold") -> Column:
    """P10: shipped - sold."""
    return _c(shipped) - _c(sold)


def guarded_percent(num, den, digits: int = 2) -> Column:
    """NULL when den = 0, else round(100 * num / den, digits) as DOUBLE.

    CASE is evaluated lazily, so ANSI divide-by-zero never fires.
    """
    ratio = F.lit(100.0) * _c(num).cast("double") / _c(den).cast("double")
    return F.when(_c(den) == 0, F.lit(None).cast("double")).otherwise(F.round(ratio, digits))


def safe_ratio_percent(num, den, digits: int = 2) -> Column:
    """round(100 * num / nullif(den, 0), digits) as DOUBLE."""
    return F.round(F.lit(100.0) * _c(num).cast("double") / F.nullif(_c(den), F.lit(0)).cast("double"), digits)


def count_when(cond: Column) -> Column:
    """sum(case when cond then 1 else 0 end) as BIGINT (null cond counts 0)."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0))).cast("bigint")


def clamp_round_units(col) -> Column:
    """max(0, round-half-even(x)) as BIGINT (Python ``round`` semantics)."""
    return F.greatest(F.rint(_c(col)), F.lit(0.0)).cast("bigint")


def sortable(col: Column, dtype: str, ascending: bool) -> Column:
    """Map a column to a key whose ascending order is the requested order.

    Used to fold (key, direction) lists into one struct for ``min``.
    Descending works for numeric, date, timestamp and boolean columns.
    """
    if ascending:
        return col
    d = dtype.lower()
    if d in ("tinyint", "smallint", "int", "bigint") or d.startswith("decimal"):
        return -col.cast("decimal(38,0)") if not d.startswith("decimal") else -col
    if d in ("float", "double"):
        return -col
    if d == "date":
        return -F.unix_date(col)
    if d.startswith("timestamp"):
        return -F.unix_micros(col.cast("timestamp"))
    if d == "boolean":
        return ~col
    raise ValueError(f"descending dedup order not supported for type {dtype}")
