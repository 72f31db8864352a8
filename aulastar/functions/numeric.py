"""Numeric Column functions: X1 safe integer parse, C3 leap year, X8 decade,
C4 guarded ratio, A5/A7 exact decimal averages and ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def safe_int(c: str | Column) -> Column:
    """Keep only digits and ``-``, empty -> null, then integer.

    ``"1,234"`` -> 1234, ``"3.0"`` -> 30, ``"-3"`` -> -3, ``""`` -> null.
    Leftovers that are not an integer (``"12-3"``, ``"5-"``, overflow) give
    null (``try_cast``), which is the documented intent of the rule.
    """
    digits = F.regexp_replace(F.coalesce(_col(c), F.lit("")), r"[^0-9-]", "")
    # ``NULLIF(digits, '')`` is implied: ``try_cast('')`` is null already, and
    # leaving it out keeps the regex to one evaluation per value
    return digits.try_cast("int")


def is_leap_year(y: str | Column) -> Column:
    """Gregorian leap year."""
    y = _col(y)
    return ((y % 4) == 0) & (((y % 100) != 0) | ((y % 400) == 0))


def decade(y: str | Column) -> Column:
    """``y - y % 10``."""
    y = _col(y)
    return y - (y % 10)


def exact_ratio(n: str | Column, d: str | Column, scale: int = 2) -> Column:
    """``ROUND(n::NUMERIC / d, scale)`` on integers, half away from zero,
    in DECIMAL so no binary rounding creeps in.  Caller guards ``d``."""
    return F.round(_col(n).cast("decimal(20,0)") / _col(d).cast("decimal(20,0)"), scale)


def guarded_ratio(n: str | Column, d: str | Column, scale: int = 2) -> Column:
    """C4: null when the denominator is not positive, else the exact ratio."""
    return F.when(_col(d) > 0, exact_ratio(n, d, scale))


def ratio_of_sums(n: str | Column, d: str | Column, scale: int = 2) -> Column:
    """``ROUND(SUM(n)::NUMERIC / NULLIF(SUM(d), 0), scale)`` as an
    aggregate expression."""
    sn, sd = F.sum(_col(n)), F.sum(_col(d))
    # decimal(20,0) holds any bigint sum; dividing two of them keeps 18
    # decimals (two decimal(38,0) would keep only 6 and could round twice)
    return F.when(sd != 0, F.round(sn.cast("decimal(20,0)") / sd.cast("decimal(20,0)"), scale))


def exact_avg(c: str | Column, scale: int = 2) -> Column:
    """A5: ``ROUND(AVG(c), scale)`` of a DECIMAL column without Spark's
    intermediate rounding of ``avg``: sum and count, divided at scale 18."""
    c = _col(c)
    total = F.sum(c).cast("decimal(38,18)")
    return F.round(total / F.count(c).cast("decimal(38,0)"), scale)


def pct_change(cur: str | Column, prev: str | Column, scale: int = 2) -> Column:
    """W2 helper: ``ROUND(100.0 * (cur - prev) / NULLIF(prev, 0), scale)``."""
    cur, prev = _col(cur), _col(prev)
    return F.when(prev != 0, F.round(F.lit(100).cast("decimal(3,0)") * (cur - prev) / prev, scale))
