"""Predicates and CASE projections: F4, F5, C1, C2, C5-C9."""

from __future__ import annotations

from typing import Iterable, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from aulastar import config as K


def _col(c: str | Column) -> Column:
    return F.col(c) if isinstance(c, str) else c


def matches_place(c: str | Column, pattern: str = K.PLACE_PATTERN) -> Column:
    """``UPPER(c) LIKE pattern`` (Catalyst turns a prefix into StartsWith)."""
    return F.upper(_col(c)).like(pattern)


def in_values(c: str | Column, values: Iterable) -> Column:
    """Exact membership (case- and accent-sensitive)."""
    return _col(c).isin(list(values))


def canonicalize(c: str | Column, canon: Sequence[tuple[str, Sequence[str]]] = K.SECTOR_CANON) -> Column:
    """Map upper-cased variants to a canonical value; anything else
    passes through unchanged so that it can be detected downstream."""
    c = _col(c)
    up = F.upper(c)
    out = None
    for value, variants in canon:
        cond = up.isin(list(variants))
        out = F.when(cond, F.lit(value)) if out is None else out.when(cond, F.lit(value))
    return c if out is None else out.otherwise(c)


def quality_flag(n: str | Column, d: str | Column, low_d: int = K.LOW_DENOMINATOR,
                 low_n: int = K.LOW_NUMERATOR) -> Column:
    """Ordered quality flag; the first matching rule wins."""
    n, d = _col(n), _col(d)
    return (F.when(d == 0, F.lit(K.FLAG_NO_DENOMINATOR))
            .when(n == 0, F.lit(K.FLAG_NO_NUMERATOR))
            .when(d < low_d, F.lit(K.FLAG_LOW_DENOMINATOR))
            .when(n < low_n, F.lit(K.FLAG_LOW_NUMERATOR))
            .otherwise(F.lit(K.FLAG_OK)))


def bool_label(c: str | Column, true_label: str, false_label: str = "") -> Column:
    """Boolean -> text label (null counts as false, like ``CASE WHEN``)."""
    return F.when(_col(c), F.lit(true_label)).otherwise(F.lit(false_label))


def trend_label(first: str | Column, last: str | Column) -> Column:
    """Lower is better."""
    first, last = _col(first), _col(last)
    return (F.when(last < first, F.lit(K.TREND_BETTER))
            .when(last > first, F.lit(K.TREND_WORSE))
            .otherwise(F.lit(K.TREND_SAME)))


def outlier_category(ratio: str | Column, flag: str | Column, high: float = K.OUTLIER_HIGH_RATIO,
                     low: float = K.OUTLIER_LOW_RATIO, ok: str = K.FLAG_OK) -> Column:
    """Ordered; a null ratio falls through to the flag test."""
    ratio, flag = _col(ratio), _col(flag)
    return (F.when(ratio > high, F.lit(K.OUTLIER_HIGH))
            .when(ratio < low, F.lit(K.OUTLIER_LOW))
            .when(flag != ok, F.lit(K.OUTLIER_REVIEW))
            .otherwise(F.lit(K.OUTLIER_NORMAL)))


def default_if_null(c: str | Column, value) -> Column:
    """``COALESCE(c, value)``."""
    return F.coalesce(_col(c), F.lit(value))
