"""Finite test and zero-guarded cost ratios."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from costlens.constants import HOURS_PER_DAY, RBFE_NS_PER_EDGE

_INF = float("inf")


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def is_finite(c: Column | str) -> Column:
    """TRUE for finite numbers; FALSE for NaN and +-Infinity; NULL for NULL.

    Used as a filter it drops NULL, NaN and both infinities.
    """
    x = _col(c)
    return ~F.isnan(x) & (F.abs(x) != F.lit(_INF))


def json_double(c: Column | str) -> Column:
    """DOUBLE from a JSON leaf read as text.

    The JSON reader gives a number's text (``120.5``), a string's content
    (``75.25`` from ``"75.25"``) or, for the bare tokens NaN / Infinity, the
    token in quotes (``"NaN"``). One pair of surrounding quotes is removed,
    then the text is cast; malformed text fails the job as a cast would.
    """
    return F.regexp_replace(_col(c), r'^"(.*)"$', "$1").cast("double")


def safe_divide(num: Column | str, den: Column | str) -> Column:
    """``num / NULLIF(den, 0)``: NULL instead of an error or infinity on zero."""
    return _col(num) / F.nullif(_col(den), F.lit(0.0))


def dollars_per_ns(price_per_hour: Column | str, metric_value: Column | str) -> Column:
    """Daily price divided by the daily throughput."""
    return safe_divide(_col(price_per_hour) * F.lit(HOURS_PER_DAY), metric_value)


def ns_per_dollar(metric_value: Column | str, price_per_hour: Column | str) -> Column:
    """Daily throughput divided by the daily price."""
    return safe_divide(metric_value, _col(price_per_hour) * F.lit(HOURS_PER_DAY))


def dollars_per_edge(
    ns_per_dollar_col: Column | str, ns_per_edge: float = RBFE_NS_PER_EDGE
) -> Column:
    """Cost of one edge: ``ns_per_edge / ns_per_dollar``; NULL when that is 0 or NULL."""
    return safe_divide(F.lit(ns_per_edge), ns_per_dollar_col)
