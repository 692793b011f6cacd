"""Custom display order: listed values first, in list order, then the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def domain_position(c: Column | str, domain: Sequence) -> Column:
    """1-based position of the value in ``domain``; NULL when not listed."""
    x = F.col(c) if isinstance(c, str) else c
    values = F.array(*[F.lit(v) for v in domain])
    return F.nullif(F.array_position(values, x), F.lit(0))


def domain_order(c: Column | str, domain: Sequence) -> list[Column]:
    """Sort expressions: listed values in list order, others after, by value."""
    x = F.col(c) if isinstance(c, str) else c
    return [F.asc_nulls_last(domain_position(x, domain)), F.asc_nulls_last(x)]
