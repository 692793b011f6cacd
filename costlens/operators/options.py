"""Selector values: distinct sorted option lists and their defaults.

The lists are small (distinct concurrency levels or systems), computed with a
partial aggregate; only ``to_list`` and ``require_non_empty`` touch the
driver, and only on those small results.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


class NoOptionsError(ValueError):
    """Raised when a selector would have no values."""


def concurrency_options(fact: DataFrame, benchmark_type: str) -> DataFrame:
    """Distinct concurrency levels of one benchmark type, ascending.

    No phase filter is applied, also for RBFE (as in the reference).
    """
    return (
        fact.where(F.col("benchmark_type") == F.lit(benchmark_type))
        .select("mps_process_count")
        .distinct()
        .orderBy(F.asc_nulls_last("mps_process_count"))
    )


def system_options(
    fact: DataFrame, benchmark_type: str, phase: str | None = None
) -> DataFrame:
    """Distinct systems of one benchmark type (and phase), ascending."""
    rows = fact.where(F.col("benchmark_type") == F.lit(benchmark_type))
    if phase is not None:
        rows = rows.where(F.col("phase") == F.lit(phase))
    return rows.select("system").distinct().orderBy(F.asc_nulls_last("system"))


def default_option(options: DataFrame) -> DataFrame:
    """One row: the first option of the sorted list (the smallest value)."""
    c = options.columns[0]
    return options.agg(F.min(c).alias(c))


def require_non_empty(options: DataFrame, message: str) -> DataFrame:
    """Raise ``NoOptionsError(message)`` when ``options`` has no rows."""
    if options.isEmpty():
        raise NoOptionsError(message)
    return options


def guard(options: DataFrame, message: str) -> DataFrame:
    """One row (n_options, outcome): what ``require_non_empty`` would say, as a column.

    ``outcome`` is NULL where there are options, else ``message``. No job runs here.
    """
    n = F.count(F.lit(1))
    return options.agg(n.alias("n_options"), F.when(n == 0, F.lit(message)).alias("outcome"))


def to_list(options: DataFrame) -> list:
    """The option values as a Python list, in the frame's order."""
    c = options.columns[0]
    return [row[c] for row in options.collect()]
