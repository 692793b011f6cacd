"""Median summaries of the priced fact."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.constants import CONCURRENCY_LEVELS
from costlens.operators.enrich import with_sizes
from costlens.operators.median import grouped_median
from costlens.operators.ordered import number_rows

SUMMARY_VALUES = {"ns_per_day": "metric_value", "ns_per_dollar": "ns_per_dollar"}


def _filtered(view: DataFrame, benchmark_type: str, phase: str | None) -> DataFrame:
    out = view.where(F.col("benchmark_type") == F.lit(benchmark_type))
    if phase is not None:
        out = out.where(F.col("phase") == F.lit(phase))
    return out


def medians(view: DataFrame, keys: Sequence[str], sizes: DataFrame | None) -> DataFrame:
    """Both medians per group of ``keys`` and system size.

    With ``sizes``, ``view`` needs no size column: a system's size is joined to
    the finished groups, not to the fact. The rows are the same, also where a
    system has several sizes or repeated ones: each size then makes a group of
    all the system's rows, and repeating rows does not move a median.
    """
    if sizes is None:
        return grouped_median(view, [*keys, "total_system_size"], SUMMARY_VALUES)
    return with_sizes(grouped_median(view, keys, SUMMARY_VALUES), sizes.distinct())


def by_concurrency(
    view: DataFrame,
    benchmark_type: str,
    mps_process_count: int,
    phase: str | None = None,
    sizes: DataFrame | None = None,
    sort: bool = True,
) -> DataFrame:
    """Medians per instance type and system at one concurrency level.

    Columns: mps_process_count, instance_type, ns_per_day, ns_per_dollar,
    system, total_system_size; sorted by system, then ns_per_day descending
    (``sort=False`` skips the global sort when the caller re-orders anyway).
    ``sizes``: see ``medians``.
    """
    rows = _filtered(view, benchmark_type, phase).where(F.col("mps_process_count") == F.lit(mps_process_count))
    out = medians(rows, ["mps_process_count", "instance_type", "system"], sizes).select(
        "mps_process_count", "instance_type", "ns_per_day", "ns_per_dollar", "system", "total_system_size"
    )
    if not sort:
        return out
    return out.orderBy(*by_concurrency_order())


def scaling(
    view: DataFrame,
    benchmark_type: str,
    system: str,
    counts: Sequence[int] = CONCURRENCY_LEVELS,
    phase: str | None = None,
    order: Sequence[str] = ("mps_process_count", "instance_type"),
    sizes: DataFrame | None = None,
    sort: bool = True,
) -> DataFrame:
    """Medians per concurrency level and instance type for one system.

    Columns: system, mps_process_count, instance_type, ns_per_day,
    ns_per_dollar, total_system_size; sorted by ``order`` ascending. The
    system is a bound value, so no quoting is involved.
    """
    rows = _filtered(view, benchmark_type, phase).where(
        (F.col("system") == F.lit(system)) & F.col("mps_process_count").isin(list(counts))
    )
    out = medians(rows, ["system", "mps_process_count", "instance_type"], sizes).select(
        "system", "mps_process_count", "instance_type", "ns_per_day", "ns_per_dollar", "total_system_size"
    )
    if not sort:
        return out
    return out.orderBy(*scaling_order(order))


def by_concurrency_order() -> list[Column]:
    return [F.asc_nulls_last("system"), F.desc_nulls_last("ns_per_day")]


def scaling_order(order: Sequence[str] = ("mps_process_count", "instance_type")) -> list[Column]:
    return [F.asc_nulls_last(c) for c in order]


def positions(summary: DataFrame, order: Sequence[Column]) -> DataFrame:
    """``summary`` with ``position``, the place of each row in ``order``; ties follow the remaining columns."""
    return number_rows(summary, [*order, *[F.asc_nulls_last(c) for c in summary.columns]])
