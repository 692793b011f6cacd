"""The tables behind each dashboard chart, as lazy DataFrames.

Rendering is out of scope; these carry every value a chart shows, including
the winner flags the charts colour and the display-order keys.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.constants import (
    CONCURRENCY_LEVELS,
    INSTANCE_ORDER,
    MD,
    RBFE,
    RBFE_NS_PER_EDGE,
)
from costlens.functions.ordering import domain_position
from costlens.operators.enrich import edge_cost
from costlens.operators.rank import winner, winners
from costlens.operators.summarize import by_concurrency, scaling

COMPLEX = "complex"


def _flag_both(summary: DataFrame) -> DataFrame:
    return winners(
        summary,
        [("ns_per_day", False, "is_throughput_winner"), ("ns_per_dollar", False, "is_cost_winner")],
    )


def _by_system(df: DataFrame) -> DataFrame:
    return df.orderBy(
        F.asc_nulls_last("system"), F.asc_nulls_last(domain_position("instance_type", INSTANCE_ORDER)),
        F.asc_nulls_last("instance_type"),
    )


def md_comparison(view: DataFrame, mps_process_count: int, sizes: DataFrame | None = None) -> DataFrame:
    """MD medians at one concurrency with throughput and cost winners per system.

    Here and below, ``sizes`` is given where ``view`` has no size column; the
    sizes then join the finished groups.
    """
    return _by_system(_flag_both(by_concurrency(view, MD, mps_process_count, sizes=sizes, sort=False)))


def rbfe_summary(view: DataFrame, mps_process_count: int, sizes: DataFrame | None = None) -> DataFrame:
    """RBFE (complex phase) medians at one concurrency: what the next two tables show."""
    return by_concurrency(view, RBFE, mps_process_count, COMPLEX, sizes=sizes, sort=False)


def comparison_of(summary: DataFrame) -> DataFrame:
    """A summary with both winners."""
    return _by_system(_flag_both(summary))


def edge_cost_of(summary: DataFrame, ns_per_edge: float = RBFE_NS_PER_EDGE) -> DataFrame:
    """Dollars per edge from a summary's ns/$, cheapest instance flagged per system."""
    return _by_system(winner(edge_cost(summary, ns_per_edge), "dollars_per_edge", ascending=True, flag="is_winner"))


def rbfe_comparison(view: DataFrame, mps_process_count: int, sizes: DataFrame | None = None) -> DataFrame:
    """RBFE medians at one concurrency with both winners."""
    return comparison_of(rbfe_summary(view, mps_process_count, sizes))


def rbfe_edge_cost(
    view: DataFrame, mps_process_count: int, ns_per_edge: float = RBFE_NS_PER_EDGE, sizes: DataFrame | None = None
) -> DataFrame:
    """Dollars per edge from the median ns/$, cheapest instance flagged per system."""
    return edge_cost_of(rbfe_summary(view, mps_process_count, sizes), ns_per_edge)


def _scaling_order(df: DataFrame, first: str) -> DataFrame:
    inst = domain_position("instance_type", INSTANCE_ORDER)
    mps = domain_position("mps_process_count", CONCURRENCY_LEVELS)
    df = df.withColumn("instance_rank", inst).withColumn("mps_rank", mps)
    keys = {
        "instance_type": [F.asc_nulls_last("instance_rank"), F.asc_nulls_last("instance_type")],
        "mps_process_count": [F.asc_nulls_last("mps_rank"), F.asc_nulls_last("mps_process_count")],
    }
    second = "mps_process_count" if first == "instance_type" else "instance_type"
    return df.orderBy(*keys[first], *keys[second])


def md_scaling(
    view: DataFrame, system: str, counts: Sequence[int] = CONCURRENCY_LEVELS, sizes: DataFrame | None = None
) -> DataFrame:
    """MD medians of one system over concurrency levels, with display ranks."""
    return _scaling_order(scaling(view, MD, system, counts, sizes=sizes, sort=False), "mps_process_count")


def rbfe_scaling(
    view: DataFrame,
    system: str,
    counts: Sequence[int] = CONCURRENCY_LEVELS,
    ns_per_edge: float = RBFE_NS_PER_EDGE,
    sizes: DataFrame | None = None,
) -> DataFrame:
    """RBFE complex-phase medians of one system over concurrency, with edge cost."""
    summary = scaling(view, RBFE, system, counts, phase=COMPLEX, sizes=sizes, sort=False)
    return _scaling_order(edge_cost(summary, ns_per_edge), "instance_type")
