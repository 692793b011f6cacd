"""All chart tables of the analysis for one selection, with default selections.

A selection that is not given is the smallest concurrency level or first system
of its section; only those small option lists are collected. The tables are
lazy: no job runs while they are built.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame

from costlens.constants import MD, RBFE
from costlens.operators import options
from costlens.plans import chart_tables

COMPLEX = "complex"


@dataclass(frozen=True)
class Selection:
    md_mps: int
    md_system: str
    rbfe_mps: int
    rbfe_system: str


def _first(opts: DataFrame, message: str):
    return options.to_list(options.require_non_empty(options.default_option(opts).dropna(), message))[0]


def _md(fact: DataFrame, mps: int | None, system: str | None) -> tuple[int, str]:
    if mps is None:
        mps = _first(options.concurrency_options(fact, MD), "The MD fact has no concurrency levels.")
    if system is None:
        system = _first(options.system_options(fact, MD), "The MD fact has no systems.")
    return mps, system


def _rbfe(fact: DataFrame, mps: int | None, system: str | None) -> tuple[int, str]:
    if mps is None:
        mps = _first(options.concurrency_options(fact, RBFE), "The RBFE fact has no concurrency levels.")
    if system is None:
        system = _first(options.system_options(fact, RBFE, COMPLEX), "The RBFE fact has no complex-phase systems.")
    return mps, system


def resolve_selection(
    md_fact: DataFrame,
    rbfe_fact: DataFrame,
    md_mps: int | None = None,
    md_system: str | None = None,
    rbfe_mps: int | None = None,
    rbfe_system: str | None = None,
) -> Selection:
    """The given values; each missing one by one small query over its own fact."""
    return Selection(*_md(md_fact, md_mps, md_system), *_rbfe(rbfe_fact, rbfe_mps, rbfe_system))


def default_selection(md_fact: DataFrame, rbfe_fact: DataFrame) -> Selection:
    """Smallest concurrency level and first system of each section."""
    return resolve_selection(md_fact, rbfe_fact)


def md_tables(view: DataFrame, mps: int, system: str, sizes: DataFrame | None = None) -> dict[str, DataFrame]:
    return {
        "md_comparison": chart_tables.md_comparison(view, mps, sizes),
        "md_scaling": chart_tables.md_scaling(view, system, sizes=sizes),
    }


def rbfe_tables(view: DataFrame, mps: int, system: str, sizes: DataFrame | None = None) -> dict[str, DataFrame]:
    summary = chart_tables.rbfe_summary(view, mps, sizes)
    return {
        "rbfe_comparison": chart_tables.comparison_of(summary),
        "rbfe_edge_cost": chart_tables.edge_cost_of(summary),
        "rbfe_scaling": chart_tables.rbfe_scaling(view, system, sizes=sizes),
    }


def chart_set(
    md_view: DataFrame,
    rbfe_view: DataFrame,
    selection: Selection | None = None,
    sizes: DataFrame | None = None,
) -> dict[str, DataFrame]:
    """The five chart tables for ``selection`` (defaults when not given).

    The views are priced facts (``with_price``) with ``sizes``, or cost-enriched
    facts (``with_prices``) without.
    """
    sel = selection or default_selection(md_view, rbfe_view)
    return {
        **md_tables(md_view, sel.md_mps, sel.md_system, sizes),
        **rbfe_tables(rbfe_view, sel.rbfe_mps, sel.rbfe_system, sizes),
    }
