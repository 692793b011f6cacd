"""Wide-to-long reshapes. All are a single Expand per row: no shuffle."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.constants import DEFAULT_SYSTEMS, RBFE_PHASES
from costlens.functions.labels import phase_label, strip_suffix
from costlens.functions.numeric import json_double


def unpivot(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str] | Mapping[str, Column | str],
    name_col: str,
    value_col: str,
) -> DataFrame:
    """SQL ``UNPIVOT`` semantics: one row per non-NULL cell.

    ``values`` is a list of column names, or a mapping label -> column when
    the label written into ``name_col`` differs from the column. NULL cells
    are dropped (``DataFrame.unpivot`` alone keeps them).
    """
    if isinstance(values, Mapping):
        wide = df.select(
            *ids,
            *[(F.col(c) if isinstance(c, str) else c).alias(label) for label, c in values.items()],
        )
        labels = list(values)
    else:
        wide, labels = df, list(values)
    return wide.unpivot(list(ids), labels, name_col, value_col).where(
        F.col(value_col).isNotNull()
    )


def unpivot_suffixed(
    df: DataFrame,
    ids: Sequence[str],
    values: Sequence[str],
    suffixes: Sequence[str],
    name_col: str,
    label_col: str,
    value_col: str,
) -> DataFrame:
    """Unpivot ``<name>_<suffix>`` columns into (name, suffix label, value).

    The name loses one trailing ``_<suffix>``; the label is the first suffix
    whose ``LIKE '%_<suffix>'`` matches, else NULL. Both are applied to the
    column names as literals, so the optimizer folds them to constants and
    no pattern is evaluated per row. NULL values are dropped.
    """
    cells = [
        F.struct(
            strip_suffix(F.lit(c), suffixes).alias(name_col),
            phase_label(F.lit(c), suffixes).alias(label_col),
            F.col(c).alias(value_col),
        ).alias(c)
        for c in values
    ]
    long = df.select(*ids, *cells).unpivot(list(ids), list(values), "_metric", "_cell")
    return long.select(*ids, "_cell.*").where(F.col(value_col).isNotNull())


def md_long(raw: DataFrame, systems: Sequence[str] = DEFAULT_SYSTEMS) -> DataFrame:
    """MD run rows -> (run_date, run_id, system, ns_per_day), NULLs dropped."""
    return unpivot(
        raw,
        ["run_date", "run_id"],
        {s: json_double(s) for s in systems},
        "system",
        "ns_per_day",
    )


def rbfe_long(
    raw: DataFrame,
    systems: Sequence[str] = DEFAULT_SYSTEMS,
    phases: Sequence[str] = RBFE_PHASES,
) -> DataFrame:
    """RBFE run rows -> (run_date, run_id, system, phase, metric_value).

    Each system is an object with one leaf per phase; leaves arrive as text
    and are turned into DOUBLE here (``json_double``).
    """
    wide = raw.select(
        "run_date",
        "run_id",
        *[
            json_double(F.col(s).getField(p)).alias(f"{s}_{p}")
            for s in systems
            for p in phases
        ],
    )
    cols = [f"{s}_{p}" for s in systems for p in phases]
    return unpivot_suffixed(
        wide, ["run_date", "run_id"], cols, phases, "system", "phase", "metric_value"
    )


def system_sizes(metadata: DataFrame, systems: Sequence[str] = DEFAULT_SYSTEMS) -> DataFrame:
    """Metadata document (one struct column per system) -> (system, total_system_size).

    The size is the atom count of the complex phase, used for every phase.
    """
    return sizes_of(unpivot(metadata, [], list(systems), "system", "metadata"))


def sizes_of(entries: DataFrame) -> DataFrame:
    """(system, metadata) entries -> (system, total_system_size)."""
    return entries.select(
        "system", F.col("metadata.atoms.complex").cast("bigint").alias("total_system_size")
    )
