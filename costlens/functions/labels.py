"""Labels taken from wide column names such as ``bace_complex``."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def strip_suffix(name: Column, suffixes: Sequence[str]) -> Column:
    """Remove one trailing ``_<suffix>`` (regex ``_(a|b)$``)."""
    alternatives = "|".join(suffixes)
    return F.regexp_replace(name, f"_({alternatives})$", "")


def phase_label(name: Column, phases: Sequence[str]) -> Column:
    """First phase whose SQL pattern ``%_<phase>`` matches, else NULL.

    ``_`` is the LIKE single-character wildcard, so ``xcomplex`` matches
    ``complex`` while ``complex`` alone does not.
    """
    expr = None
    for phase in phases:
        cond = name.like(f"%_{phase}")
        expr = F.when(cond, F.lit(phase)) if expr is None else expr.when(cond, F.lit(phase))
    return expr
