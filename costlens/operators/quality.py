"""Row-level quality gates and key checks."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.functions.numeric import is_finite


def finite(df: DataFrame, *cols: str) -> DataFrame:
    """Keep rows whose listed columns are all finite (drops NULL, NaN, +-Inf)."""
    return df.where(reduce(lambda a, b: a & b, [is_finite(c) for c in cols]))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys that occur more than once, with their count.

    Joins on such keys multiply rows (kept on purpose, as in the reference);
    this report makes them visible.
    """
    return (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("rows"))
        .where(F.col("rows") > 1)
    )
