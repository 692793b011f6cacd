"""Row numbers and running totals over one global order, without a one-task window.

Rows are range-partitioned and sorted by the order, and each gets its partition
and its place in it as one number (``monotonically_increasing_id`` packs both).
That is written once, because a second evaluation could cut the ranges
elsewhere. What the partitions before hold is a sum over one row per partition.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens.sources.scratch import stored

_PLACE_BITS = 33  # of monotonically_increasing_id: the place within the partition


def _ranged(df: DataFrame, order: Sequence[Column], label: str) -> DataFrame:
    placed = df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("_at", F.monotonically_increasing_id())
    return stored(placed, label).withColumn("_part", F.shiftright("_at", _PLACE_BITS))


def _before(ranged: DataFrame, totals: Mapping[str, Column]) -> DataFrame:
    """(_part, one column per total): the totals of all partitions before; one row per partition."""
    parts = ranged.groupBy("_part").agg(*[total.alias(name) for name, total in totals.items()])
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    return parts.select("_part", *[F.coalesce(F.sum(name).over(earlier), F.lit(0)).alias(name) for name in totals])


def number_rows(df: DataFrame, order: Sequence[Column], name: str = "position") -> DataFrame:
    """``df`` with the 1-based place of each row in ``order`` (long).

    Rows that tie in ``order`` get consecutive numbers in no fixed order, and sit
    in one partition: give enough columns to tell rows apart. One exchange.
    """
    ranged = _ranged(df, order, "numbered")
    before = _before(ranged, {"_rows": F.count(F.lit(1))})
    place = F.col("_at").bitwiseAND(F.lit((1 << _PLACE_BITS) - 1))
    return ranged.join(before, "_part").select(*df.columns, (place + F.col("_rows") + 1).alias(name))


def running_totals(df: DataFrame, order: Sequence[Column], totals: Mapping[str, str]) -> DataFrame:
    """``df`` with, per entry of ``totals``, the sum of that column over all rows before (long).

    ``totals`` maps new names to integer columns. Ties as in ``number_rows``.
    """
    ranged = _ranged(df, order, "running")
    before = _before(ranged, {f"_{name}": F.sum(column) for name, column in totals.items()})
    earlier = Window.partitionBy("_part").orderBy("_at").rowsBetween(Window.unboundedPreceding, -1)
    sums = {name: (F.coalesce(F.sum(column).over(earlier), F.lit(0)) + F.col(f"_{name}")).cast("long") for name, column in totals.items()}
    return ranged.join(before, "_part").withColumns(sums).select(*df.columns, *totals)
