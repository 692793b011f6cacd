"""Exact grouped medians by distributed selection, one lazy plan for groups of every size.

1. The input becomes a histogram: rows (group, value) -> count, combined within
   each task before the one exchange of the data, which is by group and value,
   so a group is spread over all tasks. All later steps read this exchange.
2. The middle ranks are located in the histogram by prefix counts over buckets
   of values, narrowed twice: buckets of equal ratio (no look at the data needed),
   then equal parts between the smallest and largest value of the bucket found.
   Counts per bucket are combined before their exchange, and a window adds
   them up; the number of buckets, not that of rows, bounds a window.
3. Prefix counts over the values of the last bucket give the middle values.

A rank whose first bucket holds one value is settled there and takes no part in
the joins of the later steps: groups of few rows, or of few different values,
mostly end so.

A bucket of the last step spans a ratio of ``1 / (RATIO_STEPS * PARTS)``; so it
holds at most 2**53 times that, about 8 million, different doubles, and
usually a few. Nothing is sampled, collected, checkpointed or
broadcast by hint, and no count decides between algorithms.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

#: Buckets of the first step per factor of e, and of the second step.
RATIO_STEPS = 1024
PARTS = 1 << 20
#: Above -ln of the smallest double.
_SHIFT = 746


def _ratio_bucket(v: Column, steps: int) -> Column:
    """Number of the bucket of ``v``: never falls as ``v`` rises (NaN is the largest)."""
    size = F.floor(steps * F.least(F.log(F.abs(v)) + _SHIFT, F.lit(2.0 * _SHIFT))).cast("long") + 1
    return F.when(F.isnan(v), F.lit(1 << 40)).when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size)


def _part_bucket(v: Column, low: Column, high: Column, parts: int) -> Column:
    """Number of the part of [low, high] that holds ``v``; ends that are not finite make one part."""
    share = F.try_divide(v - low, high - low)  # null in a bucket of one value
    return F.coalesce(F.floor(F.nanvl(share, F.lit(0.0)) * parts), F.lit(0)).cast("long")


def _hits(counted: DataFrame, by: Sequence[str], code: str) -> DataFrame:
    """The buckets of ``counted`` that hold the wanted rank ``_rank``, which becomes the rank within."""
    upto = F.sum("_c").over(Window.partitionBy(*by).orderBy(code).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.col("_upto") - F.col("_c")
    found = counted.withColumn("_upto", upto).where((F.col("_rank") <= F.col("_upto")) & (F.col("_rank") > before))
    return found.select(*by, (F.col("_rank") - before).alias("_rank"), "_low", "_high")


def grouped_median(
    df: DataFrame,
    keys: Sequence[str],
    values: Mapping[str, Column | str],
    ratio_steps: int = RATIO_STEPS,
    parts: int = PARTS,
) -> DataFrame:
    """Exact median of each value column per group of ``keys``.

    Returns one row per group (NULL keys form their own group) with the key
    columns followed by one column per entry of ``values``. NULL values do not
    count; a group whose values are all NULL gets a NULL median. For an even
    count the two middle values are averaged as Spark's ``percentile`` does.
    NaN is larger than any other value.
    """
    keys, names = list(keys), list(values)
    vals = [f"_v{i}" for i in range(len(names))]
    cols = [F.col(c) if isinstance(c, str) else c for c in values.values()]
    rows = df.select(*keys, *[c.cast("double").alias(v) for c, v in zip(cols, vals)])
    stacked = rows.select(*keys, F.inline(F.array(*[F.struct(F.lit(i).alias("_k"), F.col(v).alias("_v")) for i, v in enumerate(vals)])))
    # NULLs as a column of their own: a join below then adds no filter, and all steps read the same exchange.
    whole = stacked.select(*keys, "_k", F.col("_v").isNotNull().alias("_has"), F.coalesce("_v", F.lit(0.0)).alias("_v"))
    histogram = whole.groupBy(*keys, "_k", "_has", "_v").agg(F.count(F.lit(1)).alias("_n"))

    # First step: every group's count gives its middle ranks, one if it is odd.
    of_group = Window.partitionBy(*keys, "_k")
    v, n = F.col("_v"), F.col("_of")
    spread = [F.sum("_n").alias("_c"), F.min("_v").alias("_low"), F.max("_v").alias("_high")]
    buckets = histogram.groupBy(*keys, "_k", "_has", _ratio_bucket(v, ratio_steps).alias("_code")).agg(*spread)
    valued = F.when(F.col("_has"), F.col("_c")).otherwise(F.lit(0))
    counted = buckets.withColumn("_of", F.sum(valued).over(of_group))
    middle = F.array_distinct(F.array(F.floor((n + 1) / 2), F.floor(n / 2) + 1))
    upto = F.sum(valued).over(of_group.orderBy("_has", "_code").rowsBetween(Window.unboundedPreceding, Window.currentRow))
    before = F.col("_upto") - valued
    inside = lambda r: (r <= F.col("_upto")) & (r > before)
    wanted = F.when(n == 0, F.array(F.lit(0).cast("long"))).otherwise(F.filter(middle, inside))
    ranks = counted.withColumn("_upto", upto).withColumn("_t", F.explode(wanted))
    state = ranks.select(*keys, "_k", "_has", "_t", (F.col("_t") - before).alias("_rank"), "_low", "_high", "_of")

    # Second step and last: the histogram's rows between the ends of the bucket found, where it holds several values.
    by = [*keys, "_k", "_has", "_t"]
    at = state.where("_of > 0 and _low < _high").drop("_of")
    for code in (_part_bucket(v, F.col("_low"), F.col("_high"), parts), v):
        h, a = histogram.alias("h"), at.alias("a")
        match = [F.col(f"h.`{c}`").eqNullSafe(F.col(f"a.`{c}`")) for c in keys]
        match += [F.col(f"h.{c}") == F.col(f"a.{c}") for c in ("_k", "_has")]
        match += [F.col("h._v") >= F.col("a._low"), F.col("h._v") <= F.col("a._high")]
        joined = h.join(a, reduce(lambda x, y: x & y, match)).select(*[F.col(f"a.`{c}`") for c in by], "_rank", "_v", "_n", "_low", "_high")
        counted = joined.withColumn("_code", code).groupBy(*by, "_rank", "_code").agg(*spread)
        at = _hits(counted, by, "_code")

    # Groups without any value, and ranks whose first bucket holds one value, are in ``state`` alone.
    known = F.when(F.col("_of") > 0, F.col("_low")).alias("_m")
    settled = state.where("_of = 0 or _low = _high").select(*keys, "_k", known)
    both = at.select(*keys, "_k", F.col("_low").alias("_m")).unionByName(settled)
    low_high = [[f(F.when(F.col("_k") == i, F.col("_m"))) for f in (F.min, F.max)] for i in range(len(names))]
    mean = [F.when(a == b, a).otherwise(F.lit(0.5) * a + F.lit(0.5) * b).alias(name) for name, (a, b) in zip(names, low_high)]
    return both.groupBy(*keys).agg(*mean)
