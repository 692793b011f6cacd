"""Best option per group with a deterministic tie-break.

The first row of a group is the one whose ordering struct equals the group's
``min`` of that struct, taken by a window over the group, so the input is read
once for all flags. Input is a finished summary: a group has one row per
option, not per measurement. Where the position of every row is asked for, rows are
numbered in the same order and the same exchange.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

_SIMPLE = (
    T.StringType,
    T.NumericType,
    T.BooleanType,
    T.DateType,
    T.TimestampType,
    T.TimestampNTZType,
)


def order_key(
    metric: str,
    ascending: bool,
    tie: Sequence[str],
    rest: Sequence[str] = (),
) -> Column:
    """Struct whose ``min`` is the first row of the requested order.

    Order: metric (NULLs last; descending puts NaN first, as Spark sorts it),
    then ``tie`` ascending, then ``rest`` ascending so that only identical rows
    can tie.
    """
    m = F.col(metric)
    fields = [m.isNull().alias("_null")]
    if ascending:
        fields.append(m.alias("_m"))
    else:
        # Negated as DOUBLE: negating the smallest BIGINT would overflow.
        fields += [(~F.isnan(m)).alias("_nan_last"), (-m.cast("double")).alias("_m")]
    for label, cols in (("_tie", tie), ("_rest", rest)):
        for i, c in enumerate(cols):
            # Ascending with NULLs last, as SQL orders by default.
            fields += [F.col(c).isNull().alias(f"{label}{i}_null"), F.col(c).alias(f"{label}{i}")]
    return F.struct(*fields)


def winners(
    df: DataFrame,
    specs: Sequence[tuple[str, bool, str]],
    partition: Sequence[str] = ("system",),
    tie: Sequence[str] = ("instance_type",),
    rank: str | None = None,
) -> DataFrame:
    """Add one winner flag per ``(metric, ascending, flag)`` spec.

    The flag is TRUE on the first row of each ``partition`` group: highest
    metric (lowest when ``ascending``), NULL metrics last, then the smallest
    ``tie`` values, then the remaining columns so that only identical rows can
    tie. A row whose metric is NULL is never flagged. With ``rank``, a column
    of that name numbers the rows of each group in the order of the first spec.
    """
    partition = list(partition)
    keys = []
    for metric, ascending, _ in specs:
        rest = [
            f.name
            for f in df.schema.fields
            if f.name not in (metric, *partition, *tie) and isinstance(f.dataType, _SIMPLE)
        ]
        keys.append(order_key(metric, ascending, tie, rest))
    # The first key of a group needs no order: one exchange and one window for all specs.
    group = Window.partitionBy(*partition)
    firsts = {f"_first{i}": F.min(key).over(group) for i, key in enumerate(keys)}
    if rank:
        firsts[rank] = F.row_number().over(group.orderBy(keys[0]))
    flags = {
        flag: key.eqNullSafe(F.col(f"_first{i}")) & F.col(metric).isNotNull()
        for i, ((metric, _, flag), key) in enumerate(zip(specs, keys))
    }
    return df.withColumns(firsts).withColumns(flags).select(*df.columns, *flags, *([rank] if rank else []))


def winner(
    df: DataFrame,
    metric: str,
    ascending: bool = False,
    partition: Sequence[str] = ("system",),
    tie: Sequence[str] = ("instance_type",),
    flag: str = "is_winner",
    rank: str | None = None,
) -> DataFrame:
    """One winner flag; see ``winners``."""
    return winners(df, [(metric, ascending, flag)], partition, tie, rank)
