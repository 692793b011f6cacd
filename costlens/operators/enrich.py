"""Cost-enriched fact: the fact joined with prices and system sizes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.constants import RBFE_NS_PER_EDGE
from costlens.functions.numeric import dollars_per_edge, dollars_per_ns, ns_per_dollar


def with_price(fact: DataFrame, prices: DataFrame) -> DataFrame:
    """Fact columns in their own order, then price and both ratios.

    A LEFT join on equality: a fact row with an unknown instance type keeps a
    NULL price and NULL ratios; duplicate prices multiply its rows, as in the
    reference. The planner and adaptive execution choose the strategy.
    """
    b, p = fact.alias("b"), prices.alias("p")
    joined = b.join(p, F.col("b.instance_type") == F.col("p.instance_type"), "left")
    price = F.col("p.price_per_hour")
    value = F.col("b.metric_value")
    return joined.select(
        *[F.col(f"b.{c}") for c in fact.columns],
        price.alias("price_per_hour"),
        dollars_per_ns(price, value).alias("dollars_per_ns"),
        ns_per_dollar(value, price).alias("ns_per_dollar"),
    )


def with_sizes(df: DataFrame, sizes: DataFrame) -> DataFrame:
    """``df`` with the size of its system, NULL if unknown (LEFT join)."""
    b, s = df.alias("b"), sizes.alias("s")
    joined = b.join(s, F.col("b.system") == F.col("s.system"), "left")
    return joined.select(*[F.col(f"b.{c}") for c in df.columns], F.col("s.total_system_size"))


def with_sizes_spread(df: DataFrame, sizes: DataFrame, ways: int) -> DataFrame:
    """``with_sizes`` by a join on system and one of ``ways`` salts.

    Each row gets a salt from its own values and each size all salts, so an
    exchange puts a system's rows into up to ``ways`` tasks. Rows and values are those of
    ``with_sizes``, also for null, unknown and repeated systems.
    """
    salt = F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in df.columns]), F.lit(ways)).cast("int")
    b = df.withColumn("_salt", salt).alias("b")
    s = sizes.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(ways - 1)))).alias("s")
    joined = b.join(s, (F.col("b.system") == F.col("s.system")) & (F.col("b._salt") == F.col("s._salt")), "left")
    return joined.select(*[F.col(f"b.`{c}`") for c in df.columns], F.col("s.total_system_size"))


def with_prices(fact: DataFrame, prices: DataFrame, sizes: DataFrame, ways: int = 1) -> DataFrame:
    """Fact columns in their own order, then size, price and both ratios.

    The row-level view. Summaries do not need it: they join the sizes to their
    finished groups (``summarize.medians``), because a join of the fact on the
    few systems would put it into as few tasks. Where sizes are too many to be
    broadcast, ``ways`` above 1 spreads each system over as many tasks.
    """
    priced = with_price(fact, prices)
    out = with_sizes(priced, sizes) if ways <= 1 else with_sizes_spread(priced, sizes, ways)
    return out.select(*fact.columns, "total_system_size", "price_per_hour", "dollars_per_ns", "ns_per_dollar")


def edge_cost(
    df: DataFrame,
    ns_per_edge: float = RBFE_NS_PER_EDGE,
    source: str = "ns_per_dollar",
    name: str = "dollars_per_edge",
) -> DataFrame:
    """Add the dollar cost of one edge, from an (already aggregated) ns/$ column.

    Apply after the median: the median of the ratio is inverted, not the
    other way round. NULL when ``source`` is NULL or zero.
    """
    return df.withColumn(name, dollars_per_edge(source, ns_per_edge))
