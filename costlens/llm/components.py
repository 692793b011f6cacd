"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import shared_copy


def components(links: DataFrame) -> DataFrame:
    """(id, component): the smallest id reachable from each id that occurs in ``links`` (a, b).

    Each round every id picks the neighbour (or itself) that comes first in a
    random order of that round, ids and links are replaced by the pick's pick,
    and links that became equal, or loops, drop out: the links shrink by a
    constant factor on average, whatever their shape, until none is left. The
    picks are minima taken before the exchange, so an id with very many links is
    no hot group, and every round's result is written to the shared folder.
    """
    pair = lambda a, b: (F.least(a, b).alias("a"), F.greatest(a, b).alias("b"))
    edges = shared_copy(links.select(*pair("a", "b")).where("a <> b").distinct(), "graph")
    label = edges.select(F.col("a").alias("id")).union(edges.select("b")).distinct().select("id", F.col("id").alias("at"))
    label, turn = shared_copy(label, "labels"), 0
    while not edges.isEmpty():
        place = lambda c, turn=turn: F.struct(F.xxhash64(c, F.lit(turn)).alias("h"), F.col(c).alias("v"))
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        pick = both.groupBy(F.col("a").alias("id")).agg(F.min(place("b")).alias("near"))
        pick = shared_copy(pick.select("id", F.least("near", place("id"))["v"].alias("to")), "picks")
        far = pick.select(F.col("id").alias("to"), F.col("to").alias("far"))
        pick = shared_copy(pick.join(far, "to").select("id", "far"), "picks")
        for side in ("a", "b"):
            edges = edges.join(pick.withColumnRenamed("id", side), side).drop(side).withColumnRenamed("far", side)
        edges = shared_copy(edges.select(*pair("a", "b")).where("a <> b").distinct(), "graph")
        moved = label.join(pick.withColumnRenamed("id", "at"), "at", "left")
        label = shared_copy(moved.select("id", F.coalesce("far", "at").alias("at")), "labels")
        turn += 1
    low = label.groupBy("at").agg(F.min("id").alias("component"))
    return label.join(low, "at").select("id", "component")
