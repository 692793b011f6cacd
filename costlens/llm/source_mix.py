"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Sources in code point order, null last, get the weights of a repeating cycle
and share the whole corpus by them. A target stops at ``most`` times what its
source holds, and the excess is shared again by weight until none is above.

A source's documents are taken in complete epochs while the target allows, then
in part: each document draws an exponential key ``-ln(u) / quality weight``
from a hash of its id and text, documents are taken in rising key order, and
the prefix sums of their sizes end the selection at the remaining budget. The
document at the edge is taken up to the budget, so a source misses its target
by the rounding of the target alone.

One order over (source, key) is range-partitioned, so a source that holds a
third of all rows is spread over many tasks; prefix sums within a source are
differences of running totals over that order. Nothing per document or per
source is collected: the driver gets a few sums per round of sharing.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import shared_copy
from costlens.operators.ordered import number_rows, running_totals

#: Space, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = " \t\n\x0b\x0c\r"


def words(text: Column) -> Column:
    """Number of runs of ``[^\\x20\\x09-\\x0D]`` (null: 0); no array of the runs is built."""
    one_each = F.regexp_replace(text, r"[^\x20\x09-\x0D]+", "x")
    return F.coalesce(F.length(F.translate(one_each, BLANKS, "")), F.lit(0)).cast("long")


def exponential_key(doc_id: Column, digest: Column, weight: Column) -> Column:
    """``-ln(u) / weight`` with u from an md5 of the id and the text's digest: the same at every run.

    A null weight counts as 1; weights that are not above 0 come last.
    """
    named = F.concat(F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), digest)
    drawn = F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("long")
    weight = F.coalesce(weight.cast("double"), F.lit(1.0))
    return F.when(weight > 0, -F.log((drawn + 0.5) / float(1 << 52)) / weight).otherwise(float("inf"))


def targets(sources: DataFrame, cycle: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """(source, source_size) with ``target``, ``budget`` (the target rounded) and ``before``.

    ``before`` is the size of all sources that come earlier. Each round shares
    what the capped sources leave among the others; the set of capped sources
    only grows, and a round that adds none is the last.
    """
    order = [F.asc_nulls_last("source")]
    placed = running_totals(number_rows(sources, order), order, {"before": "source_size"})
    weights = F.array(*map(F.lit, cycle))
    placed = shared_copy(placed.withColumn("weight", F.get(weights, ((F.col("position") - 1) % len(cycle)).cast("int")).cast("long")), "sources")
    limit = most * F.col("source_size")
    wide = lambda c: c.cast("decimal(38,0)")  # noqa: E731  products of two sums outgrow a long
    of_all = placed.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    rest, free, n_capped = of_all.size or 0, of_all.weight or 1, 0
    while True:
        above = wide(limit) * wide(F.lit(free)) < wide(F.col("weight")) * wide(F.lit(rest))
        capped = placed.where(above).agg(F.count(F.lit(1)).alias("n"), F.sum(limit).alias("size"), F.sum("weight").alias("weight")).first()
        if capped.n == n_capped:
            break
        n_capped, rest, free = capped.n, of_all.size - capped.size, of_all.weight - capped.weight
    target = F.when(above, limit.cast("double")).otherwise((F.col("weight") * F.lit(rest)).cast("double") / F.lit(free).cast("double"))
    return placed.select("source", "source_size", "before", target.alias("target"), F.round(target).cast("long").alias("budget"))


def mix(docs: DataFrame, weights: DataFrame | None = None, cycle: Sequence[int] = (5, 2, 1), most: int = 3) -> DataFrame:
    """One row per document: doc_id, size, source_size, target, taken, epochs, part.

    ``taken`` words are ``epochs`` whole passes and ``part`` words of the last,
    partial one. Every row is a document of its own, also if it repeats an id
    or has none; rows with the same id and text tie, and any of them may be
    the one at the edge. Null text has size 0 and takes nothing, as does a source
    without words. Null sources form one source, empty names another. An empty table
    gives no rows; extra columns are ignored. ``weights`` (doc_id, weight) has one row per
    id at most; documents without one weigh 1. Texts are read once and never shuffled.
    """
    text, source = F.col("text").cast("string"), F.col("source").cast("string")
    digest = F.md5(F.coalesce(text, F.lit("")).cast("binary"))
    sized = docs.select("doc_id", source.alias("source"), words(text).alias("size"), digest.alias("digest"))
    if weights is None:
        sized = sized.withColumn("weight", F.lit(1.0))
    else:
        of = weights.select(F.col("doc_id").alias("of"), "weight")
        sized = sized.join(of, F.col("doc_id") == F.col("of"), "left").drop("of")
    key = exponential_key(F.col("doc_id"), F.col("digest"), F.col("weight"))
    sized = shared_copy(sized.withColumn("key", key).drop("weight"), "sized")
    per_source = targets(sized.groupBy("source").agg(F.sum("size").alias("source_size")), cycle, most)
    order = [F.asc_nulls_last("source"), F.col("key").asc(), F.asc_nulls_last("doc_id"), F.col("digest").asc()]
    ordered = running_totals(sized, order, {"upto": "size"})
    s = per_source.withColumnRenamed("source", "of")
    joined = ordered.join(s, F.col("source").eqNullSafe(F.col("of")))
    empty = F.col("source_size") == 0
    epochs = F.when(empty, F.lit(0)).otherwise(F.expr("budget div nullif(source_size, 0)")).cast("long")
    left = F.col("budget") - F.col("epochs") * F.col("source_size") - (F.col("upto") - F.col("before"))
    part = F.greatest(F.lit(0), F.least(F.col("size"), left)).cast("long")
    return joined.withColumn("epochs", epochs).withColumn("part", part).select(
        "doc_id", "size", "source_size", "target", (F.col("epochs") * F.col("size") + F.col("part")).alias("taken"), "epochs", "part"
    )
