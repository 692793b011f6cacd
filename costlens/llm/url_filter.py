"""URL verdicts: rules first, then trust and distrust propagated over host edges.

Hosts are nodes, and so are the names above them, whether pages stand there or
not: the name one label up, and the domain (the last two labels). Host edges are
the absolute links of the pages, and pairs of edges between a host and the name
above it, and between that and the domain. The seeds are pages: a host has trust
by its pages that a rule allows and distrust by its pages that a rule blocks. Personalised PageRank
carries trust along the edges and distrust against them, until the scores are
settled. A host whose distrust exceeds ``threshold`` times its trust is blocked.

Everything here is DataFrame operations. One row per host and kind of score is
joined with the edges and summed again at each step, partial sums before the
exchange; the scores are written to the shared folder every few steps, and the
driver gets one number then: how much they changed.
"""

from __future__ import annotations

import string
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import shared_copy

#: An absolute or protocol-relative link in a tag.
LINK = r"""(?i)\bhref\s*=\s*["']?\s*((?:[a-z][a-z0-9+.-]*:)?//[^"'\s>]+)"""


def _lower_ascii(c: Column) -> Column:
    return F.translate(c, string.ascii_uppercase, string.ascii_lowercase)


def host_of(url: Column) -> Column:
    """The host of a url, A-Z lower-cased; empty for null or no ``://``."""
    return F.coalesce(_lower_ascii(F.regexp_extract(url, r"://([^/?#]*)", 1)), F.lit(""))


def path_of(url: Column) -> Column:
    """What follows the host up to ``?``, ``#`` or the end."""
    return F.coalesce(F.regexp_extract(url, r"://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules: Sequence[tuple[str, str]]) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null.

    A rule is (``allow`` or ``block``, ``host/path``): it fits its host and the
    subdomains, if the path starts with its path.
    """
    chosen = F.lit(None).cast("struct<rule:string,verdict:string>")
    for verdict, rule in sorted(rules, key=lambda r: (len(r[1]), r[1])):
        name, slash, rest = rule.partition("/")
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(slash + rest)
        chosen = F.when(fits, F.struct(F.lit(rule).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(chosen)
    return chosen


def host_edges(pages: DataFrame, hosts: DataFrame) -> DataFrame:
    """Distinct pairs (src, dst): links between hosts, and both ways between hosts, the names above, and their domains."""
    links = pages.select("host", F.explode(F.regexp_extract_all("html", F.lit(LINK), 1)).alias("to"))
    links = links.select(F.col("host").alias("src"), host_of(F.concat(F.lit(":"), "to")).alias("dst"))
    known = hosts.select("host").unionByName(links.select(F.col("dst").alias("host"))).distinct()
    above = F.regexp_extract("host", r"^[^.]+\.(.+\..+)$", 1)
    named = known.select("host", above.alias("above"), F.regexp_extract("host", r"([^.]+\.[^.]+)$", 1).alias("domain"))
    up = named.select(F.inline(F.array(F.struct(F.col("host").alias("src"), F.col("above").alias("dst")), F.struct(F.col("above").alias("src"), F.col("domain").alias("dst")))))
    both = links.unionByName(up).unionByName(up.select(F.col("dst").alias("src"), F.col("src").alias("dst")))
    return both.where((F.col("src") != "") & (F.col("dst") != "") & (F.col("src") != F.col("dst"))).distinct()


class NotSettledError(RuntimeError):
    """The scores still change after the most steps allowed."""


def propagate(
    edges: DataFrame, seeds: DataFrame, damping: float = 0.85, tolerance: float = 1e-4, most_steps: int = 400, steps_a_copy: int = 8
) -> DataFrame:
    """Personalised PageRank of several kinds at once.

    ``edges`` (kind, src, dst) and ``seeds`` (kind, host, seed; each kind sums
    to 1) give (kind, host, score). The mass of hosts without out-edges goes
    back to the seeds. That only scales all scores of a kind, so the steps leave it out and
    the scores are scaled to a sum of 1 at the end. Steps go on until
    ``steps_a_copy`` of them change all scores together by no more than
    ``tolerance``; what further steps would change is then less than that.
    ``NotSettledError`` after ``most_steps``.
    """
    degree = edges.groupBy("kind", "src").agg(F.count(F.lit(1)).alias("n"))
    weighted = shared_copy(edges.join(degree, ["kind", "src"]).select("kind", "src", "dst", (damping / F.col("n")).alias("w")), "edges")
    seeds = shared_copy(seeds, "seeds")
    restart = seeds.select("kind", "host", ((1 - damping) * F.col("seed")).alias("score"))
    score = copied = restart
    for step in range(1, most_steps + 1):
        from_src = score.select(F.col("kind").alias("of"), F.col("host").alias("at"), "score")
        moved = weighted.join(from_src, (F.col("kind") == F.col("of")) & (F.col("src") == F.col("at")))
        moved = moved.select("kind", F.col("dst").alias("host"), (F.col("w") * F.col("score")).alias("score"))
        score = moved.unionByName(restart).groupBy("kind", "host").agg(F.sum("score").alias("score"))
        if step % steps_a_copy == 0 or step == most_steps:
            score = shared_copy(score, f"scores-{step}")
            apart = score.unionByName(copied.select("kind", "host", (-F.col("score")).alias("score")))
            changed = apart.groupBy("kind", "host").agg(F.abs(F.sum("score")).alias("by")).agg(F.sum("by")).first()[0]
            if not changed or changed <= tolerance:
                total = score.groupBy(F.col("kind").alias("of")).agg(F.sum("score").alias("all"))
                return score.join(total, F.col("kind") == F.col("of")).select("kind", "host", (F.col("score") / F.col("all")).alias("score"))
            copied = score
    raise NotSettledError(f"scores changed by {changed} in the last steps of {most_steps}")


def url_verdicts(
    pages: DataFrame,
    rules: Sequence[tuple[str, str]],
    damping: float = 0.85,
    tolerance: float = 1e-4,
    threshold: float = 1.0,
) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, distrust.

    ``verdict`` is the rule's, else that of the host's scores; ``trust`` and
    ``distrust`` are 0 for hosts that no score reaches, and such hosts are
    allowed. A url that is null or has no ``://`` has an empty host and path,
    fits no rule and is allowed. Null html has no links. Repeated rows and
    page ids stay as they are; an empty table gives no rows; extra columns are
    ignored.
    """
    url = F.col("url").cast("string")
    base = pages.select("page_id", F.col("html").cast("string").alias("html"), host_of(url).alias("host"), path_of(url).alias("path"))
    base = base.withColumn("by", rule_of(F.col("host"), F.col("path"), rules))
    ruled = F.col("by.verdict")
    hosts = shared_copy(
        base.where("host != ''").groupBy("host").agg(
            F.count(F.when(ruled == "allow", 1)).alias("allowed"),
            F.count(F.when(ruled == "block", 1)).alias("blocked"),
        ),
        "hosts",
    )
    edges = shared_copy(host_edges(base, hosts), "links")
    kinds = edges.select(F.lit("trust").alias("kind"), "src", "dst").unionByName(
        edges.select(F.lit("distrust").alias("kind"), F.col("dst").alias("src"), F.col("src").alias("dst"))
    )
    counts = F.array(*(F.struct(F.lit(kind).alias("kind"), F.col(n).alias("mass")) for kind, n in (("trust", "allowed"), ("distrust", "blocked"))))
    mass = hosts.select("host", F.inline(counts)).where("mass > 0")
    total = mass.groupBy("kind").agg(F.sum("mass").alias("total"))
    seeds = mass.join(total, "kind").select("kind", "host", (F.col("mass") / F.col("total")).alias("seed"))
    score = propagate(kinds, seeds, damping, tolerance)
    by_host = score.groupBy("host").agg(
        *(F.coalesce(F.sum(F.when(F.col("kind") == k, F.col("score"))), F.lit(0.0)).alias(k) for k in ("trust", "distrust"))
    )
    out = base.drop("html").join(by_host, "host", "left").fillna(0.0, ["trust", "distrust"])
    method = F.when(F.col("distrust") > threshold * F.col("trust"), F.lit("block")).otherwise(F.lit("allow"))
    return out.select(
        "page_id", "host", "path", F.col("by.rule").alias("rule"), F.coalesce(ruled, method).alias("verdict"), "trust", "distrust"
    )
