"""Property tests of the invariants in SURVEY §5 on random small frames."""

import math

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from costlens import schemas
from costlens.operators.enrich import with_prices
from costlens.operators.median import grouped_median
from costlens.operators.rank import winners
from costlens.operators.reshape import unpivot

SETTINGS = settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))

maybe_num = st.one_of(st.none(), st.floats(-1e6, 1e6, allow_nan=False).map(lambda x: round(x, 3)))
group = st.sampled_from(["a", "b", "c", None])


@SETTINGS
@given(st.lists(st.tuples(maybe_num, maybe_num, maybe_num), min_size=1, max_size=40))
def test_unpivot_count_is_non_null_cells(spark, rows):
    df = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "id int, a double, b double, c double")
    cells = sum(v is not None for r in rows for v in r)
    assert unpivot(df, ["id"], ["a", "b", "c"], "k", "v").count() == cells


@SETTINGS
@given(st.lists(st.tuples(group, st.sampled_from(["g4", "g5", "g6", "p4"]), maybe_num), min_size=1, max_size=30))
def test_one_winner_per_system_with_a_metric(spark, rows):
    # Summary rows are unique per (system, instance_type).
    uniq = list({(s, i): (s, i, m) for s, i, m in rows}.values())
    df = spark.createDataFrame(uniq, "system string, instance_type string, m double")
    out = winners(df, [("m", False, "hi"), ("m", True, "lo")]).collect()
    for flag, pick in (("hi", max), ("lo", min)):
        for s in {r.system for r in out}:
            mine = [r for r in out if r.system == s]
            flagged = [r for r in mine if r[flag]]
            vals = [r.m for r in mine if r.m is not None]
            if not vals:
                assert not flagged
                continue
            assert len(flagged) == 1
            best = pick(vals)
            assert flagged[0].m == best
            assert flagged[0].instance_type == min(r.instance_type for r in mine if r.m == best)


def brute(vals):
    v = sorted(x for x in vals if x is not None)
    if not v:
        return None
    n = len(v)
    lo, hi = v[(n - 1) // 2], v[n // 2]
    return lo if (n - 1) // 2 == n // 2 else 0.5 * lo + 0.5 * hi


@SETTINGS
@given(st.lists(st.tuples(group, maybe_num), min_size=1, max_size=60), st.sampled_from([10, 50, 10_000]))
def test_median_equals_brute_force(spark, rows, accuracy):
    df = spark.createDataFrame(rows, "g string, v double")
    out = {r.g: r.m for r in grouped_median(df, ["g"], {"m": "v"}, ratio_steps=accuracy, parts=accuracy).collect()}
    groups = {g for g, _ in rows}
    assert set(out) == groups
    for g in groups:
        exp = brute([v for k, v in rows if k == g])
        assert (out[g] is None and exp is None) or math.isclose(out[g], exp, rel_tol=0, abs_tol=1e-9)


@SETTINGS
@given(
    st.lists(st.tuples(st.sampled_from(["s1", "s2", "s3"]), st.sampled_from(["i1", "i2", "i3"]), maybe_num), min_size=1, max_size=30),
    st.dictionaries(st.sampled_from(["i1", "i2"]), st.floats(0, 10, allow_nan=False)),
)
def test_left_joins_keep_rows_and_ratios_are_inverse(spark, facts, prices):
    rows = [("md", 1, None, f"r{k}", s, None, "ns_per_day", v, i, "a") for k, (s, i, v) in enumerate(facts)]
    fact = spark.createDataFrame(rows, schemas.FACT)
    p = spark.createDataFrame(list(prices.items()), schemas.PRICES)
    z = spark.createDataFrame([("s1", 10), ("s2", 20)], schemas.SIZES)
    view = with_prices(fact, p, z)
    assert view.count() == len(rows)
    for r in view.where(F.col("dollars_per_ns").isNotNull() & F.col("ns_per_dollar").isNotNull()).collect():
        assert math.isclose(r.dollars_per_ns * r.ns_per_dollar, 1.0, rel_tol=1e-12)
