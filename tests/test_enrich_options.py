import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from costlens import schemas
from costlens.constants import CONCURRENCY_LEVELS, INSTANCE_ORDER
from costlens.functions.ordering import domain_order
from costlens.operators import options
from costlens.operators.enrich import edge_cost, with_price, with_prices
from costlens.operators.summarize import by_concurrency, scaling


def fact_rows():
    d = dt.date(2026, 4, 1)
    rows = []
    for it, base in (("g4dn.xlarge", 10.0), ("g5.xlarge", 20.0), ("g6e.xlarge", 30.0), ("p9.huge", 5.0)):
        for sys_ in ("bace", "p38", "o'brien", "nosize"):
            for mps in (1, 2, 4, 8):
                for k in range(3 if it != "g5.xlarge" else 4):
                    v = base * mps + k
                    rows.append(("md", mps, d, f"r{k}", sys_, None, "ns_per_day", v, it, "ami-a"))
    rows.append(("md", 1, d, "rz", "bace", None, "ns_per_day", 0.0, "g4dn.xlarge", "ami-a"))
    rows.append(("rbfe", 1, d, "rr", "bace", "complex", "ns_per_day", 7.0, "g5.xlarge", "ami-a"))
    rows.append(("rbfe", 2, d, "rr", "bace", "solvent", "ns_per_day", 8.0, "g5.xlarge", "ami-a"))
    return rows


@pytest.fixture(scope="module")
def view(spark):
    fact = spark.createDataFrame(fact_rows(), schemas.FACT)
    prices = spark.createDataFrame(
        [("g4dn.xlarge", 0.526), ("g5.xlarge", 1.006), ("g6e.xlarge", 0.0)], schemas.PRICES
    )
    sizes = spark.createDataFrame([("bace", 49052), ("p38", 44939), ("o'brien", 7)], schemas.SIZES)
    return with_prices(fact, prices, sizes)


def test_with_prices_columns_and_rows(spark, view):
    assert view.columns == list(schemas.FACT_COLUMNS) + [
        "total_system_size", "price_per_hour", "dollars_per_ns", "ns_per_dollar",
    ]
    assert view.count() == len(fact_rows())  # unique dimension keys keep the row count


def test_ratio_guards_and_identity(spark, view):
    rows = view.collect()
    for r in rows:
        if r.instance_type == "p9.huge":
            assert r.price_per_hour is None and r.ns_per_dollar is None
        if r.instance_type == "g6e.xlarge":  # zero price
            assert r.ns_per_dollar is None
        if r.metric_value == 0.0:
            assert r.dollars_per_ns is None and r.ns_per_dollar == 0.0
        if r.dollars_per_ns is not None and r.ns_per_dollar is not None:
            assert abs(r.dollars_per_ns * r.ns_per_dollar - 1.0) < 1e-12
        if r.system == "nosize":
            assert r.total_system_size is None


def test_by_concurrency_sorted_by_system_then_ns_desc(spark, view):
    out = by_concurrency(view, "md", 1).collect()
    keys = [(r.system, -r.ns_per_day) for r in out]
    assert keys == sorted(keys)
    g5 = [r for r in out if r.instance_type == "g5.xlarge" and r.system == "bace"][0]
    assert g5.ns_per_day == 21.5  # even count: mean of the middle two (20, 21, 22, 23)


def test_scaling_quoted_system_and_levels(spark, view):
    out = scaling(view, "md", "o'brien").collect()
    assert {r.mps_process_count for r in out} == set(CONCURRENCY_LEVELS)
    assert [(r.mps_process_count, r.instance_type) for r in out] == sorted(
        (r.mps_process_count, r.instance_type) for r in out
    )
    rev = scaling(view, "md", "o'brien", order=("instance_type", "mps_process_count")).collect()
    assert [(r.instance_type, r.mps_process_count) for r in rev] == sorted(
        (r.instance_type, r.mps_process_count) for r in rev
    )


def test_edge_cost_after_median(spark, view):
    s = edge_cost(by_concurrency(view, "md", 1))
    for r in s.collect():
        if r.ns_per_dollar in (None, 0.0):
            assert r.dollars_per_edge is None
        else:
            assert r.dollars_per_edge == 66 / r.ns_per_dollar


def test_options(spark, view):
    conc = options.concurrency_options(view, "md")
    assert options.to_list(conc) == [1, 2, 4, 8]
    assert options.to_list(options.system_options(view, "rbfe", "complex")) == ["bace"]
    assert options.to_list(options.concurrency_options(view, "rbfe")) == [1, 2]  # no phase filter
    assert options.to_list(options.default_option(conc)) == [1]
    with pytest.raises(options.NoOptionsError, match="No MD"):
        options.require_non_empty(options.concurrency_options(view, "none"), "No MD data")


def test_options_nulls_last(spark):
    df = spark.createDataFrame([("md", None), ("md", 2), ("md", 1)], "benchmark_type string, mps_process_count long")
    assert options.to_list(options.concurrency_options(df, "md")) == [1, 2, None]


def test_domain_order(spark):
    df = spark.createDataFrame([(x,) for x in ["zz", "g6e.xlarge", "aa", "g4dn.xlarge", "g5.xlarge"]], "i string")
    got = [r.i for r in df.orderBy(*domain_order("i", INSTANCE_ORDER)).collect()]
    assert got == ["g4dn.xlarge", "g5.xlarge", "g6e.xlarge", "aa", "zz"]
    nums = spark.createDataFrame([(x,) for x in [8, 4, 1, 3, 2]], "m long")
    assert [r.m for r in nums.orderBy(*domain_order("m", CONCURRENCY_LEVELS)).collect()] == [1, 2, 4, 3, 8]


def test_summary_filters_reach_the_scan(spark, tmp_path):
    fact = spark.createDataFrame(fact_rows(), schemas.FACT)
    path = str(tmp_path / "fact")
    fact.write.parquet(path)
    from costlens.sources.tables import read_fact

    v = with_prices(read_fact(spark, path), spark.createDataFrame([], schemas.PRICES), spark.createDataFrame([], schemas.SIZES))
    plan = by_concurrency(v, "md", 1)._jdf.queryExecution().executedPlan().toString()
    # Filters on the view reach the fact scan below both left joins ...
    assert "PushedFilters: [IsNotNull(benchmark_type), IsNotNull(mps_process_count), EqualTo(benchmark_type,md)" in plan
    # ... and only the used columns are read (no run_date, run_id, phase, ami).
    assert "ReadSchema: struct<benchmark_type:string,mps_process_count:bigint,system:string,metric_value:double" in plan
    assert F is not None


def test_dashboard_defaults_and_tables(spark, view):
    from pyspark.sql import functions as F

    from costlens.plans.dashboard import Selection, chart_set, default_selection

    md = view.where(F.col("benchmark_type") == "md")
    rbfe = view.where(F.col("benchmark_type") == "rbfe")
    sel = default_selection(md, rbfe)
    assert sel == Selection(md_mps=1, md_system="bace", rbfe_mps=1, rbfe_system="bace")
    tables = chart_set(md, rbfe, sel)
    assert set(tables) == {"md_comparison", "md_scaling", "rbfe_comparison", "rbfe_edge_cost", "rbfe_scaling"}
    cmp_rows = tables["md_comparison"].collect()
    assert {r.mps_process_count for r in cmp_rows} == {1}
    assert sum(r.is_throughput_winner for r in cmp_rows) == len({r.system for r in cmp_rows})
    assert {r.system for r in tables["md_scaling"].collect()} == {"bace"}
    with pytest.raises(options.NoOptionsError):
        default_selection(md.where("false"), rbfe)


def test_group_size_pass_reads_only_key_columns(spark, tmp_path):
    from costlens.sources.tables import read_fact

    path = str(tmp_path / "fact_keys")
    spark.createDataFrame(fact_rows(), schemas.FACT).write.parquet(path)
    prices = spark.createDataFrame([("g5.xlarge", 1.0)], schemas.PRICES)
    sizes = spark.createDataFrame([("bace", 1)], schemas.SIZES)
    v = with_prices(read_fact(spark, path), prices, sizes)
    rows = v.where((F.col("benchmark_type") == "md") & (F.col("mps_process_count") == 1))
    keys = ["mps_process_count", "instance_type", "system", "total_system_size"]
    counts = rows.groupBy(*keys).count()
    plan = counts._jdf.queryExecution().executedPlan().toString()
    assert "ReadSchema: struct<benchmark_type:string,mps_process_count:bigint,system:string,instance_type:string>" in plan


def test_sizes_joined_to_groups_equal_sizes_in_the_fact(spark):
    fact = spark.createDataFrame(fact_rows(), schemas.FACT)
    prices = spark.createDataFrame([("g4dn.xlarge", 0.526), ("g5.xlarge", 1.006)], schemas.PRICES)
    # A system with two sizes, one of them twice.
    sizes = spark.createDataFrame([("bace", 1), ("bace", 2), ("bace", 2), ("p38", 3)], schemas.SIZES)
    late = by_concurrency(with_price(fact, prices), "md", 1, sizes=sizes)
    early = by_concurrency(with_prices(fact, prices, sizes), "md", 1)
    assert sorted(map(str, late.collect())) == sorted(map(str, early.collect()))
    assert late.columns == early.columns


def test_fact_rows_are_not_exchanged_by_system(spark):
    fact = spark.createDataFrame(fact_rows(), schemas.FACT)
    prices = spark.createDataFrame([("g5.xlarge", 1.0)], schemas.PRICES)
    sizes = spark.createDataFrame([("bace", 1)], schemas.SIZES)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = by_concurrency(with_price(fact, prices), "md", 1, sizes=sizes, sort=False)
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
    by_system = [line for line in text.splitlines() if re.search(r"Exchange hashpartitioning\(system#\d+, \d", line)]
    assert len(by_system) == 2  # the finished groups and the sizes


def test_views_take_a_quoted_system_name(spark):
    from costlens.plans.views import COST_VIEW, register_all

    fact = spark.createDataFrame(fact_rows(), schemas.FACT)
    prices = spark.createDataFrame([("g4dn.xlarge", 0.526)], schemas.PRICES)
    sizes = spark.createDataFrame([("o'brien", 7)], schemas.SIZES)
    register_all(spark, fact.where("benchmark_type = 'md'"), fact.where("benchmark_type = 'rbfe'"), prices, sizes)
    got = scaling(spark.table(COST_VIEW), "md", "o'brien").collect()
    assert {r.system for r in got} == {"o'brien"} and {r.mps_process_count for r in got} == {1, 2, 4}


def test_charts_resolve_only_what_is_missing(spark, view):
    from costlens.plans.dashboard import chart_set, resolve_selection

    md = view.where(F.col("benchmark_type") == "md")
    spark.sparkContext.setJobGroup("charts", "no job may run for given values")
    try:
        sel = resolve_selection(md, md.where("false"), 1, "bace", 2, "p38")
        chart_set(md, md.where("false"), sel)
        assert len(spark.sparkContext.statusTracker().getJobIdsForGroup("charts")) == 0
    finally:
        spark.sparkContext._jsc.clearJobGroup()
    assert (sel.rbfe_mps, sel.rbfe_system) == (2, "p38")
