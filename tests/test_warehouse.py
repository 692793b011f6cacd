import re
import uuid

import pytest
from pyspark.sql import functions as F

from costlens.operators.enrich import with_sizes, with_sizes_spread
from costlens.plans import adapter, chart_tables, warehouse

SF = "/root/testdata/sf0.01"


def final_plan(df):
    df.collect()
    return df._jdf.queryExecution().executedPlan().toString().split("== Initial Plan ==")[0]


@pytest.fixture(scope="module")
def table(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("cost") / "table")
    return warehouse.materialise(adapter.cost_view(spark, SF), f"cost_{uuid.uuid4().hex}", path, buckets=4)


@pytest.mark.parametrize("chart", ["md_comparison", "rbfe_comparison", "rbfe_edge_cost"])
def test_comparisons_of_the_table_exchange_no_measurement(spark, table, chart):
    """Groups are whole within a bucket: only finished groups are exchanged, then their winners by system."""
    plan = final_plan(getattr(chart_tables, chart)(table, 1))
    exchanged = [re.sub(r"#\d+L?", "", keys) for keys in re.findall(r"Exchange hashpartitioning\(([^)]*), \d+\)", plan)]
    assert sorted(exchanged) == ["mps_process_count, instance_type, system, total_system_size", "system"]
    assert "lineitem" not in plan and "SelectedBucketsCount: 4 out of 4" in plan


def test_charts_open_the_files_of_their_type_only(spark, table):
    plan = final_plan(chart_tables.md_scaling(table, "Brand#2"))
    assert "PartitionFilters: [isnotnull(benchmark_type" in plan and "Bucketed: true" in plan


def test_charts_of_the_table_are_those_of_the_view(spark, table):
    for chart, arg in (("md_comparison", 1), ("rbfe_scaling", "Brand#1")):
        want = getattr(chart_tables, chart)(adapter.cost_view(spark, SF), arg)
        got = getattr(chart_tables, chart)(table, arg).select(*want.columns)
        assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_a_hot_key_is_not_put_into_one_bucket(spark, tmp_path):
    view = adapter.cost_view(spark, "/root/testdata/sf0.001")
    hot = view.withColumn("instance_type", F.lit("one")).withColumn("system", F.when(F.rand(3) < 0.9, "hot").otherwise(F.col("system")))
    assert warehouse.largest_share(hot, warehouse.KEYS) > 0.8
    saved = warehouse.materialise(hot, f"hot_{uuid.uuid4().hex}", str(tmp_path / "t"))
    assert "Bucketed: true" not in final_plan(chart_tables.md_comparison(saved, 1))
    assert saved.count() == hot.count()
    assert warehouse.largest_share(hot.limit(0), warehouse.KEYS) == 0.0


def rows_per_task(df):
    return sorted((r["count"] for r in df.groupBy(F.spark_partition_id()).count().collect()), reverse=True)


def test_a_system_with_most_rows_is_spread_when_sizes_are_not_broadcast(spark):
    rows = spark.range(20_000).select(
        F.when(F.col("id") % 10 < 9, "hot").when(F.col("id") % 100 == 99, F.lit(None)).otherwise(F.concat(F.lit("s"), F.col("id") % 40)).alias("system"), "id"
    )
    sizes = spark.createDataFrame([("hot", 5), ("s9", 7), ("s9", 8), (None, 1)], "system string, total_system_size long")
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plain, spread = with_sizes(rows, sizes), with_sizes_spread(rows, sizes, 16)
        assert sorted(map(str, plain.collect())) == sorted(map(str, spread.collect()))
        assert "BroadcastHashJoin" not in final_plan(spread)
        spark.conf.set("spark.sql.adaptive.enabled", "false")
        assert rows_per_task(plain)[0] >= 18_000
        assert rows_per_task(spread)[0] <= 9_000 and len(rows_per_task(spread)) == 8
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        spark.conf.set("spark.sql.adaptive.enabled", "true")
