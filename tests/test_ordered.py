from pyspark.sql import functions as F

from costlens.operators.ordered import number_rows, running_totals

def order():
    return [F.asc_nulls_last("k"), F.asc_nulls_last("id")]


def rows(spark, n=2000):
    return spark.range(n).select(
        "id", F.when(F.col("id") % 7 == 0, F.lit(None)).when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 50)).alias("k"),
        (F.col("id") % 11 - 5).alias("v"),
    ).repartition(5)


def by_order(got):
    return sorted(got, key=lambda r: (r.k is None, r.k or "", r.id))


def test_numbers_follow_the_order_over_all_partitions(spark):
    got = by_order(number_rows(rows(spark), order()).collect())
    assert [r.position for r in got] == list(range(1, 2001))


def test_running_totals_are_what_rows_before_hold(spark):
    total = 0
    for r in by_order(running_totals(rows(spark), order(), {"before": "v"}).collect()):
        assert r.before == total
        total += r.v


def test_empty_input(spark):
    assert number_rows(rows(spark, 0), order()).collect() == []
    assert running_totals(rows(spark, 0), order(), {"before": "v"}).collect() == []


def test_no_row_window_runs_in_one_task(spark):
    """Only the one-row-per-partition sums go through a window without partitions."""
    df = number_rows(rows(spark), order())
    plan = df._jdf.queryExecution().optimizedPlan().toString()
    single = [line for line in plan.splitlines() if "Window [" in line]
    assert len(single) == 1 and "_part" in single[0] and "position" not in single[0]
