from pyspark.sql import types as T

from costlens.operators.rank import winner

SCHEMA = T.StructType(
    [
        T.StructField("system", T.StringType()),
        T.StructField("instance_type", T.StringType()),
        T.StructField("m", T.DoubleType()),
    ]
)


def flags(spark, rows, **kw):
    df = spark.createDataFrame(rows, SCHEMA)
    return {(r.system, r.instance_type): r.is_winner for r in winner(df, "m", **kw).collect()}


def test_highest_wins_and_tie_breaks_on_instance_type(spark):
    rows = [("a", "g5", 2.0), ("a", "g4", 2.0), ("a", "g6", 1.0), ("b", "g6", 3.0), ("b", "g4", None)]
    f = flags(spark, rows)
    assert f == {("a", "g5"): False, ("a", "g4"): True, ("a", "g6"): False, ("b", "g6"): True, ("b", "g4"): False}


def test_exactly_one_winner_per_system(spark):
    rows = [(f"s{i % 5}", f"t{i}", float(i % 3)) for i in range(200)]
    df = spark.createDataFrame(rows, SCHEMA)
    from pyspark.sql import functions as F

    out = winner(df, "m").groupBy("system").agg(F.sum(F.col("is_winner").cast("int"))).collect()
    assert out and all(r[1] == 1 for r in out)
    assert winner(df, "m").count() == 200


def test_ascending_puts_null_last(spark):
    # A missing cost must never be the cheapest.
    rows = [("a", "g4", None), ("a", "g5", 9.0), ("a", "g6", 3.0)]
    assert flags(spark, rows, ascending=True) == {("a", "g4"): False, ("a", "g5"): False, ("a", "g6"): True}


def test_all_null_metric_has_no_winner(spark):
    rows = [("a", "g4", None), ("a", "g5", None)]
    assert set(flags(spark, rows).values()) == {False}


def test_descending_nan_first_like_spark_sort(spark):
    rows = [("a", "g4", float("nan")), ("a", "g5", 5.0)]
    assert flags(spark, rows)[("a", "g4")] is True


def test_null_system_is_its_own_group(spark):
    rows = [(None, "g4", 1.0), (None, "g5", 2.0), ("a", "g4", 0.5)]
    f = flags(spark, rows)
    assert f[(None, "g5")] and f[("a", "g4")] and not f[(None, "g4")]


def test_rank_numbers_every_row(spark):
    rows = [("a", "g5", 2.0), ("a", "g4", 2.0), ("a", "g6", None), ("b", "g6", 3.0)]
    got = {(r.system, r.instance_type): (r.rank, r.is_winner) for r in winner(spark.createDataFrame(rows, SCHEMA), "m", rank="rank").collect()}
    assert got == {("a", "g4"): (1, True), ("a", "g5"): (2, False), ("a", "g6"): (3, False), ("b", "g6"): (1, True)}
