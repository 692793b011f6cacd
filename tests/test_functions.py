import math

from pyspark.sql import functions as F

from costlens.functions.numeric import dollars_per_edge, dollars_per_ns, json_double, ns_per_dollar, safe_divide
from costlens.functions.ordering import domain_position
from costlens.functions.paths import decode_path, run_date_from_path, run_id_from_path


def one(spark, expr, schema, value):
    return spark.createDataFrame([(value,)], schema).select(expr.alias("x")).first().x


def test_run_keys_from_paths(spark):
    cases = {
        "s3a://b/runs/2026-04-01/r1/output/md_benchmark.out": ("2026-04-01", "r1"),
        "file:/x/runs/2026-04-01/group/r6/output/md_benchmark.out": ("2026-04-01", ""),
        "file:/x/runs/2026-4-1/r1/output/md_benchmark.out": ("", "r1"),
        "file:/x/runs/2026-04-01/r1/output/rbfe_benchmark.out": ("2026-04-01", ""),
    }
    for path, (date, run) in cases.items():
        assert one(spark, run_date_from_path(F.col("p")), "p string", path) == date
        assert one(spark, run_id_from_path(F.col("p"), "output/md_benchmark.out"), "p string", path) == run
    manifest = "file:/x/runs/2026-04-01/r1/manifest.json"
    assert one(spark, run_id_from_path(F.col("p"), "manifest.json"), "p string", manifest) == "r1"


def test_decode_path_keeps_plus_and_decodes_spaces(spark):
    assert one(spark, decode_path(F.col("p")), "p string", "file:/runs/d/r%20a+b/x") == "file:/runs/d/r a+b/x"


def test_json_double_variants(spark):
    for text, expected in [("120.5", 120.5), ('"75.25"', 75.25), ("1e3", 1000.0), (None, None)]:
        assert one(spark, json_double(F.col("t")), "t string", text) == expected
    assert math.isnan(one(spark, json_double(F.col("t")), "t string", '"NaN"'))
    assert one(spark, json_double(F.col("t")), "t string", "Infinity") == float("inf")


def test_zero_guarded_ratios(spark):
    assert one(spark, safe_divide(F.lit(1.0), F.col("d")), "d double", 0.0) is None
    assert one(spark, dollars_per_ns(F.lit(1.0), F.col("v")), "v double", 0.0) is None
    assert one(spark, ns_per_dollar(F.col("v"), F.lit(0.0)), "v double", 5.0) is None
    assert one(spark, ns_per_dollar(F.col("v"), F.lit(0.5)), "v double", 24.0) == 2.0
    assert one(spark, dollars_per_edge(F.col("n")), "n double", 0.0) is None
    assert one(spark, dollars_per_edge(F.col("n")), "n double", 2.0) == 33.0


def test_domain_position(spark):
    assert one(spark, domain_position(F.col("m"), (1, 2, 4)), "m long", 4) == 3
    assert one(spark, domain_position(F.col("m"), (1, 2, 4)), "m long", 8) is None
