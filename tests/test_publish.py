import threading

import pytest
from pyspark.sql import functions as F

from costlens import schemas
from costlens.plans.export import write_fact
from costlens.sources.publish import prune, publish, published, versions
from costlens.sources.tables import read_fact


def fact(spark, n, kind="md"):
    cols = [F.lit(None).cast(f.dataType).alias(f.name) for f in schemas.FACT.fields if f.name not in ("benchmark_type", "metric_value")]
    rows = spark.range(n).select(F.lit(kind).alias("benchmark_type"), F.col("id").cast("double").alias("metric_value"), *cols)
    return rows.select(*schemas.FACT_COLUMNS)


def test_a_write_that_dies_leaves_the_old_rows(spark, tmp_path):
    out = str(tmp_path / "fact")
    write_fact(fact(spark, 10), out)
    dies = fact(spark, 1000).repartition(8).withColumn(
        "metric_value", F.when(F.col("metric_value") == 777, F.raise_error(F.lit("lost")).cast("double")).otherwise(F.col("metric_value"))
    )
    with pytest.raises(Exception, match="lost"):
        write_fact(dies, out)
    assert read_fact(spark, out).count() == 10 and len(versions(spark, out)) == 1
    write_fact(fact(spark, 20, "rbfe"), out)
    assert {r.benchmark_type for r in read_fact(spark, out).collect()} == {"rbfe"}


def test_a_reader_keeps_the_version_it_began_with_until_it_is_pruned(spark, tmp_path):
    out = str(tmp_path / "fact")
    for n in (3, 5, 7):
        write_fact(fact(spark, n), out)
        if n == 3:
            early = read_fact(spark, out)
    assert early.count() == 3 and read_fact(spark, out).count() == 7
    assert len(prune(spark, out, keep=2)) == 1
    with pytest.raises(Exception):
        early.count()
    assert read_fact(spark, out).count() == 7 and len(versions(spark, out)) == 2
    assert prune(spark, out, keep=2) == []
    with pytest.raises(ValueError):
        prune(spark, out, keep=0)


def test_writers_at_the_same_time_leave_one_whole_version(spark, tmp_path):
    out = str(tmp_path / "fact")
    jobs = [threading.Thread(target=write_fact, args=(fact(spark, n), out)) for n in (11, 13, 17)]
    for j in jobs:
        j.start()
    for j in jobs:
        j.join()
    assert read_fact(spark, out).count() in (11, 13, 17)


def test_plain_folders_are_read_as_they_are(spark, tmp_path):
    out = str(tmp_path / "plain")
    fact(spark, 4).write.parquet(out)
    assert published(spark, out) == out and read_fact(spark, out).count() == 4
    assert versions(spark, str(tmp_path / "nothing")) == []


def test_other_formats_and_partitions(spark, tmp_path):
    out = str(tmp_path / "json")
    folder = publish(spark.createDataFrame([("a", None), ("b", 1.5)], schemas.PRICES), out, "json", ignoreNullFields="false")
    assert published(spark, out) == folder
    assert sorted(r.value for r in spark.read.text(folder).collect())[0] == '{"instance_type":"a","price_per_hour":null}'
    parts = str(tmp_path / "parts")
    write_fact(fact(spark, 4).unionByName(fact(spark, 2, "rbfe")), parts, ["benchmark_type"])
    plan = read_fact(spark, parts).where("benchmark_type = 'md'")
    assert plan.count() == 4 and "PartitionFilters: [isnotnull(benchmark_type" in plan._jdf.queryExecution().executedPlan().toString()
