"""The cost-enriched fact as a catalogued table that summaries and charts share.

The table is partitioned by benchmark type, so a summary opens the files of its
type only, and bucketed by instance type and system: groups that hold these keys are
then complete within a bucket, and medians and joins on them need no exchange of
the fact (medians read its used columns three times instead). Buckets fix how many tasks read it, so a key that
holds too large a share of the rows would make one task the longest; in that case the table
is written without buckets, and medians exchange it by value as they do
for views.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

KEYS = ("instance_type", "system")


def largest_share(df: DataFrame, keys: Sequence[str]) -> float:
    """The largest share of rows that one combination of ``keys`` holds (0 for no rows)."""
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))
    row = counts.agg(F.max("n").alias("most"), F.sum("n").alias("all")).first()
    return row["most"] / row["all"] if row["all"] else 0.0


def materialise(
    view: DataFrame,
    name: str,
    path: str,
    buckets: int = 16,
    keys: Sequence[str] = KEYS,
    partition_by: Sequence[str] = ("benchmark_type",),
    most_share: float = 0.25,
    writers: int = 4,
) -> DataFrame:
    """``view`` saved as table ``name`` with its files below ``path``; returns the table.

    ``buckets`` of rows by ``keys``, unless one key holds over ``most_share`` of the rows.
    The rows of a key are written by up to ``writers`` tasks. An existing table of
    that name is replaced in the catalog; give a fresh ``path``, so that
    readers of the old files are not disturbed.
    """
    spark = view.sparkSession
    salt = F.pmod(F.xxhash64(*[c for c in view.columns if c not in keys]), F.lit(writers))
    writer = view.repartition(*keys, salt).write.format("parquet").option("path", path).option("compression", "zstd")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if largest_share(view, keys) <= most_share:
        writer = writer.bucketBy(buckets, *keys).sortBy(*keys)
    spark.sql(f"DROP TABLE IF EXISTS {name}")
    writer.saveAsTable(name)
    return spark.table(name).select(*view.columns)
