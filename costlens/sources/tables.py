"""Readers for the analysis inputs: fact Parquet, price JSON, system metadata."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens import schemas
from costlens.constants import DEFAULT_SYSTEMS
from costlens.sources.publish import published


def read_table(spark: SparkSession, base_dir: str, name: str) -> DataFrame:
    """One Parquet table ``<base_dir>/<name>.parquet`` (schema from the file)."""
    return spark.read.parquet(f"{base_dir.rstrip('/')}/{name}.parquet")


def read_fact(spark: SparkSession, path: str) -> DataFrame:
    """An exported fact (published, or a file or directory of Parquet files), in fact column order.

    A fact written with ``partition_by`` (e.g. benchmark type and concurrency)
    is read the same way; filters on those columns then prune folders.
    """
    return spark.read.schema(schemas.FACT).parquet(published(spark, path)).select(*schemas.FACT_COLUMNS)


def read_prices(spark: SparkSession, path: str) -> DataFrame:
    """Price table from JSON: published, or a one-line top-level array or JSON Lines."""
    return spark.read.schema(schemas.PRICES).json(published(spark, path))


def read_system_metadata(
    spark: SparkSession, path: str, systems: Sequence[str] = DEFAULT_SYSTEMS
) -> DataFrame:
    """The pretty-printed metadata document as one row, one struct per system."""
    return (
        spark.read.option("multiLine", "true")
        .schema(schemas.system_metadata(systems))
        .json(path)
    )


def read_metadata_documents(spark: SparkSession, path: str, per_line: bool = False) -> DataFrame:
    """(system, metadata): one row per entry of every metadata document, whatever the systems are called.

    A file is one document (pretty-printed or not) or, with ``per_line``, one
    document per line. Documents are parsed as maps where they are read, so the names
    of the systems need not be known; a system in several documents has several
    rows. A document that is no object of entries fails the query.
    """
    text = spark.read.text(path, wholetext=not per_line).where(F.trim("value") != "")
    entries = F.from_json("value", schemas.METADATA_DOCUMENT, {"mode": "FAILFAST"})
    return text.select(F.explode(entries).alias("system", "metadata")).where(F.col("metadata").isNotNull())
