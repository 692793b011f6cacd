"""Adapter from the driver's TPC-H-like tables to the benchmark-cost model.

The driver tables stand in for the real benchmark fact so that every job runs
over data that grows with the scale factor:

* a ``lineitem`` row is one measurement: ``l_linestatus`` 'O' -> MD, else
  RBFE; ``l_linenumber`` -> concurrency; ``l_shipdate`` -> run date;
  ``l_orderkey`` -> run id; part brand -> system; return flag A/R -> phase
  complex/solvent (N -> NULL); ``l_quantity * l_discount`` -> ns/day (zero
  when there is no discount); supplier name -> instance type;
* prices are the suppliers with a positive balance (others stay unpriced);
* sizes are the summed part sizes per brand, without ``Brand#1`` (unsized).
"""

from __future__ import annotations

from functools import lru_cache

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.operators.enrich import with_price, with_prices
from costlens.sources.tables import read_table

UNSIZED_BRAND = "Brand#1"


@lru_cache(maxsize=128)
def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table, read once per session: the files are read-only inputs,
    and a DataFrame is an immutable, lazy plan, so reuse only saves the
    listing and footer reads of planning."""
    return read_table(spark, sf_dir, name)


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem")
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    supp = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    rows = li.join(part, li.l_partkey == part.p_partkey).join(supp, li.l_suppkey == supp.s_suppkey)
    return rows.select(
        F.when(F.col("l_linestatus") == "O", F.lit("md")).otherwise(F.lit("rbfe")).alias(
            "benchmark_type"
        ),
        F.col("l_linenumber").cast("bigint").alias("mps_process_count"),
        F.col("l_shipdate").cast("date").alias("run_date"),
        F.col("l_orderkey").cast("string").alias("run_id"),
        F.col("p_brand").alias("system"),
        F.when(F.col("l_returnflag") == "A", F.lit("complex"))
        .when(F.col("l_returnflag") == "R", F.lit("solvent"))
        .alias("phase"),
        F.lit("ns_per_day").alias("metric_name"),
        (F.col("l_quantity") * F.col("l_discount")).alias("metric_value"),
        F.col("s_name").alias("instance_type"),
        F.concat(F.lit("ami-"), F.col("s_nationkey").cast("string")).alias("ami"),
    )


def prices(spark: SparkSession, sf_dir: str) -> DataFrame:
    supp = table(spark, sf_dir, "supplier")
    return supp.where(F.col("s_acctbal") > 0).select(
        F.col("s_name").alias("instance_type"), F.col("s_acctbal").alias("price_per_hour")
    )


def sizes(spark: SparkSession, sf_dir: str) -> DataFrame:
    part = table(spark, sf_dir, "part")
    return (
        part.where(F.col("p_brand") != F.lit(UNSIZED_BRAND))
        .groupBy(F.col("p_brand").alias("system"))
        .agg(F.sum("p_size").cast("bigint").alias("total_system_size"))
    )


def cost_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The cost-enriched fact over the driver tables."""
    return with_prices(fact(spark, sf_dir), prices(spark, sf_dir), sizes(spark, sf_dir))


def priced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The fact with prices and ratios, without sizes: the input of the summaries."""
    return with_price(fact(spark, sf_dir), prices(spark, sf_dir))


# The same model as SQL over the registered driver tables; used by the oracle.
SQL_VIEW = """
WITH fact AS (
  SELECT CASE WHEN l_linestatus = 'O' THEN 'md' ELSE 'rbfe' END AS benchmark_type,
         CAST(l_linenumber AS BIGINT) AS mps_process_count,
         CAST(l_shipdate AS DATE) AS run_date,
         CAST(l_orderkey AS VARCHAR) AS run_id,
         p_brand AS system,
         CASE l_returnflag WHEN 'A' THEN 'complex' WHEN 'R' THEN 'solvent' END AS phase,
         'ns_per_day' AS metric_name,
         l_quantity * l_discount AS metric_value,
         s_name AS instance_type,
         'ami-' || CAST(s_nationkey AS VARCHAR) AS ami
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN supplier ON l_suppkey = s_suppkey),
prices AS (SELECT s_name AS instance_type, s_acctbal AS price_per_hour
           FROM supplier WHERE s_acctbal > 0),
sizes AS (SELECT p_brand AS system, CAST(SUM(p_size) AS BIGINT) AS total_system_size
          FROM part WHERE p_brand <> 'Brand#1' GROUP BY p_brand),
v AS (SELECT f.*, m.total_system_size, p.price_per_hour,
             (p.price_per_hour * 24.0) / NULLIF(f.metric_value, 0) AS dollars_per_ns,
             f.metric_value / NULLIF(p.price_per_hour * 24.0, 0) AS ns_per_dollar
      FROM fact f LEFT JOIN prices p ON f.instance_type = p.instance_type
                  LEFT JOIN sizes m ON f.system = m.system)
"""
