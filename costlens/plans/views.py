"""Named temporary views, so the analysis can also be written as Spark SQL.

``register_all`` registers the inputs under the names the dashboard SQL uses
and the two cost-enriched views on top of them. Views are lazy: each query
that reads them is planned as a whole (filters still reach the scans).

The summaries (``operators.summarize``) take ``spark.table`` of a view like any
other DataFrame; their medians split large groups, which SQL's ``median()``
does not.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from costlens.operators.enrich import with_prices

FACT_VIEW = "benchmark_costs"
RBFE_FACT_VIEW = "rbfe_benchmark_costs"
PRICES_VIEW = "instance_prices"
SIZES_VIEW = "system_metadata"
COST_VIEW = "benchmark_costs_with_prices"
RBFE_COST_VIEW = "rbfe_benchmark_costs_with_prices"


def register_all(
    spark: SparkSession,
    fact: DataFrame,
    rbfe_fact: DataFrame,
    prices: DataFrame,
    sizes: DataFrame,
) -> dict[str, DataFrame]:
    """Register the six views; returns them by name."""
    views = {
        FACT_VIEW: fact,
        RBFE_FACT_VIEW: rbfe_fact,
        PRICES_VIEW: prices,
        SIZES_VIEW: sizes,
        COST_VIEW: with_prices(fact, prices, sizes),
        RBFE_COST_VIEW: with_prices(rbfe_fact, prices, sizes),
    }
    for name, df in views.items():
        df.createOrReplaceTempView(name)
    return views
