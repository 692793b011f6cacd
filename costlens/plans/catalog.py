"""Registered queries over the driver tables, each with its DuckDB oracle SQL.

Every query reads whole driver tables (or files Spark derives from them); no
row subsets. Column names are aliased identically on both sides.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.constants import CONCURRENCY_LEVELS, DEFAULT_SYSTEMS, INSTANCE_ORDER, MD, RBFE
from costlens.functions.labels import phase_label, strip_suffix
from costlens.functions.numeric import is_finite
from costlens.functions.ordering import domain_order, domain_position
from costlens.functions.paths import path_group, run_date_from_path, run_id_from_path
from costlens.operators import options, reshape
from costlens.operators.enrich import with_prices
from costlens.operators.median import grouped_median
from costlens.operators.ordered import number_rows
from costlens.operators.quality import duplicate_keys, finite
from costlens.operators.rank import winner
from costlens.operators.summarize import (
    SUMMARY_VALUES,
    by_concurrency,
    by_concurrency_order,
    medians,
    positions,
    scaling,
    scaling_order,
)
from costlens.plans import adapter, chart_tables, price_fixture, run_fixture, views, warehouse
from costlens.plans.export import drift_report, export_rejects, md_export, rbfe_export, write_fact
from costlens.plans.price_snapshot import price_snapshot, read_snapshot, snapshot_month, write_prices
from costlens import schemas
from costlens.constants import MD_OUTPUT_FILE, RBFE_OUTPUT_FILE
from costlens.session import scratch_dir
from costlens.sources.runs import manifests, parse_manifests, read_run_tree, run_outputs, unmatched_paths
from costlens.sources.pricelist import read_price_documents_text
from costlens.sources.tables import read_fact, read_metadata_documents

QueryFn = Callable[[SparkSession, str], DataFrame]

MPS = 1
MD_SYSTEM = "Brand#2"  # a sized system
RBFE_SYSTEM = "Brand#1"  # the unsized system: NULL size group

_V = adapter.SQL_VIEW


def _sql_list(values) -> str:
    return ", ".join(f"'{v}'" if isinstance(v, str) else str(v) for v in values)


_INSTANCE_LIST = f"[{_sql_list(INSTANCE_ORDER)}]"
_MPS_LIST = f"[{_sql_list(CONCURRENCY_LEVELS)}]"


def _median_sql(keys: str, where: str) -> str:
    return (
        f"SELECT {keys}, median(metric_value) AS ns_per_day, "
        f"median(ns_per_dollar) AS ns_per_dollar FROM v WHERE {where} "
        f"GROUP BY {keys}"
    )


_CONC_KEYS = "mps_process_count, instance_type, system, total_system_size"
_SCALE_KEYS = "system, mps_process_count, instance_type, total_system_size"


def _winner_sql(metric: str, flag: str, asc: bool = False) -> str:
    direction = "ASC" if asc else "DESC"
    return (
        f"(row_number() OVER (PARTITION BY system ORDER BY {metric} {direction} NULLS LAST, "
        f"instance_type ASC NULLS LAST) = 1 AND {metric} IS NOT NULL) AS {flag}"
    )


def _rank_sql(metric: str) -> str:
    return (
        f"CAST(row_number() OVER (PARTITION BY system ORDER BY {metric} DESC NULLS LAST, "
        "instance_type ASC NULLS LAST) AS INTEGER) AS rank"
    )


# --- cost model and summaries ----------------------------------------------


def q_cost_view(spark: SparkSession, d: str) -> DataFrame:
    return adapter.cost_view(spark, d)


def q_md_by_concurrency(spark: SparkSession, d: str) -> DataFrame:
    return by_concurrency(adapter.priced(spark, d), MD, MPS, sizes=adapter.sizes(spark, d))


def q_rbfe_by_concurrency(spark: SparkSession, d: str) -> DataFrame:
    return by_concurrency(adapter.priced(spark, d), RBFE, MPS, phase="complex", sizes=adapter.sizes(spark, d))


def q_median_by_system_phase(spark: SparkSession, d: str) -> DataFrame:
    return medians(adapter.priced(spark, d), ["system", "phase"], adapter.sizes(spark, d))


def q_median_by_system_phase_sorted(spark: SparkSession, d: str) -> DataFrame:
    """The same medians over the row-level cost view, sizes joined to the rows."""
    return grouped_median(
        adapter.cost_view(spark, d), ["system", "total_system_size", "phase"], SUMMARY_VALUES
    )


def _md_summary(spark: SparkSession, d: str) -> DataFrame:
    return by_concurrency(adapter.priced(spark, d), MD, MPS, sizes=adapter.sizes(spark, d), sort=False)


def q_winner_ns_per_day(spark: SparkSession, d: str) -> DataFrame:
    return winner(_md_summary(spark, d), "ns_per_day", rank="rank")


def q_winner_ns_per_dollar(spark: SparkSession, d: str) -> DataFrame:
    return winner(_md_summary(spark, d), "ns_per_dollar", rank="rank")


def q_md_comparison(spark: SparkSession, d: str) -> DataFrame:
    return chart_tables.md_comparison(adapter.priced(spark, d), MPS, sizes=adapter.sizes(spark, d))


def q_rbfe_comparison(spark: SparkSession, d: str) -> DataFrame:
    return chart_tables.rbfe_comparison(adapter.priced(spark, d), MPS, sizes=adapter.sizes(spark, d))


def q_rbfe_edge_cost_winner(spark: SparkSession, d: str) -> DataFrame:
    return chart_tables.rbfe_edge_cost(adapter.priced(spark, d), MPS, sizes=adapter.sizes(spark, d))


def q_md_scaling(spark: SparkSession, d: str) -> DataFrame:
    return chart_tables.md_scaling(adapter.priced(spark, d), MD_SYSTEM, sizes=adapter.sizes(spark, d))


def q_rbfe_scaling(spark: SparkSession, d: str) -> DataFrame:
    return chart_tables.rbfe_scaling(adapter.priced(spark, d), RBFE_SYSTEM, sizes=adapter.sizes(spark, d))


def q_materialised_charts(spark: SparkSession, d: str) -> DataFrame:
    """The five chart tables, all read from one saved table of the cost view."""
    view = warehouse.materialise(adapter.cost_view(spark, d), f"cost_view_{uuid.uuid4().hex}", scratch_dir(spark, "cost-table"))
    summary = chart_tables.rbfe_summary(view, MPS)
    charts = {
        "md_comparison": chart_tables.md_comparison(view, MPS),
        "md_scaling": chart_tables.md_scaling(view, MD_SYSTEM),
        "rbfe_comparison": chart_tables.comparison_of(summary),
        "rbfe_edge_cost": chart_tables.edge_cost_of(summary),
        "rbfe_scaling": chart_tables.rbfe_scaling(view, RBFE_SYSTEM),
    }
    named = [table.withColumn("chart", F.lit(name)) for name, table in charts.items()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def q_cost_view_spread(spark: SparkSession, d: str) -> DataFrame:
    """The cost view with each system's rows spread over 16 salts."""
    return with_prices(adapter.fact(spark, d), adapter.prices(spark, d), adapter.sizes(spark, d), ways=16)


def q_summary_order(spark: SparkSession, d: str) -> DataFrame:
    return positions(_md_summary(spark, d), by_concurrency_order())


def q_md_scaling_order(spark: SparkSession, d: str) -> DataFrame:
    rows = scaling(adapter.priced(spark, d), MD, MD_SYSTEM, sizes=adapter.sizes(spark, d), sort=False)
    return positions(rows, scaling_order())


def q_rbfe_scaling_order(spark: SparkSession, d: str) -> DataFrame:
    rows = scaling(adapter.priced(spark, d), RBFE, RBFE_SYSTEM, phase="complex", sizes=adapter.sizes(spark, d), sort=False)
    return positions(rows, scaling_order(("instance_type", "mps_process_count")))


def q_selector_guard(spark: SparkSession, d: str) -> DataFrame:
    """What the empty-selector guard says about selectors with options and without."""
    fact = adapter.fact(spark, d)
    selectors = {
        "md concurrency": options.concurrency_options(fact, MD),
        "rbfe system": options.system_options(fact, RBFE, "complex"),
        "rbfe system, unknown phase": options.system_options(fact, RBFE, "vacuum"),
        "free energy concurrency": options.concurrency_options(fact, "free energy"),
    }
    rows = [options.guard(df, f"no options: {name}").withColumn("selector", F.lit(name)) for name, df in selectors.items()]
    return reduce(DataFrame.unionByName, rows)


def q_snapshot_months(spark: SparkSession, d: str) -> DataFrame:
    """Measurements per snapshot month of their run date."""
    return adapter.fact(spark, d).groupBy(snapshot_month("run_date").alias("snapshot")).agg(F.count(F.lit(1)).alias("rows"))


def q_concurrency_options(spark: SparkSession, d: str) -> DataFrame:
    return options.concurrency_options(adapter.fact(spark, d), MD)


def q_rbfe_concurrency_options(spark: SparkSession, d: str) -> DataFrame:
    return options.concurrency_options(adapter.fact(spark, d), RBFE)


def q_system_options(spark: SparkSession, d: str) -> DataFrame:
    return options.system_options(adapter.fact(spark, d), RBFE, "complex")


def q_md_system_options(spark: SparkSession, d: str) -> DataFrame:
    return options.system_options(adapter.fact(spark, d), MD)


def q_default_options(spark: SparkSession, d: str) -> DataFrame:
    return options.default_option(options.concurrency_options(adapter.fact(spark, d), MD))


def q_sql_md_by_concurrency(spark: SparkSession, d: str) -> DataFrame:
    """The MD summary of the registered cost view."""
    fact = adapter.fact(spark, d)
    views.register_all(
        spark,
        fact.where(F.col("benchmark_type") == MD),
        fact.where(F.col("benchmark_type") == RBFE),
        adapter.prices(spark, d),
        adapter.sizes(spark, d),
    )
    return by_concurrency(spark.table(views.COST_VIEW), MD, MPS)


def q_instance_order(spark: SparkSession, d: str) -> DataFrame:
    """Instance types in display order; every third supplier stands for a listed type."""
    names = F.array(*[F.lit(n) for n in INSTANCE_ORDER])
    supp = adapter.table(spark, d, "supplier")
    key = F.col("s_suppkey")
    named = F.when(key % 3 == 0, F.element_at(names, (F.floor(key / 3) % len(INSTANCE_ORDER) + 1).cast("int"))).otherwise(F.col("s_name"))
    types = supp.select(named.alias("instance_type")).distinct()
    ranked = types.withColumn("instance_rank", domain_position("instance_type", INSTANCE_ORDER))
    return number_rows(ranked, domain_order("instance_type", INSTANCE_ORDER))


def q_sorted_options(spark: SparkSession, d: str) -> DataFrame:
    """The option lists in the order the library returns them."""
    fact = adapter.fact(spark, d)
    lists = {
        "md concurrency": options.concurrency_options(fact, MD),
        "rbfe concurrency": options.concurrency_options(fact, RBFE),
        "md system": options.system_options(fact, MD),
        "rbfe system": options.system_options(fact, RBFE, "complex"),
    }
    rows = [(name, k, str(v)) for name, df in lists.items() for k, v in enumerate(options.to_list(df), 1)]
    return spark.createDataFrame(rows, "selector string, position int, option string")


# --- reshapes, filters and scalar functions ---------------------------------


def q_unpivot_metrics(spark: SparkSession, d: str) -> DataFrame:
    li = adapter.table(spark, d, "lineitem")
    return reshape.unpivot(
        li,
        ["l_orderkey", "l_linenumber"],
        {
            "quantity": F.col("l_quantity"),
            "discount": F.nullif(F.col("l_discount"), F.lit(0.0)),
            "tax": F.col("l_tax"),
        },
        "metric",
        "value",
    )


def q_rbfe_unpivot_phases(spark: SparkSession, d: str) -> DataFrame:
    li = adapter.table(spark, d, "lineitem")
    wide = li.select(
        "l_orderkey",
        "l_linenumber",
        F.col("l_extendedprice").alias("price_complex"),
        F.nullif(F.col("l_discount"), F.lit(0.0)).alias("price_solvent"),
        F.nullif(F.col("l_tax"), F.lit(0.0)).alias("tax_complex"),
        F.col("l_quantity").alias("tax_solvent"),
    )
    return reshape.unpivot_suffixed(
        wide,
        ["l_orderkey", "l_linenumber"],
        ["price_complex", "price_solvent", "tax_complex", "tax_solvent"],
        ("complex", "solvent"),
        "name",
        "phase",
        "value",
    )


def q_system_sizes(spark: SparkSession, d: str) -> DataFrame:
    """Metadata documents, one per part type, written to files and read back without naming the types."""
    part = adapter.table(spark, d, "part")
    size = F.col("p_size").cast("bigint")
    entries = part.groupBy("p_type").agg(
        F.struct(F.sum(size).alias("complex"), F.count(size).alias("solvent")).alias("atoms"),
        F.struct(F.min(size).alias("complex"), F.max(size).alias("solvent")).alias("waters"),
    )
    entry = F.struct(F.concat(F.lower("p_type"), F.lit("_edge.json")).alias("edge"), "atoms", "waters")
    documents = entries.select(F.to_json(F.create_map("p_type", entry)).alias("value"))
    path = scratch_dir(spark, "metadata")
    documents.write.text(path)
    return reshape.sizes_of(read_metadata_documents(spark, path, per_line=True))


def q_finite_filter(spark: SparkSession, d: str) -> DataFrame:
    li = adapter.table(spark, d, "lineitem")
    value = (
        F.when(F.col("l_discount") == 0, F.lit(float("nan")))
        .when(F.col("l_tax") == 0, F.lit(float("inf")))
        .when((F.col("l_returnflag") == "N") & (F.col("l_linestatus") == "F"), F.lit(float("-inf")))
        .when(F.col("l_quantity") < 3, F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice") * F.col("l_discount"))
    )
    return finite(li.select("l_orderkey", "l_linenumber", value.alias("value")), "value")


def q_finite_flags(spark: SparkSession, d: str) -> DataFrame:
    """The finite test as a value (NULL stays NULL), counted per outcome."""
    li = adapter.table(spark, d, "lineitem")
    value = (
        F.when(F.col("l_discount") == 0, F.lit(float("nan")))
        .when(F.col("l_tax") == 0, F.lit(float("inf")))
        .when(F.col("l_quantity") < 3, F.lit(None).cast("double"))
        .otherwise(F.col("l_extendedprice"))
    )
    return (
        li.select(is_finite(value).alias("finite"))
        .groupBy("finite")
        .agg(F.count(F.lit(1)).alias("rows"))
    )


def q_phase_label(spark: SparkSession, d: str) -> DataFrame:
    part = adapter.table(spark, d, "part")
    name = F.regexp_replace(F.col("p_name"), " ", "_")
    return part.select(
        "p_partkey",
        strip_suffix(name, ("ring", "bolt")).alias("stem"),
        phase_label(name, ("ring", "bolt")).alias("label"),
        phase_label(F.col("p_brand"), ("1", "2")).alias("brand_label"),
    )


def q_json_extract(spark: SparkSession, d: str) -> DataFrame:
    ev = adapter.table(spark, d, "events")
    return ev.select("event_id", F.get_json_object("props", "$.k").cast("double").alias("k"))


def q_path_extract(spark: SparkSession, d: str) -> DataFrame:
    pages = adapter.table(spark, d, "pages")
    url = F.col("url")
    return pages.select(
        "page_id",
        path_group(url, r"^https?://([^/?#]+)", 1).alias("host"),
        path_group(url, r"^https?://[^/]+/([a-z]{2})/", 1).alias("lang"),
        F.regexp_replace(url, r"[?#].*$", "").alias("base"),
        F.regexp_replace(F.regexp_replace(url, r"[?#].*$", ""), r"\.html$", "").alias("stem"),
    )


def _run_paths(ev: DataFrame) -> DataFrame:
    deeper = F.when(F.col("event_type") == "view", F.lit("/nested")).otherwise(F.lit(""))
    return ev.select(
        "event_id",
        F.concat(
            F.lit("s3a://bucket/runs/"),
            F.date_format("ts", "yyyy-MM-dd"),
            deeper,
            F.lit("/"),
            F.col("event_type"),
            F.lit("-"),
            F.col("event_id").cast("string"),
            F.when(F.col("event_type") == "click", F.lit("/manifest.json")).otherwise(
                F.lit("/output/md_benchmark.out")
            ),
        ).alias("path"),
    )


def q_run_path_extract(spark: SparkSession, d: str) -> DataFrame:
    paths = _run_paths(adapter.table(spark, d, "events"))
    p = F.col("path")
    return paths.select(
        "event_id",
        run_date_from_path(p).alias("run_date"),
        run_id_from_path(p, "output/md_benchmark.out").alias("run_id"),
        run_id_from_path(p, "manifest.json").alias("manifest_run_id"),
    )


def q_domain_order(spark: SparkSession, d: str) -> DataFrame:
    li = adapter.table(spark, d, "lineitem")
    return (
        li.select(F.col("l_linenumber").cast("bigint").alias("mps_process_count"))
        .distinct()
        .select("mps_process_count", domain_position("mps_process_count", CONCURRENCY_LEVELS).alias("mps_rank"))
    )


# --- file jobs: export round trips and price snapshots ----------------------


def _export_roundtrip(spark: SparkSession, d: str, export) -> DataFrame:
    root = run_fixture.tree_for(spark, d)
    out = scratch_dir(spark, "fact")
    export(spark, root, out, on_bad="reject")
    return read_fact(spark, out)


def q_md_export_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return _export_roundtrip(spark, d, md_export)


def q_rbfe_export_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return _export_roundtrip(spark, d, rbfe_export)


def _relative(path: str) -> Column:
    return F.regexp_extract(path, r"runs/.*$", 0).alias("rel_path")


def q_republished_fact(spark: SparkSession, d: str) -> DataFrame:
    """The MD rows published over an older version that held the RBFE rows."""
    fact, out = adapter.fact(spark, d), scratch_dir(spark, "published")
    for kind in (RBFE, MD):
        write_fact(fact.where(F.col("benchmark_type") == kind), out)
    return read_fact(spark, out)


def q_schema_drift(spark: SparkSession, d: str) -> DataFrame:
    """Keys of the run files against those that the exports of ten systems expect; no file has the last two."""
    return drift_report(read_run_tree(spark, run_fixture.tree_for(spark, d)), (*DEFAULT_SYSTEMS[1:], "hne1", "pfkfb3"))


def q_unmatched_run_files(spark: SparkSession, d: str) -> DataFrame:
    """Run files of all kinds whose path gives no run id."""
    tree = read_run_tree(spark, run_fixture.tree_for(spark, d))
    parsed = [
        run_outputs(tree, MD_OUTPUT_FILE, schemas.md_output(), "reject"),
        run_outputs(tree, RBFE_OUTPUT_FILE, schemas.rbfe_output(), "reject"),
        parse_manifests(tree, "reject"),
    ]
    return reduce(DataFrame.unionByName, map(unmatched_paths, parsed)).select(_relative("path"))


def q_rejected_run_files(spark: SparkSession, d: str) -> DataFrame:
    """What the exports leave out, and why."""
    return export_rejects(read_run_tree(spark, run_fixture.tree_for(spark, d))).select(_relative("path"), "reason")


def q_duplicate_manifests(spark: SparkSession, d: str) -> DataFrame:
    """Run ids with more than one manifest: they multiply fact rows."""
    tree = read_run_tree(spark, run_fixture.tree_for(spark, d))
    return duplicate_keys(manifests(tree, on_bad="reject"), ["run_id"])


def _landed_documents(spark: SparkSession, d: str) -> DataFrame:
    """The price documents, landed as text files (one per line, in order) and read back."""
    path = scratch_dir(spark, "price-documents")
    price_fixture.price_documents(spark, d).orderBy("doc_pos").select("doc").write.text(path)
    return read_price_documents_text(spark, path)


def q_price_snapshot(spark: SparkSession, d: str) -> DataFrame:
    snap = price_snapshot(_landed_documents(spark, d), price_fixture.wanted_types(spark, d), "us-east-1")
    path = write_prices(snap, scratch_dir(spark, "prices"), dt.date(2026, 4, 1))
    return read_snapshot(spark, path)


def q_price_filter(spark: SparkSession, d: str) -> DataFrame:
    return price_snapshot(
        price_fixture.price_documents(spark, d), price_fixture.wanted_types(spark, d), "us-west-2"
    )


# --- registry --------------------------------------------------------------

QUERIES: dict[str, QueryFn] = {
    "cost_view": q_cost_view,
    "md_by_concurrency": q_md_by_concurrency,
    "rbfe_by_concurrency": q_rbfe_by_concurrency,
    "median_by_system_phase": q_median_by_system_phase,
    "median_by_system_phase_sorted": q_median_by_system_phase_sorted,
    "winner_ns_per_day": q_winner_ns_per_day,
    "winner_ns_per_dollar": q_winner_ns_per_dollar,
    "md_comparison": q_md_comparison,
    "rbfe_comparison": q_rbfe_comparison,
    "rbfe_edge_cost_winner": q_rbfe_edge_cost_winner,
    "md_scaling": q_md_scaling,
    "rbfe_scaling": q_rbfe_scaling,
    "materialised_charts": q_materialised_charts,
    "cost_view_spread": q_cost_view_spread,
    "summary_order": q_summary_order,
    "md_scaling_order": q_md_scaling_order,
    "rbfe_scaling_order": q_rbfe_scaling_order,
    "selector_guard": q_selector_guard,
    "snapshot_months": q_snapshot_months,
    "concurrency_options": q_concurrency_options,
    "rbfe_concurrency_options": q_rbfe_concurrency_options,
    "system_options": q_system_options,
    "md_system_options": q_md_system_options,
    "default_options": q_default_options,
    "sql_md_by_concurrency": q_sql_md_by_concurrency,
    "instance_order": q_instance_order,
    "sorted_options": q_sorted_options,
    "unpivot_metrics": q_unpivot_metrics,
    "rbfe_unpivot_phases": q_rbfe_unpivot_phases,
    "system_sizes": q_system_sizes,
    "finite_filter": q_finite_filter,
    "finite_flags": q_finite_flags,
    "phase_label": q_phase_label,
    "json_extract": q_json_extract,
    "path_extract": q_path_extract,
    "run_path_extract": q_run_path_extract,
    "domain_order": q_domain_order,
    "md_export_roundtrip": q_md_export_roundtrip,
    "rbfe_export_roundtrip": q_rbfe_export_roundtrip,
    "republished_fact": q_republished_fact,
    "schema_drift": q_schema_drift,
    "unmatched_run_files": q_unmatched_run_files,
    "rejected_run_files": q_rejected_run_files,
    "duplicate_manifests": q_duplicate_manifests,
    "price_snapshot": q_price_snapshot,
    "price_filter": q_price_filter,
}

# as a returned DataFrame, and covered by tests instead: S9 (another file system),
# K6 (option list to Python) and the errors themselves that F11 and the drift report raise.
COVERS: dict[str, tuple[str, ...]] = {
    "cost_view": ("P1", "J3", "J4", "P2", "X7", "X8", "X9", "C5"),
    "md_by_concurrency": ("F3", "F5", "F8", "G1", "G2", "O2", "C6"),
    "rbfe_by_concurrency": ("F3", "F4", "F5", "G1", "G4", "O2", "C8"),
    "median_by_system_phase": ("G1",),
    "median_by_system_phase_sorted": ("G1",),
    "winner_ns_per_day": ("W1", "W6"),
    "winner_ns_per_dollar": ("W2", "W6"),
    "md_comparison": ("W1", "W2", "W6", "O6", "C6"),
    "rbfe_comparison": ("W3", "W4", "W6", "C8"),
    "rbfe_edge_cost_winner": ("X10", "W5", "W6", "C9"),
    "md_scaling": ("F6", "F7", "G3", "O3", "O5", "C7"),
    "rbfe_scaling": ("F4", "F6", "F7", "G5", "O4", "O5", "X10", "C10"),
    "materialised_charts": ("K4", "G1", "G2", "G3", "G4", "G5", "W1", "W2", "W3", "W4", "W5", "C6", "C7", "C8", "C9", "C10"),
    "cost_view_spread": ("J3", "J4", "C5"),
    "summary_order": ("O2",),
    "md_scaling_order": ("O3",),
    "rbfe_scaling_order": ("O4",),
    "selector_guard": ("F11",),
    "snapshot_months": ("X13",),
    "concurrency_options": ("G6", "O1", "C11"),
    "rbfe_concurrency_options": ("G6", "O1", "C11"),
    "system_options": ("G7", "O1", "C11"),
    "md_system_options": ("G7", "O1", "C11"),
    "default_options": ("G9", "C11"),
    "sql_md_by_concurrency": ("K5", "F5", "G1", "G2", "O2"),
    "instance_order": ("O5",),
    "sorted_options": ("O1", "K6"),
    "unpivot_metrics": ("R2", "P3"),
    "rbfe_unpivot_phases": ("R3", "X2", "X5", "X6", "P8", "P9"),
    "system_sizes": ("S4", "R1", "P6", "C4"),
    "finite_filter": ("F2",),
    "finite_flags": ("F2",),
    "phase_label": ("X2", "X5", "X6"),
    "json_extract": ("P7", "X4", "X12"),
    "path_extract": ("X1", "X2"),
    "run_path_extract": ("S8", "X1"),
    "domain_order": ("O5",),
    "md_export_roundtrip": ("S2", "S5", "S7", "S8", "X1", "X3", "F1", "R2", "J1", "F2", "P4", "P5", "K1", "C1"),
    "rbfe_export_roundtrip": ("S3", "S6", "S7", "S8", "P7", "P8", "R3", "X2", "X5", "J2", "F2", "K2", "C2"),
    "republished_fact": ("K1", "K2", "S2", "S3"),
    "schema_drift": ("S5", "S6", "S7", "P7"),
    "unmatched_run_files": ("S8", "X1"),
    "rejected_run_files": ("S5", "S6", "S7"),
    "duplicate_manifests": ("S7", "F1"),
    "price_snapshot": ("S10", "F9", "J5", "X11", "X12", "F10", "G8", "J6", "K3", "S1", "X13", "C3"),
    "price_filter": ("F9", "J5", "J6"),
}

_MEDIANS_BY_PHASE = _V + _median_sql(
    "system, total_system_size, phase", "TRUE"
)

_MD_SUMMARY = _median_sql(_CONC_KEYS, f"benchmark_type = 'md' AND mps_process_count = {MPS}")
_RBFE_SUMMARY = _median_sql(
    _CONC_KEYS, f"benchmark_type = 'rbfe' AND phase = 'complex' AND mps_process_count = {MPS}"
)

_MD_SCALING = _median_sql(_SCALE_KEYS, f"benchmark_type = 'md' AND system = '{MD_SYSTEM}' AND mps_process_count IN (1, 2, 4)")
_RBFE_SCALING = _median_sql(
    _SCALE_KEYS, f"benchmark_type = 'rbfe' AND phase = 'complex' AND system = '{RBFE_SYSTEM}' AND mps_process_count IN (1, 2, 4)"
)


def _position_sql(order: str) -> str:
    return f"CAST(row_number() OVER (ORDER BY {order}) AS BIGINT) AS position"


def _drift_sql(systems: Sequence[str]) -> str:
    """Counts of keys in the files that ``run_fixture`` derives from ``events``."""
    names = _sql_list(systems)
    return run_fixture.KEYS_SQL + f""", expected AS (
  SELECT 'md_benchmark.out' AS file_name, unnest([{names}]) AS key
  UNION ALL SELECT 'rbfe_benchmark.out', s || p FROM (SELECT unnest([{names}]) AS s), (VALUES (''), ('.complex'), ('.solvent')) AS v(p)
  UNION ALL SELECT 'manifest.json', unnest(['schema_version', 'instance_type', 'ami_id', 'mps_process_count']))
SELECT file_name, key, coalesce(documents, 0) AS documents,
       CASE WHEN documents IS NULL THEN 'missing' WHEN e.key IS NULL THEN 'unexpected' ELSE 'present' END AS status
FROM met FULL JOIN expected e USING (file_name, key)"""


_FINITE_VALUE = """CASE WHEN l_discount = 0 THEN 'NaN'::DOUBLE
            WHEN l_tax = 0 THEN 'Infinity'::DOUBLE
            WHEN l_returnflag = 'N' AND l_linestatus = 'F' THEN '-Infinity'::DOUBLE
            WHEN l_quantity < 3 THEN NULL
            ELSE l_extendedprice * l_discount END"""

ORACLE_SQL: dict[str, str] = {
    "cost_view": _V
    + "SELECT benchmark_type, mps_process_count, run_date, run_id, system, phase, metric_name, "
    "metric_value, instance_type, ami, total_system_size, price_per_hour, dollars_per_ns, "
    "ns_per_dollar FROM v",
    "md_by_concurrency": _V + _MD_SUMMARY,
    "sql_md_by_concurrency": _V + _MD_SUMMARY,
    "rbfe_by_concurrency": _V + _RBFE_SUMMARY,
    "median_by_system_phase": _MEDIANS_BY_PHASE,
    "median_by_system_phase_sorted": _MEDIANS_BY_PHASE,
    "winner_ns_per_day": _V
    + f", s AS ({_MD_SUMMARY}) SELECT s.*, {_winner_sql('ns_per_day', 'is_winner')}, {_rank_sql('ns_per_day')} FROM s",
    "winner_ns_per_dollar": _V
    + f", s AS ({_MD_SUMMARY}) SELECT s.*, {_winner_sql('ns_per_dollar', 'is_winner')}, {_rank_sql('ns_per_dollar')} FROM s",
    "md_comparison": _V
    + f", s AS ({_MD_SUMMARY}) SELECT s.*, "
    f"{_winner_sql('ns_per_day', 'is_throughput_winner')}, "
    f"{_winner_sql('ns_per_dollar', 'is_cost_winner')} FROM s",
    "rbfe_comparison": _V
    + f", s AS ({_RBFE_SUMMARY}) SELECT s.*, "
    f"{_winner_sql('ns_per_day', 'is_throughput_winner')}, "
    f"{_winner_sql('ns_per_dollar', 'is_cost_winner')} FROM s",
    "rbfe_edge_cost_winner": _V
    + f", s AS ({_RBFE_SUMMARY}), e AS (SELECT s.*, 66 / NULLIF(ns_per_dollar, 0) "
    f"AS dollars_per_edge FROM s) SELECT e.*, "
    f"{_winner_sql('dollars_per_edge', 'is_winner', asc=True)} FROM e",
    "md_scaling": _V
    + f", s AS ({_median_sql(_SCALE_KEYS, f"benchmark_type = 'md' AND system = '{MD_SYSTEM}' AND mps_process_count IN (1, 2, 4)")}) "
    f"SELECT s.*, CAST(list_position({_INSTANCE_LIST}, instance_type) AS BIGINT) AS instance_rank, "
    f"CAST(list_position({_MPS_LIST}, mps_process_count) AS BIGINT) AS mps_rank FROM s",
    "rbfe_scaling": _V
    + f", s AS ({_median_sql(_SCALE_KEYS, f"benchmark_type = 'rbfe' AND phase = 'complex' AND system = '{RBFE_SYSTEM}' AND mps_process_count IN (1, 2, 4)")}) "
    f"SELECT s.*, 66 / NULLIF(ns_per_dollar, 0) AS dollars_per_edge, "
    f"CAST(list_position({_INSTANCE_LIST}, instance_type) AS BIGINT) AS instance_rank, "
    f"CAST(list_position({_MPS_LIST}, mps_process_count) AS BIGINT) AS mps_rank FROM s",
    "concurrency_options": _V
    + "SELECT DISTINCT mps_process_count FROM fact WHERE benchmark_type = 'md' "
    "ORDER BY mps_process_count",
    "rbfe_concurrency_options": _V
    + "SELECT DISTINCT mps_process_count FROM fact WHERE benchmark_type = 'rbfe' "
    "ORDER BY mps_process_count",
    "system_options": _V
    + "SELECT DISTINCT system FROM fact WHERE benchmark_type = 'rbfe' AND phase = 'complex' "
    "ORDER BY system",
    "md_system_options": _V
    + "SELECT DISTINCT system FROM fact WHERE benchmark_type = 'md' ORDER BY system",
    "default_options": _V
    + "SELECT min(mps_process_count) AS mps_process_count FROM fact WHERE benchmark_type = 'md'",
    "instance_order": "WITH t AS (SELECT DISTINCT CASE WHEN s_suppkey % 3 = 0 THEN "
    f"{_INSTANCE_LIST}[CAST(s_suppkey // 3 AS BIGINT) % 3 + 1] ELSE s_name END AS instance_type FROM supplier), "
    f"r AS (SELECT instance_type, CAST(list_position({_INSTANCE_LIST}, instance_type) AS BIGINT) AS instance_rank FROM t) "
    "SELECT *, CAST(row_number() OVER (ORDER BY instance_rank NULLS LAST, instance_type) AS INTEGER) AS position FROM r",
    "sorted_options": _V
    + ", o AS (SELECT DISTINCT 'md concurrency' AS selector, mps_process_count AS n, CAST(mps_process_count AS VARCHAR) AS option "
    "FROM fact WHERE benchmark_type = 'md' UNION SELECT DISTINCT 'rbfe concurrency', mps_process_count, "
    "CAST(mps_process_count AS VARCHAR) FROM fact WHERE benchmark_type = 'rbfe' UNION SELECT DISTINCT 'md system', 0, system "
    "FROM fact WHERE benchmark_type = 'md' UNION SELECT DISTINCT 'rbfe system', 0, system FROM fact "
    "WHERE benchmark_type = 'rbfe' AND phase = 'complex') SELECT selector, option, "
    "CAST(row_number() OVER (PARTITION BY selector ORDER BY n, option) AS INTEGER) AS position FROM o",
    "cost_view_spread": _V
    + "SELECT benchmark_type, mps_process_count, run_date, run_id, system, phase, metric_name, "
    "metric_value, instance_type, ami, total_system_size, price_per_hour, dollars_per_ns, "
    "ns_per_dollar FROM v",
    "summary_order": _V + f", s AS ({_MD_SUMMARY}) SELECT *, "
    + _position_sql("system NULLS LAST, ns_per_day DESC NULLS LAST, mps_process_count, instance_type") + " FROM s",
    "md_scaling_order": _V + f", s AS ({_MD_SCALING}) SELECT *, " + _position_sql("mps_process_count, instance_type") + " FROM s",
    "rbfe_scaling_order": _V + f", s AS ({_RBFE_SCALING}) SELECT *, " + _position_sql("instance_type, mps_process_count") + " FROM s",
    "selector_guard": _V + """, o AS (
      SELECT 'md concurrency' AS selector, count(DISTINCT mps_process_count) AS n_options FROM fact WHERE benchmark_type = 'md'
      UNION ALL SELECT 'rbfe system', count(DISTINCT system) FROM fact WHERE benchmark_type = 'rbfe' AND phase = 'complex'
      UNION ALL SELECT 'rbfe system, unknown phase', count(DISTINCT system) FROM fact WHERE benchmark_type = 'rbfe' AND phase = 'vacuum'
      UNION ALL SELECT 'free energy concurrency', count(DISTINCT mps_process_count) FROM fact WHERE benchmark_type = 'free energy')
    SELECT *, CASE WHEN n_options = 0 THEN 'no options: ' || selector END AS outcome FROM o""",
    "snapshot_months": _V + "SELECT strftime(run_date, '%Y-%m') AS snapshot, count(*) AS rows FROM fact GROUP BY 1",
    "republished_fact": _V + "SELECT * FROM fact WHERE benchmark_type = 'md'",
    "schema_drift": _drift_sql((*DEFAULT_SYSTEMS[1:], "hne1", "pfkfb3")),
    "unpivot_metrics": "SELECT l_orderkey, l_linenumber, 'quantity' AS metric, l_quantity AS value FROM lineitem "
    "WHERE l_quantity IS NOT NULL UNION ALL "
    "SELECT l_orderkey, l_linenumber, 'discount', l_discount FROM lineitem WHERE l_discount <> 0 UNION ALL "
    "SELECT l_orderkey, l_linenumber, 'tax', l_tax FROM lineitem WHERE l_tax IS NOT NULL",
    "rbfe_unpivot_phases": "SELECT l_orderkey, l_linenumber, 'price' AS name, 'complex' AS phase, l_extendedprice AS value "
    "FROM lineitem WHERE l_extendedprice IS NOT NULL UNION ALL "
    "SELECT l_orderkey, l_linenumber, 'price', 'solvent', l_discount FROM lineitem WHERE l_discount <> 0 UNION ALL "
    "SELECT l_orderkey, l_linenumber, 'tax', 'complex', l_tax FROM lineitem WHERE l_tax <> 0 UNION ALL "
    "SELECT l_orderkey, l_linenumber, 'tax', 'solvent', l_quantity FROM lineitem WHERE l_quantity IS NOT NULL",
    "system_sizes": "SELECT p_type AS system, CAST(SUM(p_size) AS BIGINT) AS total_system_size "
    "FROM part GROUP BY p_type",
    "finite_filter": f"SELECT l_orderkey, l_linenumber, value FROM (SELECT l_orderkey, "
    f"l_linenumber, {_FINITE_VALUE} AS value FROM lineitem) WHERE isfinite(value)",
    "finite_flags": "SELECT isfinite(CASE WHEN l_discount = 0 THEN 'NaN'::DOUBLE "
    "WHEN l_tax = 0 THEN 'Infinity'::DOUBLE WHEN l_quantity < 3 THEN NULL "
    "ELSE l_extendedprice END) AS finite, count(*) AS rows FROM lineitem GROUP BY 1",
    "phase_label": "SELECT p_partkey, regexp_replace(replace(p_name, ' ', '_'), '_(ring|bolt)$', '') AS stem, "
    "CASE WHEN replace(p_name, ' ', '_') LIKE '%_ring' THEN 'ring' "
    "WHEN replace(p_name, ' ', '_') LIKE '%_bolt' THEN 'bolt' END AS label, "
    "CASE WHEN p_brand LIKE '%_1' THEN '1' WHEN p_brand LIKE '%_2' THEN '2' END AS brand_label "
    "FROM part",
    "json_extract": "SELECT event_id, CAST(props->>'k' AS DOUBLE) AS k FROM events",
    "path_extract": "SELECT page_id, regexp_extract(url, '^https?://([^/?#]+)', 1) AS host, "
    "regexp_extract(url, '^https?://[^/]+/([a-z]{2})/', 1) AS lang, "
    "regexp_replace(url, '[?#].*$', '') AS base, "
    "regexp_replace(regexp_replace(url, '[?#].*$', ''), '\\.html$', '') AS stem FROM pages",
    "run_path_extract": "SELECT event_id, strftime(ts, '%Y-%m-%d') AS run_date, "
    "CASE WHEN event_type NOT IN ('view', 'click') THEN event_type || '-' || event_id ELSE '' END AS run_id, "
    "CASE WHEN event_type = 'click' THEN event_type || '-' || event_id ELSE '' END AS manifest_run_id FROM events",
    "domain_order": f"SELECT DISTINCT CAST(l_linenumber AS BIGINT) AS mps_process_count, "
    f"CAST(list_position({_MPS_LIST}, CAST(l_linenumber AS BIGINT)) AS BIGINT) AS mps_rank "
    f"FROM lineitem",
    "md_export_roundtrip": run_fixture.expected_md_sql(),
    "rbfe_export_roundtrip": run_fixture.expected_rbfe_sql(),
    "unmatched_run_files": run_fixture.EXPECTED_UNMATCHED_SQL,
    "rejected_run_files": run_fixture.EXPECTED_REJECTED_SQL,
    "duplicate_manifests": run_fixture.EXPECTED_DUPLICATE_MANIFESTS_SQL,
    "price_snapshot": price_fixture.EXPECTED_EAST_SQL,
    "price_filter": price_fixture.EXPECTED_WEST_SQL,
}

ORACLE_SQL["materialised_charts"] = " UNION ALL BY NAME ".join(
    f"SELECT '{chart}' AS chart, * FROM ({ORACLE_SQL[query]})"
    for chart, query in (
        ("md_comparison", "md_comparison"),
        ("md_scaling", "md_scaling"),
        ("rbfe_comparison", "rbfe_comparison"),
        ("rbfe_edge_cost", "rbfe_edge_cost_winner"),
        ("rbfe_scaling", "rbfe_scaling"),
    )
)
