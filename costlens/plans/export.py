"""Export jobs: raw run tree -> long, finite fact -> ZSTD Parquet.

``md_export`` and ``rbfe_export`` each build one fact; ``export_all`` builds
both from a single listing of the tree.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens import schemas
from costlens.constants import (
    DEFAULT_SYSTEMS,
    MANIFEST_SCHEMA_VERSION,
    MD,
    MD_OUTPUT_FILE,
    METRIC_NAME,
    RBFE,
    RBFE_OUTPUT_FILE,
    RBFE_PHASES,
)
from costlens.operators.quality import finite
from costlens.operators.reshape import md_long, rbfe_long
from costlens.sources.publish import publish
from costlens.sources.runs import (
    DEFAULT_DAY_GLOB,
    expected_keys,
    key_counts,
    manifests,
    matched_runs,
    read_run_tree,
    rejected_files,
    run_outputs,
)


def build_fact(long: DataFrame, manifest: DataFrame, benchmark_type: str, value_col: str) -> DataFrame:
    """Join long metrics to manifests on run_id, keep finite values, shape the fact.

    Inner join on run_id only (not the date): runs without a manifest drop
    out, duplicate manifests multiply rows. The finite filter only reads the
    metric side, so the optimizer applies it before the join.
    """
    metrics = finite(long, value_col).alias("l")
    m = manifest.alias("m")
    joined = metrics.join(m, F.col("l.run_id") == F.col("m.run_id"), "inner")
    phase = F.col("l.phase") if "phase" in long.columns else F.lit(None).cast("string")
    return joined.select(
        F.lit(benchmark_type).alias("benchmark_type"),
        F.col("m.mps_process_count").alias("mps_process_count"),
        F.col("l.run_date").alias("run_date"),
        F.col("l.run_id").alias("run_id"),
        F.col("l.system").alias("system"),
        phase.alias("phase"),
        F.lit(METRIC_NAME).alias("metric_name"),
        F.col(f"l.{value_col}").alias("metric_value"),
        F.col("m.instance_type").alias("instance_type"),
        F.col("m.ami").alias("ami"),
    )


def md_fact(
    tree: DataFrame,
    systems: Sequence[str] = DEFAULT_SYSTEMS,
    version: int = MANIFEST_SCHEMA_VERSION,
    on_bad: str = "fail",
) -> DataFrame:
    """MD fact from a listed run tree; ``on_bad``: fail at, or leave out, unreadable files."""
    raw = matched_runs(run_outputs(tree, MD_OUTPUT_FILE, schemas.md_output(systems), on_bad), on_bad)
    return build_fact(md_long(raw, systems), manifests(tree, version, on_bad), MD, "ns_per_day")


def rbfe_fact(
    tree: DataFrame,
    systems: Sequence[str] = DEFAULT_SYSTEMS,
    phases: Sequence[str] = RBFE_PHASES,
    version: int = MANIFEST_SCHEMA_VERSION,
    on_bad: str = "fail",
) -> DataFrame:
    """RBFE fact from a listed run tree; ``on_bad`` as in ``md_fact``."""
    raw = matched_runs(run_outputs(tree, RBFE_OUTPUT_FILE, schemas.rbfe_output(systems, phases), on_bad), on_bad)
    return build_fact(rbfe_long(raw, systems, phases), manifests(tree, version, on_bad), RBFE, "metric_value")


def export_rejects(
    tree: DataFrame, systems: Sequence[str] = DEFAULT_SYSTEMS, phases: Sequence[str] = RBFE_PHASES
) -> DataFrame:
    """(path, reason) of every run file that an export with ``on_bad="reject"`` leaves out."""
    kinds = {MD_OUTPUT_FILE: schemas.md_output(systems), RBFE_OUTPUT_FILE: schemas.rbfe_output(systems, phases)}
    return rejected_files(tree, kinds)


def drift_report(
    tree: DataFrame, systems: Sequence[str] = DEFAULT_SYSTEMS, phases: Sequence[str] = RBFE_PHASES
) -> DataFrame:
    """(file_name, key, documents, status) of every key that is expected or met in a run file.

    ``status`` is ``present``, ``missing`` (expected, in no document; its values would just not be in the
    facts) or ``unexpected`` (met, and not read by the exports).
    """
    kinds = {MD_OUTPUT_FILE: schemas.md_output(systems), RBFE_OUTPUT_FILE: schemas.rbfe_output(systems, phases)}
    met = key_counts(tree, kinds)
    expected = tree.sparkSession.createDataFrame(expected_keys(kinds), "file_name string, key string").withColumn("_expected", F.lit(True))
    both = met.join(expected, ["file_name", "key"], "full")
    status = F.when(F.col("documents").isNull(), "missing").when(F.col("_expected").isNull(), "unexpected").otherwise("present")
    return both.select("file_name", "key", F.coalesce("documents", F.lit(0)).alias("documents"), status.alias("status"))


class MissingKeysError(ValueError):
    """Expected keys occur in no run file."""


def require_keys(report: DataFrame) -> None:
    """Raise ``MissingKeysError`` naming the keys of a drift report that no file holds."""
    missing = report.where("status = 'missing'").orderBy("file_name", "key").collect()  # at most the expected keys
    if missing:
        raise MissingKeysError("in no run file: " + ", ".join(f"{r.file_name}: {r.key}" for r in missing))


def write_fact(df: DataFrame, path: str, partition_by: Sequence[str] | None = None) -> None:
    """Publish ``df`` at ``path`` as ZSTD-compressed Parquet; an older fact is readable until the new one is whole."""
    publish(df, path, partition_by=partition_by, compression="zstd")


def md_export(
    spark: SparkSession,
    root: str,
    out: str | None = None,
    systems: Sequence[str] = DEFAULT_SYSTEMS,
    day_glob: str = DEFAULT_DAY_GLOB,
    version: int = MANIFEST_SCHEMA_VERSION,
    on_bad: str = "fail",
) -> DataFrame:
    """MD fact from the run tree under ``root``; written to ``out`` when given."""
    fact = md_fact(read_run_tree(spark, root, day_glob), systems, version, on_bad)
    if out:
        write_fact(fact, out)
    return fact


def rbfe_export(
    spark: SparkSession,
    root: str,
    out: str | None = None,
    systems: Sequence[str] = DEFAULT_SYSTEMS,
    day_glob: str = DEFAULT_DAY_GLOB,
    version: int = MANIFEST_SCHEMA_VERSION,
    on_bad: str = "fail",
) -> DataFrame:
    """RBFE fact (two phases per system) from the run tree under ``root``."""
    fact = rbfe_fact(read_run_tree(spark, root, day_glob), systems, RBFE_PHASES, version, on_bad)
    if out:
        write_fact(fact, out)
    return fact


def export_all(
    spark: SparkSession,
    root: str,
    md_out: str,
    rbfe_out: str,
    systems: Sequence[str] = DEFAULT_SYSTEMS,
    day_glob: str = DEFAULT_DAY_GLOB,
    version: int = MANIFEST_SCHEMA_VERSION,
    partition_by: Sequence[str] | None = None,
    rejects_out: str | None = None,
) -> None:
    """Both exports from one listing of the tree.

    An unreadable or misplaced file fails the job, unless ``rejects_out`` says
    where to write (path, reason) of the files left out.

    The two facts share one tree ``DataFrame`` and therefore one file listing
    (and one consistent file set). Each scan filters on file metadata only,
    so Spark opens just the files of its kind: MD outputs, RBFE outputs and
    manifests; nothing is cached.
    """
    tree = read_run_tree(spark, root, day_glob)
    on_bad = "reject" if rejects_out else "fail"
    if rejects_out:
        publish(export_rejects(tree, systems), rejects_out)
    write_fact(md_fact(tree, systems, version, on_bad), md_out, partition_by)
    write_fact(rbfe_fact(tree, systems, RBFE_PHASES, version, on_bad), rbfe_out, partition_by)
