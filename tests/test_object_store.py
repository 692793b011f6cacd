"""Jobs over a Hadoop scheme that only Spark's file systems resolve."""

import pytest
from test_export import FULL_MD, MD_1_1, RBFE_1_2, manifest, put

from costlens.plans.export import export_all, md_export
from costlens.sources.publish import versions
from costlens.sources.runs import read_run_tree
from costlens.sources.tables import read_fact


@pytest.fixture(scope="module")
def store(spark, tmp_path_factory):
    """viewfs://bucket/, a mount of a local folder; the path below it exists nowhere else."""
    root = tmp_path_factory.mktemp("store")
    spark._jsc.hadoopConfiguration().set("fs.viewfs.mounttable.bucket.link./in", f"file://{root}")
    put(root, "tree/runs/2026-04-01/r1/manifest.json", manifest(4, "g4dn.xlarge", "ami-a", 1))
    put(root, "tree/runs/2026-04-01/r1/output/md_benchmark.out", MD_1_1)
    put(root, "tree/runs/2026-04-01/r1/output/rbfe_benchmark.out", RBFE_1_2)
    for run in ("r 8", "r+9", "100%", "é#1"):
        put(root, f"tree/runs/2026-04-04/{run}/manifest.json", manifest(4, "g5.xlarge", "ami-d", 1))
        put(root, f"tree/runs/2026-04-04/{run}/output/md_benchmark.out", FULL_MD)
    return "viewfs://bucket/in"


def test_export_lists_reads_and_names_runs_of_the_store(spark, store):
    paths = {r.path for r in read_run_tree(spark, f"{store}/tree").select("path").collect()}
    assert len(paths) == 11 and all(p.startswith("viewfs://bucket/in/tree/runs/2026-04-0") for p in paths)
    rows = md_export(spark, f"{store}/tree").collect()
    assert {r.run_id for r in rows} == {"r1", "r 8", "r+9", "100%", "é#1"}
    assert {str(r.run_date) for r in rows if r.run_id != "r1"} == {"2026-04-04"}


def test_facts_are_published_in_the_store(spark, store):
    for _ in range(2):
        export_all(spark, f"{store}/tree", f"{store}/md", f"{store}/rbfe", partition_by=["mps_process_count"])
    assert read_fact(spark, f"{store}/md").count() == 5 + 4 * 8
    assert read_fact(spark, f"{store}/rbfe").count() == 14
    assert len(versions(spark, f"{store}/md")) == 2
