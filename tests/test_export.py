import json

import pyarrow.parquet as pq
import pytest

from costlens.plans.export import export_all, md_export, rbfe_export
from costlens.sources.runs import (
    matched_runs,
    read_run_tree,
    run_outputs,
    unmatched_paths,
)
from costlens import schemas
from costlens.sources.publish import published
from costlens.sources.tables import read_fact

MD_1_1 = (
    '{"bace": 120.5, "p38": 131.0, "jnk1": NaN, "cdk2": null, "ptp1b": 150.25, '
    '"tyk2": Infinity, "mcl1": 0.0, "thrombin": 160.0}'
)
RBFE_1_2 = (
    '{"bace": {"complex": 80.5, "solvent": 400.0}, "p38": {"complex": "75.25", "solvent": NaN}, '
    '"jnk1": {"complex": null, "solvent": 390.0}, "cdk2": {"complex": 60.0, "solvent": 410.0}, '
    '"ptp1b": {"complex": 82.0, "solvent": 402.0}, "tyk2": {"complex": 83.0, "solvent": 403.0}, '
    '"mcl1": {"complex": 110.0, "solvent": 404.0}, "thrombin": {"complex": 95.0, "solvent": 405.0}}'
)
SYSTEMS = ["bace", "p38", "jnk1", "cdk2", "ptp1b", "tyk2", "mcl1", "thrombin"]
FULL_MD = json.dumps({s: 100.0 + i for i, s in enumerate(SYSTEMS)}, indent=2)


def manifest(version, instance, ami, mps):
    return json.dumps(
        {"schema_version": version, "instance_type": instance, "ami_id": ami, "mps_process_count": mps},
        indent=2,
    )


def put(root, rel, text):
    path = root / rel
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(text)


@pytest.fixture(scope="module")
def tree_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("tree")
    put(root, "runs/2026-04-01/r1/manifest.json", manifest(4, "g4dn.xlarge", "ami-a", 1))
    put(root, "runs/2026-04-01/r1/output/md_benchmark.out", MD_1_1)
    put(root, "runs/2026-04-01/r1/output/rbfe_benchmark.out", RBFE_1_2)
    put(root, "runs/2026-04-01/r2/manifest.json", manifest(4, "g5.xlarge", "ami-a", 2))
    put(root, "runs/2026-04-01/r2/output/md_benchmark.out", FULL_MD)
    put(root, "runs/2026-04-02/r3/manifest.json", manifest(3, "g6e.xlarge", "ami-b", 4))
    put(root, "runs/2026-04-02/r3/output/md_benchmark.out", FULL_MD)
    put(root, "runs/2026-04-02/r4/manifest.json", manifest(4, "g6e.xlarge", "ami-b", 4))
    put(root, "runs/2026-04-02/r5/output/md_benchmark.out", FULL_MD)
    put(root, "runs/2026-04-03/r2/manifest.json", manifest(4, "g5.xlarge", "ami-c", 2))
    put(root, "runs/2026-04-01/group/r6/manifest.json", manifest(4, "g5.xlarge", "ami-a", 1))
    put(root, "runs/2026-04-01/group/r6/output/md_benchmark.out", FULL_MD)
    put(root, "runs/2025-12-31/r7/manifest.json", manifest(4, "g5.xlarge", "ami-a", 1))
    put(root, "runs/2025-12-31/r7/output/md_benchmark.out", FULL_MD)
    put(root, "runs/2026-04-04/r 8/manifest.json", manifest(4, "g5.xlarge", "ami-d", 1))
    put(root, "runs/2026-04-04/r 8/output/md_benchmark.out", FULL_MD)
    put(root, "runs/2026-04-04/r+9/manifest.json", manifest(4, "g5.xlarge", "ami-d", 1))
    put(root, "runs/2026-04-04/r+9/output/md_benchmark.out", FULL_MD)
    put(root, "runs/2026-04-04/r10/output/notes.txt", "not a run file")
    return str(root)


def test_md_export_rows(spark, tree_root, tmp_path):
    out = str(tmp_path / "md")
    md_export(spark, tree_root, out, on_bad="reject")
    rows = read_fact(spark, out).collect()
    by_run = {}
    for r in rows:
        by_run.setdefault(r.run_id, []).append(r)
    assert set(by_run) == {"r1", "r2", "r7", "r 8", "r+9"}
    r1 = {r.system: r.metric_value for r in by_run["r1"]}
    assert r1 == {"bace": 120.5, "p38": 131.0, "ptp1b": 150.25, "mcl1": 0.0, "thrombin": 160.0}
    assert len(by_run["r2"]) == 16  # duplicate manifest multiplies rows
    assert {r.ami for r in by_run["r2"]} == {"ami-a", "ami-c"}
    assert len(by_run["r 8"]) == 8 and len(by_run["r+9"]) == 8
    assert len(rows) == 45
    first = by_run["r1"][0]
    assert (first.benchmark_type, first.phase, first.metric_name, first.mps_process_count) == (
        "md", None, "ns_per_day", 1
    )
    assert str(first.run_date) == "2026-04-01"


def test_written_fact_is_zstd_parquet_with_fact_schema(spark, tree_root, tmp_path):
    out = tmp_path / "md"
    md_export(spark, tree_root, str(out), on_bad="reject")
    files = sorted(out.glob("v-*/*.parquet"))
    assert files
    meta = pq.ParquetFile(files[0]).metadata
    if meta.num_row_groups:
        assert meta.row_group(0).column(0).compression == "ZSTD"
    assert read_fact(spark, str(out)).schema == schemas.FACT


def test_rbfe_export_rows(spark, tree_root):
    rows = rbfe_export(spark, tree_root, on_bad="reject").collect()
    assert len(rows) == 14
    got = {(r.system, r.phase): r.metric_value for r in rows}
    assert got[("p38", "complex")] == 75.25  # quoted number kept
    assert ("p38", "solvent") not in got  # NaN dropped
    assert ("jnk1", "complex") not in got  # null dropped
    assert got[("jnk1", "solvent")] == 390.0
    assert {r.benchmark_type for r in rows} == {"rbfe"}


def test_misplaced_files_are_reported_or_fail(spark, tree_root):
    tree = read_run_tree(spark, tree_root)
    outputs = run_outputs(tree, "md_benchmark.out", schemas.md_output())
    bad = [r.path for r in unmatched_paths(outputs).collect()]
    assert len(bad) == 1 and bad[0].endswith("runs/2026-04-01/group/r6/output/md_benchmark.out")
    with pytest.raises(Exception, match="outside the layout"):
        matched_runs(outputs).collect()
    with pytest.raises(Exception, match="outside the layout"):
        md_export(spark, tree_root).collect()


def test_tree_listing_ignores_other_files_and_takes_every_year(spark, tree_root):
    rows = read_run_tree(spark, tree_root).collect()
    assert {r.file_name for r in rows} == {"manifest.json", "md_benchmark.out", "rbfe_benchmark.out"}
    assert any("2025-12-31" in r.path for r in rows)
    assert not any("2025" in r.path for r in read_run_tree(spark, tree_root, "2026-*-*").collect())


def test_export_all_matches_single_exports(spark, tree_root, tmp_path):
    md_out, rbfe_out = str(tmp_path / "md"), str(tmp_path / "rbfe")
    export_all(spark, tree_root, md_out, rbfe_out, rejects_out=str(tmp_path / "rejects"))
    assert read_fact(spark, md_out).count() == 45
    assert read_fact(spark, rbfe_out).count() == 14
    part = str(tmp_path / "md_by_day")
    export_all(spark, tree_root, part, str(tmp_path / "rbfe_by_day"), partition_by=["run_date"], rejects_out=str(tmp_path / "r2"))
    assert read_fact(spark, part).count() == 45
    # Partitioned for pruning: same rows, same column order.
    pruned = str(tmp_path / "md_by_type")
    export_all(
        spark, tree_root, pruned, str(tmp_path / "rbfe_by_type"),
        partition_by=["benchmark_type", "mps_process_count"], rejects_out=str(tmp_path / "r3"),
    )
    back = read_fact(spark, pruned)
    assert back.schema == schemas.FACT
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, read_fact(spark, md_out).collect()))
    plan = back.where("mps_process_count = 2")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(mps_process_count" in plan


@pytest.fixture(scope="module")
def odd_root(tmp_path_factory):
    root = tmp_path_factory.mktemp("odd")
    for run in ("lines", "rows", "list", "empty", "cut", "text", "version", "quoted", "broken", "future"):
        day = "2027-01-02" if run == "future" else "2026-04-01"
        text = {"version": manifest(4.0, "g5", "a", 1), "quoted": manifest(4, "g5", "a", "1"), "broken": "{"}
        put(root, f"runs/{day}/{run}/manifest.json", text.get(run, manifest(4, "g5", "a", 1)))
        out = {"lines": '{"bace": 1.5}\n\n{"bace": 2.5, "p38": 3.0}\r\n', "rows": '{"bace": 1.5}  {"bace": 2.5}',
               "list": '[{"bace": 1.5},\n {"p38": NaN}]', "empty": " ", "cut": '{"bace": 1.5, "p3', "text": "none"}
        put(root, f"runs/{day}/{run}/output/md_benchmark.out", out.get(run, '{"bace": 7.5}'))
    return str(root)


def test_every_form_of_document_is_read(spark, odd_root):
    got = md_export(spark, odd_root, on_bad="reject").collect()
    assert sorted((r.run_id, r.system, r.metric_value) for r in got) == [
        ("future", "bace", 7.5), ("lines", "bace", 1.5), ("lines", "bace", 2.5), ("lines", "p38", 3.0), ("list", "bace", 1.5),
        ("rows", "bace", 1.5), ("rows", "bace", 2.5),
    ]


def test_unreadable_files_fail_or_are_listed(spark, odd_root, tmp_path):
    with pytest.raises(Exception, match="unreadable run file"):
        md_export(spark, odd_root).collect()
    with pytest.raises(Exception, match="unreadable run file"):
        export_all(spark, odd_root, str(tmp_path / "a"), str(tmp_path / "b"))
    export_all(spark, odd_root, str(tmp_path / "md"), str(tmp_path / "rbfe"), rejects_out=str(tmp_path / "rejects"))
    rejects = {r.path.split("/")[-2 - ("output" in r.path)]: r.reason for r in spark.read.parquet(published(spark, str(tmp_path / "rejects"))).collect()}
    json, kind = "not JSON, or no document", "a field does not fit its type"
    assert rejects == {"empty": json, "cut": json, "text": json, "broken": json, "version": kind, "quoted": kind}
    assert read_fact(spark, str(tmp_path / "md")).count() == 7
