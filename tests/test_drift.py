import json

import pytest
from test_export import manifest, put

from costlens.operators import options
from costlens.operators.reshape import sizes_of
from costlens.plans.export import MissingKeysError, drift_report, require_keys
from costlens.sources.runs import read_run_tree
from costlens.sources.tables import read_metadata_documents


def test_keys_met_and_expected(spark, tmp_path):
    put(tmp_path, "runs/2026-04-01/r1/output/md_benchmark.out", '{"bace": 1, "new": NaN}')
    put(tmp_path, "runs/2026-04-01/r2/output/md_benchmark.out", '[{"bace": null}, {"bace": 2}]')
    put(tmp_path, "runs/2026-04-01/r3/output/md_benchmark.out", "not json")
    put(tmp_path, "runs/2026-04-01/r1/output/rbfe_benchmark.out", '{"bace": {"complex": 1, "gas": 2}, "p38": null}')
    put(tmp_path, "runs/2026-04-01/r1/manifest.json", manifest(4, "g5", "a", 1))
    report = drift_report(read_run_tree(spark, str(tmp_path)), ("bace", "p38"))
    got = {(r.file_name, r.key): (r.documents, r.status) for r in report.collect()}
    assert got == {
        ("md_benchmark.out", "bace"): (3, "present"), ("md_benchmark.out", "new"): (1, "unexpected"), ("md_benchmark.out", "p38"): (0, "missing"),
        ("rbfe_benchmark.out", "bace"): (1, "present"), ("rbfe_benchmark.out", "bace.complex"): (1, "present"),
        ("rbfe_benchmark.out", "bace.gas"): (1, "unexpected"), ("rbfe_benchmark.out", "bace.solvent"): (0, "missing"),
        ("rbfe_benchmark.out", "p38"): (1, "present"), ("rbfe_benchmark.out", "p38.complex"): (0, "missing"), ("rbfe_benchmark.out", "p38.solvent"): (0, "missing"),
        **{("manifest.json", k): (1, "present") for k in ("schema_version", "instance_type", "ami_id", "mps_process_count")},
    }
    with pytest.raises(MissingKeysError, match="md_benchmark.out: p38, rbfe_benchmark.out: bace.solvent"):
        require_keys(report)
    require_keys(report.where("status <> 'missing'"))


def test_metadata_of_unknown_systems(spark, tmp_path):
    (tmp_path / "one.json").write_text(json.dumps({"a b": {"atoms": {"complex": 7, "solvent": 1}, "other": [1]}, "c": {"edge": "x"}, "d": None}, indent=2))
    (tmp_path / "two.json").write_text(json.dumps({"a b": {"atoms": {"complex": 9}}}))
    (tmp_path / "three.json").write_text("  \n")
    got = sizes_of(read_metadata_documents(spark, str(tmp_path)))
    assert sorted(map(str, map(tuple, got.collect()))) == ["('a b', 7)", "('a b', 9)", "('c', None)"]
    lines = tmp_path / "lines.jsonl"
    lines.write_text("".join(json.dumps({f"s{i}": {"atoms": {"complex": i}}}) + "\n" for i in range(500)))
    rows = sizes_of(read_metadata_documents(spark, str(lines), per_line=True)).collect()
    assert {r.system: r.total_system_size for r in rows} == {f"s{i}": i for i in range(500)}
    (tmp_path / "bad.json").write_text("[1, 2]")
    with pytest.raises(Exception):
        read_metadata_documents(spark, str(tmp_path / "bad.json")).collect()


def test_guard_says_what_the_error_would(spark):
    df = spark.createDataFrame([(1,), (2,)], "mps_process_count long")
    assert tuple(options.guard(df, "none").first()) == (2, None)
    assert tuple(options.guard(df.limit(0), "none").first()) == (0, "none")
