import json

from test_export import FULL_MD, MD_1_1, RBFE_1_2, manifest, put
from test_pricing import DOCS

from costlens.__main__ import run
from costlens.sources.publish import published
from costlens.sources.tables import read_fact, read_prices


def test_export_prices_and_charts_jobs(spark, tmp_path):
    root = tmp_path / "tree"
    put(root, "runs/2026-04-01/r1/manifest.json", manifest(4, "g4dn.xlarge", "ami-a", 1))
    put(root, "runs/2026-04-01/r1/output/md_benchmark.out", MD_1_1)
    put(root, "runs/2026-04-01/r1/output/rbfe_benchmark.out", RBFE_1_2)
    put(root, "runs/2026-04-02/r2/manifest.json", manifest(4, "g5.xlarge", "ami-a", 2))
    put(root, "runs/2026-04-02/r2/output/md_benchmark.out", FULL_MD)
    put(root, "runs/2026-04-02/r2/output/rbfe_benchmark.out", RBFE_1_2)
    md, rbfe = str(tmp_path / "md"), str(tmp_path / "rbfe")
    run(["export", "--root", str(root), "--md-out", md, "--rbfe-out", rbfe], spark)
    assert read_fact(spark, md).count() == 13 and read_fact(spark, rbfe).count() == 28

    (tmp_path / "docs.jsonl").write_text("\n".join(DOCS) + "\n")
    run(
        ["prices", "--docs", str(tmp_path / "docs.jsonl"), "--types", "a.large,b.large,zz.large",
         "--out", str(tmp_path / "prices"), "--month", "2026-04"],
        spark,
    )
    snap = {r.instance_type: r.price_per_hour for r in read_prices(spark, str(tmp_path / "prices/2026-04-pricing.json")).collect()}
    assert snap == {"a.large": 0.5, "b.large": 0.7, "zz.large": None}

    prices = tmp_path / "p.json"
    prices.write_text(json.dumps([{"instance_type": "g4dn.xlarge", "price_per_hour": 0.526},
                                  {"instance_type": "g5.xlarge", "price_per_hour": 1.006}]))
    meta = tmp_path / "meta.json"
    meta.write_text(json.dumps({s: {"atoms": {"complex": 1000 + i, "solvent": 1}} for i, s in enumerate(
        ["bace", "p38", "jnk1", "cdk2", "ptp1b", "tyk2", "mcl1", "thrombin"])}, indent=2))
    out = str(tmp_path / "charts")
    run(["charts", "--md-fact", md, "--rbfe-fact", rbfe, "--prices", str(prices),
         "--metadata", str(meta), "--out", out, "--md-mps", "2"], spark)
    cmp_rows = spark.read.parquet(published(spark, f"{out}/md_comparison")).collect()
    assert {r.mps_process_count for r in cmp_rows} == {2}
    assert {r.system for r in spark.read.parquet(published(spark, f"{out}/rbfe_scaling")).collect()} == {"bace"}
    edge = spark.read.parquet(published(spark, f"{out}/rbfe_edge_cost")).collect()
    assert sum(r.is_winner for r in edge) == len({r.system for r in edge})
