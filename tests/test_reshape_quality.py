from pyspark.sql import functions as F

from costlens import schemas
from costlens.constants import DEFAULT_SYSTEMS
from costlens.functions.labels import phase_label, strip_suffix
from costlens.operators.quality import duplicate_keys, finite
from costlens.operators.reshape import system_sizes, unpivot, unpivot_suffixed


def test_unpivot_drops_null_cells(spark):
    df = spark.createDataFrame([(1, 1.0, None), (2, None, None)], "id int, a double, b double")
    out = unpivot(df, ["id"], ["a", "b"], "k", "v").collect()
    assert [(r.id, r.k, r.v) for r in out] == [(1, "a", 1.0)]


def test_unpivot_row_count_equals_non_null_cells(spark):
    rows = [(i, None if i % 3 == 0 else float(i), None if i % 2 else 1.0) for i in range(50)]
    df = spark.createDataFrame(rows, "id int, a double, b double")
    cells = sum((a is not None) + (b is not None) for _, a, b in rows)
    assert unpivot(df, ["id"], ["a", "b"], "k", "v").count() == cells


def test_suffix_labels_follow_like_semantics(spark):
    df = spark.createDataFrame(
        [("bace_complex",), ("xcomplex",), ("complex",), ("p38_solvent",), ("a_b_complex",)], "n string"
    )
    out = df.select(
        "n", strip_suffix(F.col("n"), ("complex", "solvent")).alias("s"),
        phase_label(F.col("n"), ("complex", "solvent")).alias("p"),
    ).collect()
    got = {r.n: (r.s, r.p) for r in out}
    assert got == {
        "bace_complex": ("bace", "complex"),
        "xcomplex": ("xcomplex", "complex"),  # '_' is a single-character wildcard
        "complex": ("complex", None),
        "p38_solvent": ("p38", "solvent"),
        "a_b_complex": ("a_b", "complex"),
    }


def test_unpivot_suffixed(spark):
    df = spark.createDataFrame([(1, 1.0, None, 3.0)], "id int, a_complex double, a_solvent double, b_complex double")
    out = unpivot_suffixed(df, ["id"], ["a_complex", "a_solvent", "b_complex"], ("complex", "solvent"), "name", "phase", "v")
    assert sorted((r.name, r.phase, r.v) for r in out.collect()) == [("a", "complex", 1.0), ("b", "complex", 3.0)]


def test_finite_filter(spark):
    vals = [1.0, 0.0, -2.5, None, float("nan"), float("inf"), float("-inf")]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    kept = sorted(r.x for r in finite(df, "x").collect())
    assert kept == [-2.5, 0.0, 1.0]


def test_duplicate_keys(spark):
    df = spark.createDataFrame([("a",), ("a",), ("b",)], "k string")
    assert [(r.k, r.rows) for r in duplicate_keys(df, ["k"]).collect()] == [("a", 2)]


def _system(complex_atoms, solvent=True):
    atoms = {"complex": complex_atoms, "solvent": 1000} if solvent else {"complex": complex_atoms}
    return {"edge": "e.json", "protein": "p.pdb", "atoms": atoms, "waters": {"complex": 1, "solvent": 2}}


def test_system_sizes_from_metadata_document(spark, tmp_path):
    import json

    # FIXED VALUES: complex-phase atom counts of the eight benchmark systems.
    atoms = {
        "bace": 49052, "p38": 44939, "jnk1": 42814, "cdk2": 67005,
        "ptp1b": 35081, "tyk2": 34079, "mcl1": 14207, "thrombin": 26512,
    }
    doc = {s: _system(a, solvent=(s != "mcl1")) for s, a in atoms.items()}
    path = tmp_path / "meta.json"
    path.write_text(json.dumps(doc, indent=4))
    from costlens.sources.tables import read_system_metadata

    meta = read_system_metadata(spark, str(path))
    out = {r.system: r.total_system_size for r in system_sizes(meta).collect()}
    assert out == atoms
    assert set(out) == set(DEFAULT_SYSTEMS)


def test_system_sizes_schema_is_explicit(spark):
    assert schemas.system_metadata(("a",)).fieldNames() == ["a"]
    assert schemas.system_metadata(("a",))["a"].dataType == schemas.SYSTEM_ENTRY
