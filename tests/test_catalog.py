"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry_mod
from costlens.plans import catalog

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else v
    if hasattr(v, "isoformat"):
        return v.isoformat()
    return v


def table(records, cols):
    rows = [tuple(norm(r[c]) for c in cols) for r in records]
    return sorted(rows, key=lambda t: tuple((x is None, str(type(x)), str(x)) for x in t))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield con
    con.close()


def test_every_query_has_an_oracle():
    # The training-data queries, if present, are tested with their operators.
    assert set(catalog.QUERIES) == set(catalog.ORACLE_SQL)
    assert set(catalog.QUERIES) <= set(entry_mod.queries())
    assert set(entry_mod.oracle_sql()) <= set(entry_mod.queries())


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_query_matches_oracle(spark, duck, name):
    sdf = catalog.QUERIES[name](spark, SF)
    s_rec = [r.asDict() for r in sdf.collect()]
    rel = duck.sql(catalog.ORACLE_SQL[name])
    d_rec = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    assert sorted(sdf.columns) == sorted(rel.columns)
    cols = sorted(sdf.columns)
    assert len(s_rec) == len(d_rec)
    assert table(s_rec, cols) == table(d_rec, cols)


def test_entry_smoke(spark):
    df = entry_mod.entry(spark)
    assert df.columns == [
        "mps_process_count", "instance_type", "ns_per_day", "ns_per_dollar", "system",
        "total_system_size", "is_throughput_winner", "is_cost_winner",
    ]
    assert df.count() > 0


FORBIDDEN_NODES = (
    "BatchEvalPython",  # row-at-a-time Python UDF
    "ArrowEvalPython",  # pandas UDF
    "MapInPandas",
    "FlatMapGroupsInPandas",
    "CartesianProduct",  # cross join
    "BroadcastNestedLoopJoin",  # non-equi / cross join
)


@pytest.mark.parametrize("name", sorted(catalog.QUERIES))
def test_plans_stay_in_the_jvm_without_cross_joins(spark, name):
    plan = catalog.QUERIES[name](spark, SF)._jdf.queryExecution().executedPlan().toString()
    for node in FORBIDDEN_NODES:
        assert node not in plan, f"{name}: {node}"


def test_every_query_names_the_operators_it_covers():
    from costlens.plans.catalog import COVERS

    assert set(COVERS) == set(catalog.QUERIES)
    assert all(COVERS.values())
