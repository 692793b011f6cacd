import math
import re

import duckdb
import pytest
from pyspark.sql import functions as F

from costlens.llm import queries
from costlens.llm.source_mix import mix, targets, words

SF = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, source string, size string, weight double, target string"


def shared(sizes, cycle=(5, 2, 1), most=3):
    """The rule as stated: shares by weight, those above the limit stop there, the excess goes round again."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: cycle[i % len(cycle)] for i, s in enumerate(names)}
    target, stopped = dict.fromkeys(names, 0.0), set()
    excess = float(sum(sizes.values()))
    while excess > 1e-9:
        open_ = [s for s in names if s not in stopped]
        whole = sum(weight[s] for s in open_)
        for s in open_:
            target[s] += excess * weight[s] / whole
        excess = 0.0
        for s in open_:
            if target[s] > most * sizes[s]:
                excess += target[s] - most * sizes[s]
                target[s] = float(most * sizes[s])
                stopped.add(s)
    return target


def test_targets_follow_the_stated_rule(spark):
    for sizes in (
        {"a": 10, "b": 1000, "c": 5, None: 70, "": 1},
        {"a": 0, "b": 0}, {"a": 0, "b": 8}, {"é": 3, "z": 30, "Z": 300, "y": 1}, {f"s{i:03}": (i * i * 37) % 1009 for i in range(100)},
    ):
        got = targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
        assert {r.source: r.target for r in got} == pytest.approx(shared(sizes))
    assert targets(spark.createDataFrame([], "source string, source_size long")).collect() == []


def test_words(spark):
    texts = ["", " ", "a", " a\tb\n\nc\x0bd\x0ce\rf ", "é è ü", "\x1c  x", "x" * 100 + " " + "y " * 1000, None, "𝕏 𝕐"]
    got = spark.createDataFrame([(t,) for t in texts], "t string").select(words(F.col("t")).alias("n")).collect()
    assert [r.n for r in got] == [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for t in texts]


def odd_documents():
    rows = [(i, "w " * (i % 13), "big", "x", None, "y") for i in range(300)]
    rows += [(i, "w " * 7, f"s{i % 4}", "x", 2.0, "y") for i in range(300, 340)]
    rows += [(None, None, None, "x", 1.0, "y"), (None, "a b c", None, "x", -1.0, "y"), (5, "", "", "x", 0.0, "y"), (6, "t " * 50_000, "long", "x", 9.0, "y")]
    return rows + [(7, "same text", "big", "x", None, "y")] * 3


def test_every_source_takes_its_target_in_whole_epochs_first(spark):
    docs = spark.createDataFrame(odd_documents(), SCHEMA).repartition(3)
    weights = spark.createDataFrame([(300 + i, (2.0, -1.0, 0.0, None)[i % 4]) for i in range(40)], "doc_id long, weight double")
    got = mix(docs, weights).collect()
    assert len(got) == len(odd_documents())
    by_target = {}
    for r in got:
        assert 0 <= r.taken <= 3 * r.size and r.taken == r.epochs * r.size + r.part
        by_target.setdefault((r.source_size, r.target), []).append(r)
    for (size, target), rows in by_target.items():
        n = sum(r.size for r in rows)
        assert n % max(size, 1) == 0  # sources of one size and target are not told apart here
        assert abs(sum(r.taken for r in rows) - target * (n // size if size else 0)) <= 0.5 * max(1, n // size if size else 1)
        assert len({r.epochs for r in rows}) == 1
    again = mix(docs.repartition(7), weights).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_better_documents_are_taken_more_often(spark):
    rows = [(i, "w " * 10, s, "x", None, "y") for i in range(4000) for s in ("a", "b", "c")]
    weights = spark.range(4000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 2 == 1, 4.0).otherwise(1.0).alias("weight"))
    got = mix(spark.createDataFrame(rows, SCHEMA), weights).collect()
    taken = [sum(r.part for r in got if r.doc_id % 2 == odd) for odd in (0, 1)]
    assert taken[1] > 1.5 * taken[0] > 0


def test_equal_sources_share_by_weight(spark):
    rows = [(i, "w " * 10, s, "x", None, "y") for i in range(80) for s in ("a", "b", "c")]
    got = mix(spark.createDataFrame(rows, SCHEMA)).groupBy("target").agg(F.sum("taken").alias("n")).collect()
    assert sorted((r.target, r.n) for r in got) == [(300.0, 300), (600.0, 600), (1500.0, 1500)]


def test_empty_table(spark):
    assert mix(spark.createDataFrame([], SCHEMA)).collect() == []


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    for t in ("documents", "labels"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    rel = con.sql(queries.OP13_SQL)
    want = [dict(zip(rel.columns, r)) for r in rel.fetchall()]
    got = [r.asDict() for r in queries.op13_source_mix(spark, SF).collect()]
    key = lambda r: (r["doc_id"], r["size"])
    assert sorted(got, key=key) == sorted(want, key=key)
    assert all(math.isfinite(r["target"]) for r in got)
