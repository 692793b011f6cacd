import numpy as np
import pytest

from costlens.llm.components import components
from costlens.llm.vector_graph import audit_recall, greedy_search, linked, pruned_graph

SCHEMA = "vec_id long, embedding array<float>, unit string, weight int, node int"


def brute(vectors):
    ids = [i for i, _ in vectors]
    good = []
    for _, v in vectors:
        x = np.array([np.nan if c is None else c for c in v] if v else [0.0], float)
        good.append(x / np.linalg.norm(x) if np.isfinite(x).all() and np.abs(x).max() > 0 else None)
    n = len(ids)
    link = np.zeros((n, n), bool)
    for i in range(n):
        for j in range(n):
            if i != j and good[i] is not None and good[j] is not None and len(good[i]) == len(good[j]):
                link[i, j] = good[i] @ good[j] >= 0.9
    parent = list(range(n))
    for _ in range(n):
        new = [min([parent[i], *(parent[j] for j in np.flatnonzero(link[i]))]) for i in range(n)]
        if new == parent:
            break
        parent = new
    return {ids[i]: (int(link[i].sum()), min(ids[k] for k in range(n) if parent[k] == parent[i])) for i in range(n)}


def test_graph_search_finds_the_range():
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(30, 32))
    x = np.repeat(centres, 20, 0) + 0.1 * rng.normal(size=(600, 32))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    lists = [row[row >= 0] for row in pruned_graph(x)]
    assert max(map(len, lists)) <= 24
    back = [[] for _ in x]
    for i, to in enumerate(lists):
        for j in to:
            back[j].append(i)
    lists = [np.r_[to, np.array(b, int)] for to, b in zip(lists, back)]
    found = sum(len(greedy_search(x, lists, 0, x[i], i, 0.9)) for i in range(600))
    true = int((x @ x.T >= 0.9).sum()) - 600
    assert found >= 0.9 * true > 0


def test_links_and_components(spark):
    rng = np.random.default_rng(2)
    rows = [(i, rng.normal(size=16).astype(np.float32).tolist()) for i in range(200)]
    base = np.array(rows[3][1])
    rows += [(300 + i, (base * (1 + i) + 0.02 * rng.normal(size=16)).astype(np.float32).tolist()) for i in range(40)]
    rows += [(400 + i, rows[5][1]) for i in range(30)]  # exact copies
    rows += [(500, None), (501, [0.0] * 16), (502, [float("nan")] * 16), (503, [1.0, None] * 8), (504, []), (505, [1.0, 0.0]), (506, [2.0, 0.1]), (507, [float("inf")] * 16)]
    rows.append((508, [1e30] * 16))
    docs = spark.createDataFrame([(i, v, "u", 1, 2) for i, v in rows], SCHEMA).repartition(3)
    nodes, units = linked(docs, shard_rows=48)
    got = {r.id: (r.n_links, r.component_id) for r in nodes.collect()}
    want = brute(rows)
    assert set(got) == set(want) and len(got) == len(rows)
    assert sum(n for n, _ in got.values()) >= 0.95 * sum(n for n, _ in want.values())
    assert all(got[i][0] <= want[i][0] for i in want)
    assert sum(got[i][1] == want[i][1] for i in want) >= 0.98 * len(want)
    assert [got[i] for i in (500, 501, 502, 503, 504, 507)] == [(0, i) for i in (500, 501, 502, 503, 504, 507)]
    audit = audit_recall(units, nodes, queries=1000).first()
    assert audit.recall >= 0.9


def test_repeated_rows_and_empty_table(spark):
    rows = [(1, [1.0, 0.0], "u", 1, 2), (1, [1.0, 0.0], "u", 1, 2), (2, [0.0, 1.0], "u", 1, 2), (None, [0.0, 1.0], "u", 1, 2)]
    nodes, _ = linked(spark.createDataFrame(rows, SCHEMA))
    assert sorted((str(r.id), r.n_links, r.component_id) for r in nodes.collect()) == [("1", 1, 1), ("1", 1, 1), ("2", 1, 2), ("None", 1, 2)]
    nodes, units = linked(spark.createDataFrame([], SCHEMA))
    assert nodes.count() == 0 and audit_recall(units, nodes).first().recall == 1.0


def test_components_of_a_long_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(60)] + [(100, k) for k in range(101, 130)] + [(130, 129), (7, 7)]
    got = {r.id: r.component for r in components(spark.createDataFrame(path[::-1], "a long, b long")).collect()}
    assert got == {**{i: 0 for i in range(61)}, **{i: 100 for i in range(100, 131)}}


def test_large_groups_over_several_parts(spark):
    """Groups of a few hundred different near vectors, in shards of several parts of the default size."""
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(8, 64))
    x = np.repeat(centres / np.linalg.norm(centres, axis=1, keepdims=True), 400, 0) + 0.3 / 8 * rng.normal(size=(3200, 64))
    x = np.r_[x, rng.normal(size=(1000, 64))]
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    docs = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>").repartition(4)
    got = {r.id: (r.n_links, r.component_id) for r in linked(docs)[0].collect()}
    link = x @ x.T >= 0.9
    true = link.sum(1) - 1
    assert all(got[i][0] <= true[i] for i in got)
    assert sum(n for n, _ in got.values()) >= 0.99 * true.sum() > 0
    assert all(got[i][1] == got[j][1] for i, j in np.argwhere(link).tolist())
