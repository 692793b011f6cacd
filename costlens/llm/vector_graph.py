"""Near-duplicate embeddings through a flat, robust-pruned neighbour graph.

1. Vectors are normalised in double precision and equal ones become one node
   with a weight, so groups of exact copies cost one row.
2. Centres are fitted on a bounded sample; every node joins its two nearest
   shards, so shards overlap. A shard with more than ``shard_rows`` nodes is
   split by a hash into parts of about that size.
3. Each part builds its graph: the nearest neighbours of a node, pruned so that
   a neighbour is dropped if a kept one is much nearer to it than the node
   (robust pruning). A group of many near vectors may list only itself, so the
   part is also cut into regions (a sub-cluster within one connected piece of
   the graph), each with a hub: a node lists its region's hub, and a hub its
   nearest hubs and those that connect all pieces. A node's lists from its parts
   are united.
4. Every node is a query against all parts of its two shards: a greedy search
   starts at the best of all hubs of the part (and at the node itself, where it
   is a member), follows the united lists with a beam, and then expands from
   every node found within the range until no new one appears.
5. What is found is verified by the cosine itself. The links between nodes that
   share both shards are counted in each, and the shard that found more counts.
   Links leave a task only as counts and as one pair per node of its part's
   linked groups.

``audit_recall`` compares with brute force on a bounded sample of queries.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import group_count, shared_copy
from costlens.llm.components import components

DEGREE = 24
POOL = 64
ALPHA = 1.2
BEAM = 12
#: Members of a part per sub-cluster, and the nearest hubs that a hub lists.
REGION = 48
HUB_DEGREE = 8


def unit_vectors(vectors: DataFrame, id_column: str, vector_column: str) -> DataFrame:
    """(id, key, unit): ``unit`` is the normalised vector as packed doubles, or null.

    Null where the vector is null, empty, zero, or holds null or non-finite
    components: such a vector links with nothing. ``key`` is the vector itself
    in bytes.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            units = []
            for v in batch.column(1).to_pylist():
                x = np.array(v, float) if v and None not in v else np.zeros(1)
                size = np.abs(x).max()
                if np.isfinite(size) and size > 0:
                    x = x / size
                    units.append((x / np.sqrt(x @ x)).tobytes())
                else:
                    units.append(None)
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(units, pa.binary())], ["id", "unit"])

    picked = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    return picked.mapInArrow(pack, "id long, unit binary")


def matrix(column: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(column), float).reshape(len(column), -1)


def fit_centres(sample: np.ndarray, k: int, turns: int = 8) -> np.ndarray:
    """Spherical k-means; starts from evenly spaced rows of the sample."""
    centres = sample[np.linspace(0, len(sample) - 1, k).astype(int)].copy()
    for _ in range(turns):
        at = np.argmax(sample @ centres.T, 1)
        sums = np.zeros_like(centres)
        np.add.at(sums, at, sample)
        size = np.linalg.norm(sums, axis=1, keepdims=True)
        centres = np.where(size > 0, sums / np.maximum(size, 1e-12), centres)
    return centres


def pruned_graph(x: np.ndarray, degree: int = DEGREE, pool: int = POOL, alpha: float = ALPHA, rows: int = 512) -> np.ndarray:
    """Neighbour lists (n, degree) by robust pruning of each node's nearest ``pool``; -1 fills up."""
    n = len(x)
    out = np.full((n, degree), -1, np.int32)
    pool = min(pool, n - 1)
    if pool < 1:
        return out
    for s in range(0, n, rows):
        sims = x[s : s + rows] @ x.T
        sims[np.arange(len(sims)), np.arange(s, s + len(sims))] = -np.inf
        near = np.argpartition(-sims, pool - 1, 1)[:, :pool]
        order = np.argsort(-np.take_along_axis(sims, near, 1), 1, kind="stable")
        near = np.take_along_axis(near, order, 1)
        to = 2 - 2 * np.take_along_axis(sims, near, 1)  # squared distances, ascending
        between = 2 - 2 * np.einsum("npd,nqd->npq", x[near], x[near], optimize=True)
        alive = np.ones(near.shape, bool)
        filled = np.zeros(len(near), int)
        for p in range(pool):
            keep = alive[:, p] & (filled < degree)
            at = np.flatnonzero(keep)
            out[s + at, filled[at]] = near[at, p]
            filled[at] += 1
            # A kept neighbour covers those that are much nearer to it than to the node.
            alive[at] &= ~(alpha * between[at, p] <= to[at])
    return out


def pieces(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest member of each item's connected piece, under the edges (a, b)."""
    label = np.arange(n)
    while True:
        new, low = label.copy(), np.minimum(label[a], label[b])
        np.minimum.at(new, label[a], low)
        np.minimum.at(new, label[b], low)
        while (new[new] != new).any():
            new = new[new]
        if (new == label).all():
            return label
        label = new


def hubs_of(x: np.ndarray, graph: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hubs, a, b): a hub for every region of the part, and the edges that make the graph one piece.

    A region is what a sub-cluster and a connected piece of ``graph`` share.
    """
    n = len(x)
    a, _ = np.nonzero(graph >= 0)
    piece = pieces(n, a, graph[graph >= 0])
    centres = fit_centres(x, -(-n // REGION))
    sims = x @ centres.T
    at = sims.argmax(1)
    _, region = np.unique(np.c_[piece, at], axis=0, return_inverse=True)
    region = region.ravel()
    order = np.lexsort((-sims[np.arange(n), at], region))
    hubs = order[np.r_[True, region[order][1:] != region[order][:-1]]]
    near = pruned_graph(x[hubs], HUB_DEGREE)
    froms, _ = np.nonzero(near >= 0)
    edges = [np.c_[np.arange(n), hubs[region]], np.c_[hubs[froms], hubs[near[near >= 0]]]]
    between = x[hubs] @ x[hubs].T
    while True:
        every = np.concatenate([np.c_[a, graph[graph >= 0]], *edges])
        whole = pieces(n, every[:, 0], every[:, 1])[hubs]
        if (whole == whole[0]).all():
            break
        # Each piece gets an edge to the nearest hub outside.
        out = np.where(whole[:, None] == whole, -np.inf, between)
        to, best = out.argmax(1), out.max(1)
        order = np.lexsort((-best, whole))
        first = order[np.r_[True, whole[order][1:] != whole[order][:-1]]]
        edges.append(np.c_[hubs[first], hubs[to[first]]])
    a, b = np.concatenate(edges).T
    return hubs, a[a != b], b[a != b]


def greedy_search(x: np.ndarray, lists: list[np.ndarray], starts: int | np.ndarray, query: np.ndarray, own: int, least: float, beam: int = BEAM) -> np.ndarray:
    """Members of ``x`` with a cosine of at least ``least`` that the search reaches (``own`` excluded)."""
    seen = np.zeros(len(x), bool)
    seen[starts] = True
    if own >= 0:
        seen[own] = True
    best = np.flatnonzero(seen)
    sims = x[best] @ query
    expanded = np.zeros(len(x), bool)
    while True:
        kept = np.argsort(-sims, kind="stable")
        kept = kept[: max(beam, int((sims >= least).sum()))]
        best, sims = best[kept], sims[kept]
        todo = best[~expanded[best]]
        # The best of the beam, and everything in range, is expanded.
        if not len(todo):
            break
        expanded[todo] = True
        new = np.unique(np.concatenate([lists[i] for i in todo]))
        new = new[~seen[new]]
        seen[new] = True
        best, sims = np.r_[best, new], np.r_[sims, x[new] @ query]
    found = best[sims >= least]
    return found[found != own]


def _roots(n: int, pairs: list[tuple[int, np.ndarray]]) -> np.ndarray:
    """Union-find over ``n`` items: the root of each after joining every (i, js)."""
    parent = list(range(n))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    for i, js in pairs:
        for j in js.tolist():
            a, b = find(i), find(j)
            if a != b:
                parent[max(a, b)] = min(a, b)
    return np.array([find(i) for i in range(n)])


def linked(
    vectors: DataFrame,
    id_column: str = "vec_id",
    vector_column: str = "embedding",
    least: float = 0.9,
    shard_rows: int = 2048,
    sample_rows: int = 8192,
    max_shards: int = 1024,
) -> tuple[DataFrame, DataFrame]:
    """(nodes, memberships): per vector row its links and component; the graph's index.

    ``nodes`` is (id, n_links, component_id): links to other rows with a cosine
    of at least ``least``, and the smallest id reachable over links. Rows that
    repeat an id are rows of their own in the counts. Vectors of different
    lengths link with nothing of another length. An empty table gives no rows.
    """
    spark = vectors.sparkSession
    units = shared_copy(unit_vectors(vectors, id_column, vector_column), "units")
    groups = units.where("unit is not null").groupBy("unit").agg(F.min("id").alias("node"), F.count(F.lit(1)).alias("weight"))
    groups = shared_copy(groups.where("node is not null"), "nodes")
    n = groups.count()
    shards = min(max_shards, group_count(spark, n, shard_rows))
    if n:
        u = F.pmod(F.xxhash64("node", F.lit(7)), F.lit(1 << 40)) / float(1 << 40)
        picked = [bytes(r.unit) for r in groups.where(u < sample_rows / n).select("unit", "node").orderBy("node").limit(2 * sample_rows).collect()]
    else:
        picked = []
    by_length: dict[int, np.ndarray] = {}
    for size in sorted({len(p) for p in picked}):
        sample = np.array([np.frombuffer(p, float) for p in picked if len(p) == size])
        by_length[size] = fit_centres(sample, min(shards, len(sample)))

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            first, second = [], []
            for unit in batch.column(0).to_pylist():
                centres = by_length.get(len(unit))
                if centres is None:
                    a = b = 0
                else:
                    sims = centres @ np.frombuffer(unit, float)
                    a = int(sims.argmax())
                    sims[a] = -np.inf
                    b = int(sims.argmax()) if len(sims) > 1 else a
                first.append(min(a, b))
                second.append(max(a, b))
            more = [pa.array(first, pa.int32()), pa.array(second, pa.int32())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *more], ["unit", "node", "weight", "s1", "s2"])

    schema = "unit binary, node long, weight long, s1 int, s2 int"
    homes = groups.mapInArrow(assign, schema).withColumn("dim", F.octet_length("unit"))
    member = homes.withColumn("shard", F.explode(F.array_distinct(F.array("s1", "s2"))))
    sizes = member.groupBy("dim", "shard").agg(F.ceil(F.count(F.lit(1)) / F.lit(shard_rows)).cast("int").alias("parts"))
    member = member.join(sizes, ["dim", "shard"])
    part_of = F.pmod(F.xxhash64("node"), F.col("parts")).cast("int")
    member = shared_copy(member.withColumn("part", part_of), "members")

    def build(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("node", ignore_index=True)
        x, ids = matrix(pdf["unit"]), pdf["node"].to_numpy()
        graph = pruned_graph(x)
        hubs, a, b = hubs_of(x, graph)
        hub = np.zeros(len(ids), bool)
        hub[hubs] = True
        near = [row[row >= 0].tolist() for row in graph]
        for i, j in zip(a.tolist(), b.tolist()):
            near[i].append(j)
        return pd.DataFrame({"node": ids, "near": [ids[row].tolist() for row in near], "hub": hub})

    parts = member.select("dim", "shard", "part", "node", "unit")
    near = parts.groupBy("dim", "shard", "part").applyInPandas(build, "node long, near array<long>, hub boolean")
    # Two lists at most per node, so this groups no more than two lists of ids.
    near = near.groupBy("node").agg(F.array_distinct(F.flatten(F.collect_list("near"))).alias("near"), F.max("hub").alias("hub"))

    index = member.join(near, "node").withColumn("chunk", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    asked = member.select(*(F.col(c).alias("chunk" if c == "part" else c) for c in member.columns))
    asked = asked.withColumn("part", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))

    def search(key: tuple, held: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        shard = int(key[1])
        held = held.sort_values("node", ignore_index=True)
        ids, x = held["node"].to_numpy(), matrix(held["unit"])
        lists = []
        for i, mine in enumerate(held["near"]):
            mine = np.asarray(mine, np.int64)
            at = np.minimum(np.searchsorted(ids, mine), len(ids) - 1)
            lists.append(at[ids[at] == mine])
        # Followed both ways, so that nothing is out of reach by its direction.
        back: list[list[int]] = [[] for _ in ids]
        for i, to in enumerate(lists):
            for j in to.tolist():
                back[j].append(i)
        lists = [np.r_[to, np.array(b, np.int64)] for to, b in zip(lists, back)]
        weight, s1, s2 = held["weight"].to_numpy(), held["s1"].to_numpy(), held["s2"].to_numpy()
        hubs = np.flatnonzero(held["hub"].to_numpy())
        q_ids, q = asked["node"].to_numpy(), matrix(asked["unit"])
        own = np.searchsorted(ids, q_ids)
        own = np.where(ids[np.minimum(own, len(ids) - 1)] == q_ids, own, -1)
        alone, shared, pairs = np.zeros(len(q_ids), np.int64), np.zeros(len(q_ids), np.int64), []
        for i, (a, b) in enumerate(zip(asked["s1"].tolist(), asked["s2"].tolist())):
            found = greedy_search(x, lists, hubs, q[i], int(own[i]), least)
            if len(found):
                pairs.append((i, found + len(q_ids)))
                t1, t2 = s1[found], s2[found]
                both = (a != b) & (t1 == a) & (t2 == b)
                alone[i], shared[i] = weight[found[~both]].sum(), weight[found[both]].sum()
        pairs += [(i, np.array([o + len(q_ids)])) for i, o in enumerate(own.tolist()) if o >= 0]
        names = np.r_[q_ids, ids]
        roots = _roots(len(names), pairs)
        low = pd.Series(names).groupby(roots).transform("min").to_numpy()
        tied = low != names
        links = pd.DataFrame({"node": q_ids, "shard": shard, "alone": alone, "shared": shared, "to": None})
        edges = pd.DataFrame({"node": names[tied], "shard": shard, "alone": 0, "shared": 0, "to": low[tied]}).drop_duplicates()
        return pd.concat([links[alone + shared > 0], edges]).astype({"to": "Int64"})

    by = ("dim", "shard", "part", "chunk")
    found = index.groupBy(*by).cogroup(asked.groupBy(*by)).applyInPandas(search, "node long, shard int, alone long, shared long, to long")
    found = shared_copy(found, "links")
    # Links that both shards of a node hold are found in each, over all its parts: the fuller count stands.
    links = found.groupBy("node", "shard").agg(F.sum("alone").alias("alone"), F.sum("shared").alias("shared"))
    links = links.groupBy("node").agg((F.sum("alone") + F.max("shared")).alias("n"))
    roots = components(found.where("to is not null").select(F.col("node").alias("a"), F.col("to").alias("b")))
    nodes = (
        groups.join(links, "node", "left")
        .join(roots.withColumnRenamed("id", "node"), "node", "left")
        .select("unit", (F.coalesce("n", F.lit(0)) + F.col("weight") - 1).alias("n_links"), F.coalesce("component", "node").alias("component_id"))
    )
    out = units.join(nodes, "unit", "left").select(
        "id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "id").alias("component_id")
    )
    return out, units


def audit_recall(units: DataFrame, nodes: DataFrame, least: float = 0.9, queries: int = 256) -> DataFrame:
    """One row (true_links, found_links, recall) over at most about ``queries`` sampled rows.

    ``units`` is (id, unit); the sampled vectors travel to every task (a bound
    of ``queries`` rows), and each task compares its rows with all of them.
    """
    n = max(1, units.count())
    u = F.pmod(F.xxhash64("id", F.lit(11)), F.lit(1 << 40)) / float(1 << 40)
    sample = units.where((u < queries / n) & F.col("unit").isNotNull() & F.col("id").isNotNull()).dropDuplicates(["id"])
    asked = [(r.id, bytes(r.unit)) for r in sample.orderBy("id").limit(2 * queries).collect()]

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            total = np.zeros(len(asked), np.int64)
            rows = [u for u in batch.column(0).to_pylist() if u is not None]
            for size in {len(u) for u in rows}:
                x = np.frombuffer(b"".join(u for u in rows if len(u) == size), float).reshape(-1, size // 8)
                at = [k for k, (_, u) in enumerate(asked) if len(u) == size]
                if at:
                    q = np.array([np.frombuffer(asked[k][1], float) for k in at])
                    total[at] += (x @ q.T >= least).sum(0)
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in asked], pa.int64()), pa.array(total)], ["id", "n"])

    true = units.select("unit").mapInArrow(compare, "id long, n long").groupBy("id").agg((F.sum("n") - 1).alias("true_links"))
    both = true.join(nodes.select("id", "n_links").dropDuplicates(["id"]), "id")
    return both.agg(F.sum("true_links").alias("true_links"), F.sum("n_links").alias("found_links")).withColumn(
        "recall", F.when(F.coalesce("true_links", F.lit(0)) == 0, F.lit(1.0)).otherwise(F.col("found_links") / F.col("true_links"))
    )
