import numpy as np
from pyspark.sql import functions as F

from costlens.llm.topk_search import SegmentIndex, sign_codes, top_k

SCHEMA = "vec_id long, embedding array<float>, code string, rank int"


def brute(ids, codes, query, code, k):
    dist = np.bitwise_count(codes ^ code).sum(1)
    return sorted((int(d), int(i)) for d, i in zip(dist, ids) if i != query)[:k]


def test_index_equals_brute_force_with_ties():
    rng = np.random.default_rng(3)
    codes = rng.integers(0, 2**63, (400, 1), dtype=np.uint64)
    codes[50:90] = codes[0]  # ties at distance 0
    codes[90:120] = codes[1] ^ np.uint64(5)
    ids = rng.permutation(400)
    index = SegmentIndex(ids, codes)
    for q in (0, 1, 55, 399):
        rows, dist = index.search(int(ids[q]), codes[q], 10)
        assert [(int(d), int(index.ids[r])) for r, d in zip(rows, dist)] == brute(ids, codes, ids[q], codes[q], 10)
    assert len(index.search(int(ids[0]), codes[0], 1000)[0]) == 399


def test_two_word_codes():
    rng = np.random.default_rng(4)
    codes = rng.integers(0, 2**63, (300, 2), dtype=np.uint64)
    ids = np.arange(300)
    index = SegmentIndex(ids, codes)
    rows, dist = index.search(7, codes[7], 5)
    assert [(int(d), int(index.ids[r])) for r, d in zip(rows, dist)] == brute(ids, codes, 7, codes[7], 5)


def test_blocks_and_chunks_give_the_whole_answer(spark):
    rng = np.random.default_rng(5)
    vectors = rng.normal(size=(300, 64)).astype(np.float32)
    rows = [(i, v.tolist(), "c", 1) for i, v in enumerate(vectors)]
    rows += [(300, None, "c", 1), (None, vectors[0].tolist(), "c", 1), (301, [1.0], "c", 1)]
    rows += [(302, [None] * 64, "c", 1), (303, [float("nan")] * 64, "c", 1), rows[0]]
    codes = sign_codes(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", 64)
    got = top_k(codes, F.col("id") % 100 == 0, k=4, block_rows=60, chunk_queries=2).collect()
    bits = (vectors > 0).astype(int)
    for q in (0, 100, 200):
        want = sorted((int((bits[q] != bits[i]).sum()), i) for i in range(300) if i != q)[:4]
        assert sorted((r.distance, r.neighbor_id) for r in got if r.query_id == q) == want
        assert sorted(r.rank for r in got if r.query_id == q) == [1, 2, 3, 4]
    assert len(got) == 12


def test_empty_table(spark):
    codes = sign_codes(spark.createDataFrame([], SCHEMA), "vec_id", "embedding", 64)
    assert top_k(codes, F.lit(True)).count() == 0


def test_query_equals_its_sql(spark):
    import duckdb

    from costlens.llm.queries import ORACLE_SQL, QUERIES

    sf = "/root/testdata/sf0.001"
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{sf}/embeddings.parquet')")
    want = con.sql(ORACLE_SQL["op1_topk_search"])
    got = QUERIES["op1_topk_search"](spark, sf).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.fetchall()))
