"""Exact top-k search of binary codes by incremental multi-index hashing.

A code's bits are cut into 16-bit segments. Two codes that differ in d bits
have a segment that differs in at most d / segments bits, so a search looks up
the query's segments with 0, 1, 2, ... flipped bits, one segment after the
other. When segments 0..j have been searched to radius r and the others to
r - 1, every code not yet seen is at least ``(j + 1) (r + 1) + (segments - j - 1) r``
bits away; the search ends when the k-th verified distance lies below that.

The codes are dealt by a hash into blocks of about ``block_rows``, the queries
into chunks. Each task indexes one block and searches it for one chunk, so a
task's memory is bounded; each query then keeps the best k of its blocks' k.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from itertools import combinations

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from costlens.llm.common import group_count, shared_copy

SEGMENT = 16


@lru_cache(maxsize=None)
def flips(radius: int) -> np.ndarray:
    """All 16-bit masks with ``radius`` bits set."""
    return np.array([sum(1 << b for b in bits) for bits in combinations(range(SEGMENT), radius)], np.int64)


class SegmentIndex:
    """The codes of a block, found by the value of each 16-bit segment."""

    def __init__(self, ids: np.ndarray, codes: np.ndarray):
        order = np.argsort(ids, kind="stable")
        self.ids, self.codes = ids[order], codes[order]
        self.segments = self.codes.view(np.uint16).reshape(len(codes), -1)
        self.rows, self.starts = [], []
        for s in range(self.segments.shape[1]):
            by = np.argsort(self.segments[:, s], kind="stable")
            self.rows.append(by)
            self.starts.append(np.searchsorted(self.segments[by, s], np.arange(2**SEGMENT + 1)))

    def search(self, query_id: int, code: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """(rows, distances) of the k nearest other codes; ties go to the smaller id."""
        n, parts = self.segments.shape
        seen = np.zeros(n, bool)
        rows, dist = np.empty(0, np.int64), np.empty(0, np.int64)
        for radius in range(SEGMENT + 1):
            for s, value in enumerate(code.view(np.uint16).tolist()):
                values = value ^ flips(radius)
                lo, hi = self.starts[s][values], self.starts[s][values + 1]
                hit = hi > lo
                lo, width = lo[hit], (hi - lo)[hit]
                ends = np.cumsum(width)
                at = np.arange(ends[-1] if len(ends) else 0) + np.repeat(lo - (ends - width), width)
                new = self.rows[s][at]
                new = new[~seen[new]]
                seen[new] = True
                new = new[self.ids[new] != query_id]
                rows = np.r_[rows, new]
                dist = np.r_[dist, np.bitwise_count(self.codes[new] ^ code).sum(1, dtype=np.int64)]
                if len(rows) > k:
                    best = np.lexsort((rows, dist))[:k]
                    rows, dist = rows[best], dist[best]
                if len(rows) == k and dist.max() < (s + 1) * (radius + 1) + (parts - s - 1) * radius:
                    return rows, dist
        best = np.lexsort((rows, dist))[:k]
        return rows[best], dist[best]


def sign_codes(vectors: DataFrame, id_column: str, vector_column: str, bits: int) -> DataFrame:
    """(id, code): one bit per component, set where it is above 0.

    Vectors that are null, of another length than ``bits``, or hold null or
    non-finite components have no code and are left out. Repeated rows of one
    id and code are one row.
    """

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, codes = [], []
            for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if i is not None and v is not None and len(v) == bits and None not in v and np.isfinite(v).all():
                    ids.append(i)
                    codes.append(np.packbits(np.array(v) > 0, bitorder="little").tobytes())
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(codes, pa.binary())], ["id", "code"])

    picked = vectors.select(F.col(id_column).cast("long").alias("id"), F.col(vector_column).cast("array<double>").alias("v"))
    return picked.mapInArrow(encode, "id long, code binary").distinct()


def top_k(
    codes: DataFrame, is_query: Column, k: int = 10, block_rows: int = 8192, chunk_queries: int = 1024
) -> DataFrame:
    """(query_id, neighbor_id, distance, rank) of the k nearest other ids of each query.

    ``codes`` holds (id, code) with codes of one length, a multiple of 64 bits.
    Equal distances go to the smaller id. Fewer than k rows come back only if
    there are fewer other ids; an empty table gives no rows.
    """
    spark = codes.sparkSession
    codes = shared_copy(codes, "codes")
    queries = codes.where(is_query)
    blocks = group_count(spark, codes.count(), block_rows)
    chunks = group_count(spark, queries.count(), chunk_queries)

    def search(key: tuple, rows: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple] = []
        if len(rows) and len(asked):
            as_words = lambda c: np.frombuffer(b"".join(c), np.uint64).reshape(len(c), -1)
            index = SegmentIndex(rows["id"].to_numpy(), as_words(rows["code"]))
            for query, code in zip(asked["id"].tolist(), as_words(asked["code"])):
                at, dist = index.search(query, code, k)
                found += zip([query] * len(at), index.ids[at].tolist(), dist.tolist())
        return pd.DataFrame(found, columns=["query_id", "neighbor_id", "distance"])

    every = lambda n: F.explode(F.sequence(F.lit(0), F.lit(n - 1)))
    deal = lambda n: F.pmod(F.xxhash64("id"), F.lit(n)).cast("int")
    dealt = codes.select("id", "code", deal(blocks).alias("block"), every(chunks).alias("chunk"))
    asked = queries.select("id", "code", every(blocks).alias("block"), deal(chunks).alias("chunk"))
    found = (
        dealt.groupBy("block", "chunk")
        .cogroup(asked.groupBy("block", "chunk"))
        .applyInPandas(search, "query_id long, neighbor_id long, distance int")
    )
    best = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
