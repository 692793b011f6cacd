"""Near-duplicate documents by Order MinHash and banded alignment.

A text is the sequence of its shingles (``SHINGLE`` words in a row, words being
what white space separates). Each of ``SAMPLES`` hash functions picks the
``PICKED`` smallest occurrence-labelled shingles, which keep their text order:
the picked sequence is a bucket key, equal with the probability of a shared
content *and* a shared order, so it follows edit similarity.

1. Texts with equal word sequences are one class, kept by its smallest id.
2. Within each bucket, the sketches (the smallest value of every hash function)
   of all members are compared; pairs that agree in at least ``LEAST_EQUAL``
   of them tie their documents. A true pair fails this, or shares no bucket,
   with a probability of about 1 in 10,000 at the threshold itself and much less
   above it.
3. The connected candidates form families. All pairs of a family's texts that
   are not yet connected are verified: an upper bound from the shared
   shingles first, then the longest common subsequence of the two shingle
   sequences in the band that the threshold leaves. The similarity is
   ``2 * common / (n1 + n2)``, an edit similarity on shingles.

Buckets and families leave a task as at most one tie per member. One with very
many members is split into parts, and every pair of parts is a group of its own,
so a group's size is bounded; small ones share a group.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import group_count, shared_copy
from costlens.llm.components import components

SHINGLE = 5
SAMPLES = 16
PICKED = 2
LEAST_EQUAL = 4
LEAST = 0.8

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_BASE = 0xD6E8FEB86659FD93
_SEEDS = (np.arange(1, SAMPLES + 1, dtype=np.uint64) * _A)[:, None]


#: Up to so many matches an item on average, an alignment goes match by match; above, row by row.
MATCHES_AN_ITEM = 16
#: Rows of positions that an alignment by rows keeps.
KEPT_ROWS = 64


def _mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


def _powers(n: int) -> np.ndarray:
    out = np.full(n, np.uint64(_BASE))
    out[:1] = 1
    return np.cumprod(out)


def shingles(text: str) -> np.ndarray:
    """64-bit hashes of the text's shingles; one of all words if they are fewer; none without words."""
    b = np.frombuffer(text.encode("utf-8"), np.uint8)
    word_byte = (b != 32) & ((b < 9) | (b > 13))
    starts = np.flatnonzero(word_byte & ~np.r_[False, word_byte[:-1]])
    if not len(starts):
        return np.empty(0, np.uint64)
    inner = np.flatnonzero(word_byte)
    first = np.searchsorted(inner, starts)
    at = np.arange(len(inner)) - np.repeat(first, np.diff(np.r_[first, len(inner)]))
    words = _mix(np.add.reduceat((b[inner].astype(np.uint64) + np.uint64(1)) * _powers(int(at.max()) + 1)[at], first))
    k = min(SHINGLE, len(words))
    factors = _powers(k) if k == SHINGLE else _powers(k) * np.uint64(k)
    n = len(words) - k + 1
    total = np.zeros(n, np.uint64)
    for j in range(k):
        total += words[j : j + n] * factors[j]
    return _mix(total)


def labelled(h: np.ndarray) -> np.ndarray:
    """The hashes with each repetition's number mixed in, so that equal shingles differ."""
    order = np.argsort(h, kind="stable")
    same = np.r_[False, h[order][1:] == h[order][:-1]]
    if not same.any():
        return h
    run = np.arange(len(h)) - np.maximum.accumulate(np.where(same, 0, np.arange(len(h))))
    again, out = order[run > 0], h.copy()
    out[again] = _mix(h[again] + run[run > 0].astype(np.uint64) * _A)
    return out


def sketch(h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(bucket keys, sketch): per hash function the picked shingles in text order, and the smallest value."""
    marked = labelled(h)
    keys, lows = np.empty(SAMPLES, np.uint64), np.empty(SAMPLES, np.uint16)
    take = min(PICKED, len(marked))
    rows = SAMPLES if len(marked) < 10_000 else 2  # bounds the memory of long texts
    for s in range(0, SAMPLES, rows):
        values = _mix(marked[None] ^ _SEEDS[s : s + rows])
        at = np.argpartition(values, take - 1, axis=1)[:, :take]
        low = np.take_along_axis(values, at, 1).min(1)
        lows[s : s + rows] = (low & np.uint64(0xFFFF)).astype(np.uint16)
        picked = marked[np.sort(at, 1)]
        keys[s : s + rows] = _mix((picked * _powers(take)).sum(1, dtype=np.uint64) ^ _SEEDS[s : s + rows, 0])
    return keys, lows


def _common_by_matches(a: np.ndarray, b: np.ndarray, spare: int) -> int:
    """The longest rising run of matching positions, one match at a time (patience sorting)."""
    order = np.argsort(b, kind="stable")
    low, high = np.searchsorted(b[order], a, "left").tolist(), np.searchsorted(b[order], a, "right").tolist()
    places, ends = order.tolist(), []
    for i, (s, e) in enumerate(zip(low, high)):
        for j in reversed(places[s:e]):  # falling, so that a position of ``a`` is used once
            if abs(i - j) <= spare:
                at = bisect_left(ends, j)
                ends[at : at + 1] = [j]
    return len(ends)


def _common_by_bits(a: np.ndarray, b: np.ndarray, spare: int) -> int:
    """The same where items repeat very often: bits of a whole number hold a row of the alignment.

    An item's positions become a number when it is met; those of the most
    frequent items are kept, so memory is a few dozen rows.
    """
    order = np.argsort(a, kind="stable")
    values, first, times = np.unique(a[order], return_index=True, return_counts=True)
    at = np.minimum(np.searchsorted(values, b), len(values) - 1)
    kept: dict[int, int] = {}
    often = set(np.argsort(-times, kind="stable")[:KEPT_ROWS].tolist())

    def row_of(k: int) -> int:
        found = kept.get(k)
        if found is None:
            bits = np.zeros(len(a), np.uint8)
            bits[order[first[k] : first[k] + times[k]]] = 1
            found = int.from_bytes(np.packbits(bits, bitorder="little").tobytes(), "little")
            if k in often:
                kept[k] = found
        return found

    full, band = (1 << len(a)) - 1, (1 << (2 * spare + 1)) - 1
    row = full
    for j, (k, known) in enumerate(zip(at.tolist(), (values[at] == b).tolist())):
        if known:
            hit = row_of(k) & (band << (j - spare) if j >= spare else band >> (spare - j))
            step = row & hit
            row = ((row + step) | (row & ~hit)) & full
    return len(a) - row.bit_count()


def common_in_band(a: np.ndarray, b: np.ndarray, spare: int) -> int:
    """Length of the longest common subsequence of two sequences, matching only
    positions at most ``spare`` apart (no alignment with at most ``spare``
    unmatched items leaves that band). Memory is in proportion to the length."""
    n = min(len(a), len(b))
    differ = np.flatnonzero(a[:n] != b[:n])
    head = int(differ[0]) if len(differ) else n
    a, b, n = a[head:], b[head:], n - head
    differ = np.flatnonzero(a[len(a) - n :][::-1] != b[len(b) - n :][::-1])
    tail = int(differ[0]) if len(differ) else n
    a, b = a[: len(a) - tail], b[: len(b) - tail]
    if not len(a) or not len(b):
        return head + tail
    values, times = np.unique(a, return_counts=True)
    at = np.minimum(np.searchsorted(values, b), len(values) - 1)
    matches = int(times[at][values[at] == b].sum())
    by = _common_by_matches if matches <= MATCHES_AN_ITEM * (len(a) + len(b)) else _common_by_bits
    return head + tail + by(a, b, spare)


def similar(a: np.ndarray, b: np.ndarray, least: float = LEAST) -> bool:
    total = len(a) + len(b)
    spare = int(total * (1 - least) + 1e-9)
    return abs(len(a) - len(b)) <= spare and 2 * common_in_band(a, b, spare) >= least * total - 1e-9


class Ties:
    """Union-find over the rows of a group."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return i

    def tie(self, i: int, j: int) -> None:
        a, b = self.find(i), self.find(j)
        self.parent[max(a, b)] = min(a, b)

    def pairs(self, ids: np.ndarray) -> list[tuple[int, int]]:
        found = [(i, self.find(i)) for i in range(len(ids))]
        return [(int(ids[i]), int(ids[r])) for i, r in found if i != r]


def tie_sketches(ids: np.ndarray, sketches: np.ndarray) -> list[tuple[int, int]]:
    """Ties between rows whose sketches agree in at least ``LEAST_EQUAL`` values."""
    equal = np.zeros((len(ids), len(ids)), np.uint8)
    for k in range(SAMPLES):
        equal += sketches[:, None, k] == sketches[None, :, k]
    ties = Ties(len(ids))
    alike = equal >= LEAST_EQUAL
    for i in range(len(ids)):
        for j in np.flatnonzero(alike[i, i + 1 :]).tolist():
            ties.tie(i, i + 1 + j)
    return ties.pairs(ids)


def tie_texts(ids: np.ndarray, texts: list[str], least: float = LEAST) -> list[tuple[int, int]]:
    """Ties between texts whose verified similarity is at least ``least``, found through all pairs."""
    seqs = [shingles(t) for t in texts]
    sizes = np.array([len(s) for s in seqs])
    owner = np.repeat(np.arange(len(seqs)), sizes)
    _, code = np.unique(np.concatenate([labelled(s) for s in seqs]), return_inverse=True)
    by_code = np.argsort(code, kind="stable")
    holders = owner[by_code]
    starts = np.searchsorted(code[by_code], np.arange(code.max() + 2))
    ends = np.cumsum(sizes)
    ties = Ties(len(ids))
    for i in range(len(ids) - 1):
        mine = code[ends[i] - sizes[i] : ends[i]]
        lo, width = starts[mine], starts[mine + 1] - starts[mine]
        last = np.cumsum(width)
        at = np.arange(last[-1]) + np.repeat(lo - (last - width), width)
        shared = np.bincount(holders[at], minlength=len(ids))
        able = 2 * shared >= least * (sizes[i] + sizes) - 1e-9
        for j in (np.flatnonzero(able[i + 1 :]) + i + 1).tolist():
            if ties.find(i) != ties.find(j) and similar(seqs[i], seqs[j], least):
                ties.tie(i, j)
    return ties.pairs(ids)


def sketches(docs: DataFrame) -> DataFrame:
    """(id, digest, n, keys, sketch) of each document with words and an id; digest is that of the word sequence."""

    def make(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: tuple[list, ...] = ([], [], [], [], [])
            for i, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                h = shingles(text)
                if len(h):
                    keys, lows = sketch(h)
                    digest = hashlib.blake2b(h.tobytes(), digest_size=16).digest()
                    for column, value in zip(out, (i, digest, len(h), keys.view(np.int64).tolist(), lows.tobytes())):
                        column.append(value)
            types = (pa.int64(), pa.binary(), pa.int64(), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(out, types)], ["id", "digest", "n", "keys", "sketch"])

    picked = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text"))
    return picked.where("id is not null and text is not null").mapInArrow(make, "id long, digest binary, n long, keys array<long>, sketch binary")


def in_bounded_groups(rows: DataFrame, key: str, size: Column | None, group_size: float, groups: int) -> DataFrame:
    """``rows`` with ``lot``, ``p`` and ``q``: what to group by so that all pairs of a key meet.

    A key whose rows weigh more than ``group_size`` (the sum of ``size``, or
    their number) is split by a hash of id into parts, and each row goes to the
    group of every pair of parts with its own. Small keys share ``groups`` lots.
    """
    weight = F.count(F.lit(1)) if size is None else F.sum(size)
    counts = rows.groupBy(key).agg(F.count(F.lit(1)).alias("_rows"), F.ceil(2 * weight / F.lit(group_size)).cast("int").alias("_parts"))
    counts = counts.where("_rows > 1").select(key, F.greatest(F.lit(1), "_parts").alias("_parts")).withColumn(
        "_parts", F.when(F.col("_parts") <= 2, 1).otherwise(F.col("_parts"))
    )
    dealt = rows.join(counts, key).withColumn("_own", F.pmod(F.xxhash64("id"), F.col("_parts")).cast("int"))
    dealt = dealt.withColumn("_other", F.explode(F.sequence(F.lit(0), F.col("_parts") - 1)))
    dealt = dealt.withColumn("p", F.least("_own", "_other")).withColumn("q", F.greatest("_own", "_other"))
    lot = F.pmod(F.xxhash64(key, "p", "q"), F.lit(groups)).cast("int")
    return dealt.withColumn("lot", lot).drop("_parts", "_own", "_other")


def near_duplicates(docs: DataFrame, least: float = LEAST) -> DataFrame:
    """(doc_id, class_id) of every row: the smallest id of the documents linked with it, directly or not.

    Null and empty texts, and texts without words, are classes of their own;
    so are rows without an id (class_id is null). Texts with fewer words than a
    shingle link only with equal ones. Rows that share an id are one document.
    An empty table gives no rows; extra columns are ignored.
    """
    spark = docs.sparkSession
    drawn = shared_copy(sketches(docs), "sketches")
    classes = shared_copy(drawn.groupBy("digest").agg(F.min("id").alias("rep")), "classes")
    reps = drawn.join(classes, "digest").where("id = rep").dropDuplicates(["digest"])
    rows = reps.select("id", "sketch", F.explode("keys").alias("key"))
    n = classes.count()

    def compare(pdf: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        pdf = pdf.sort_values(["key", "p", "q", "id"], ignore_index=True)
        group = pdf[["key", "p", "q"]].to_numpy()
        ids = pdf["id"].to_numpy()
        drawn = np.frombuffer(b"".join(pdf["sketch"]), np.uint16).reshape(-1, SAMPLES)
        edges = np.flatnonzero(np.r_[True, (group[1:] != group[:-1]).any(1), True])
        size = np.diff(edges)
        two = edges[:-1][size == 2]
        alike = two[(drawn[two] == drawn[two + 1]).sum(1) >= LEAST_EQUAL]
        found += zip(ids[alike + 1].tolist(), ids[alike].tolist())
        for s, k in zip(edges[:-1][size > 2].tolist(), size[size > 2].tolist()):
            found += tie_sketches(ids[s : s + k], drawn[s : s + k])
        return pd.DataFrame(sorted(set(found)), columns=["a", "b"], dtype=np.int64)

    lots = group_count(spark, n * SAMPLES, 16_384)
    dealt = in_bounded_groups(rows, "key", None, 2048, lots)
    candidates = dealt.groupBy("lot").applyInPandas(compare, "a long, b long")
    family = shared_copy(components(shared_copy(candidates, "candidates")), "families")

    members = reps.join(family, "id").select("id", F.col("component").alias("family"), "n")
    texts = docs.select(F.col("doc_id").cast("long").alias("id"), F.col("text").cast("string").alias("text")).where("text is not null")
    held = shared_copy(texts.join(members, "id").dropDuplicates(["id", "text"]), "texts")  # all texts of an id

    def verify(pdf: pd.DataFrame) -> pd.DataFrame:
        found: list[tuple[int, int]] = []
        for _, group in pdf.sort_values("id").groupby(["family", "p", "q"]):
            found += tie_texts(group["id"].to_numpy(), group["text"].tolist(), least)
        return pd.DataFrame(sorted(set(found)), columns=["a", "b"], dtype=np.int64)

    total = held.agg(F.sum("n")).first()[0] or 0
    dealt = in_bounded_groups(held, "family", F.col("n"), 2_000_000, group_count(spark, total, 500_000))
    links = shared_copy(dealt.groupBy("lot").applyInPandas(verify, "a long, b long"), "links")
    # Texts that share an id are one document.
    own = drawn.where("id is not null").join(classes, "digest").select("id", "rep").distinct()
    ties = own.join(own.groupBy("id").agg(F.min("rep").alias("b")), "id").where("rep <> b").select(F.col("rep").alias("a"), "b")
    joined = classes.join(components(links.unionByName(ties)).withColumnRenamed("id", "rep"), "rep", "left").select("digest", F.coalesce("component", "rep").alias("class"))
    by_id = drawn.join(joined, "digest").groupBy("id").agg(F.min("class").alias("class_id"))
    ids = docs.select(F.col("doc_id").cast("long").alias("id"))
    return ids.join(by_id, "id", "left").select(F.col("id").alias("doc_id"), F.coalesce("class_id", "id").alias("class_id"))
