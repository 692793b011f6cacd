"""Best-fit packing by the sum-of-squares rule.

Documents become token sequences (byte-level BPE ids plus an end id), long ones
are cut into pieces of the sequence length (the first piece takes the odd
rest), and the pieces are placed into sequences: each goes where the sum of
the squared counts of open sequences per residual gap becomes smallest. Longer
pieces go first, and a new sequence is opened only for a piece that fits into
no open one; both make fewer sequences.

Pieces of the full length are sequences of their own. The others are dealt by
a hash into shards of about ``shard_pieces``; each shard is packed by one task
whose state is one counter and one stack of open sequences per level. The
pieces of sequences that stayed open are dealt again into fewer, equally large
shards, round after round, so that only the last shard leaves open sequences.
A round is the last one if less than half of its pieces could be placed in
full sequences.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from costlens.llm.common import group_count, shared_copy
from costlens.llm.byte_bpe import ByteBpe

PIECES = "row_id long, doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(n_tokens: int, capacity: int) -> list[tuple[int, int]]:
    """(start, length) of a document's pieces; only the first may be shorter."""
    first = n_tokens % capacity or capacity
    starts = [0, *range(first, n_tokens, capacity)]
    return [(s, e - s) for s, e in zip(starts, [*starts[1:], n_tokens])]


def sum_of_squares(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Place ``lengths`` in order; returns the bin, the offset of each, and the bins' fills.

    A new bin is opened only for a length that fits into no open one.
    """
    count = np.zeros(capacity + 1, np.int64)
    open_bins: list[list[int]] = [[] for _ in range(capacity + 1)]
    bins, offsets, fills = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64), []
    for i, s in enumerate(lengths.tolist()):
        fits = np.flatnonzero(count[1 : capacity + 1 - s]) + 1
        if len(fits):
            # Change of the sum when a bin of level h grows to level h + s; a
            # bin that becomes full is no longer open.
            change = 2 * (count[fits + s] - count[fits]) + 2 - (fits + s == capacity)
            h = int(fits[::-1][np.argmin(change[::-1])])  # ties: the fullest bin
            b = open_bins[h].pop()
            count[h] -= 1
        else:
            h, b = 0, len(fills)
            fills.append(0)
        bins[i], offsets[i] = b, h
        fills[b] = h + s
        if h + s < capacity:
            open_bins[h + s].append(b)
            count[h + s] += 1
    return bins, offsets, np.array(fills, np.int64)


def token_pieces(docs: DataFrame, tokenizer: str, capacity: int, end_id: int) -> DataFrame:
    """One row per piece of every document: row_id, doc_id, piece, start, length, ids_crc32."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = ByteBpe(tokenizer)
        end = np.array(end_id, "<u4").tobytes()
        for batch in batches:
            out: list[tuple] = []
            texts = [text or "" for text in batch.column(1).to_pylist()]
            for doc_id, ids in zip(batch.column(0).to_pylist(), bpe.encode_many(texts)):
                ids += end
                for k, (start, length) in enumerate(cut(len(ids) // 4, capacity)):
                    out.append((doc_id, k, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
            cols = list(zip(*out)) if out else [[]] * 5
            types = [pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            names = ["doc_id", "piece", "start", "length", "ids_crc32"]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, types)], names)

    schema = PIECES.removeprefix("row_id long, ")
    found = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(pieces, schema)
    return found.select(F.monotonically_increasing_id().alias("row_id"), *found.columns)


def pack(pieces: DataFrame, capacity: int = 1024, shard_pieces: int = 2048) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with ``row_id`` (unique) and ``length``."""

    def pack_shard(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["length", "row_id"], ascending=[False, True])
        bins, offsets, fills = sum_of_squares(pdf["length"].to_numpy(), capacity)
        ids = pdf["row_id"].to_numpy()
        first = ids[np.unique(bins, return_index=True)[1]]
        return pd.DataFrame(
            {"row_id": ids, "length": pdf["length"].to_numpy(), "bin": first[bins], "offset": offsets, "fill": fills[bins]}
        )

    spark = pieces.sparkSession
    placed = [
        pieces.where(F.col("length") >= capacity).select("row_id", (2 * F.col("row_id") + 1).alias("sequence_id"), F.lit(0).cast("long").alias("offset"))
    ]
    todo = pieces.where(F.col("length") < capacity).select("row_id", "length")
    n, turn = todo.count(), 0
    while n:
        shards = group_count(spark, n, shard_pieces)
        dealt = todo.withColumn("shard", F.pmod(F.xxhash64("row_id", F.lit(turn)), F.lit(shards)))
        packed = dealt.repartition(min(shards, 100_000), "shard").groupBy("shard").applyInPandas(
            pack_shard, "row_id long, length long, bin long, offset long, fill long"
        )
        packed = shared_copy(packed, f"packing-{turn}")
        rest = packed.where(F.col("fill") < capacity)
        left = rest.count() if shards > 1 else n
        last = shards == 1 or left > n // 2
        done = packed if last else packed.where(F.col("fill") >= capacity)
        placed.append(done.select("row_id", (2 * F.col("bin")).alias("sequence_id"), "offset"))
        todo, n, turn = rest.select("row_id", "length"), 0 if last else left, turn + 1
    where = placed[0]
    for p in placed[1:]:
        where = where.unionByName(p)
    return pieces.join(where, "row_id")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = 1024, end_id: int = 2, shard_pieces: int = 2048
) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Null text counts as empty, so such a document is one piece that holds only
    the end id. Rows that repeat a doc_id, or have none, are packed as
    documents of their own. An empty table gives no rows. Extra columns are
    ignored. ``tokenizer`` is the path of a byte-level BPE file, with its rank
    file beside it.
    """
    pieces = shared_copy(token_pieces(docs, tokenizer, capacity, end_id), "pieces")
    return pack(pieces, capacity, shard_pieces).drop("row_id")
