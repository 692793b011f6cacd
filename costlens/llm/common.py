"""Helpers shared by the operators of this subpackage."""

from __future__ import annotations

import ctypes
import gc
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.session import scratch_dir
from costlens.sources.tables import read_table

__all__ = ["bounded_sample", "fold", "group_count", "read_table", "release", "shared_copy", "slices"]


def fold(doc_id: str | Column, folds: int) -> Column:
    """``crc32(doc_id as text) mod folds``; a null id counts as the empty text."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.pmod(F.crc32(F.coalesce(c.cast("string"), F.lit("")).cast("binary")), F.lit(folds))


def shared_copy(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet below the shared checkpoint folder and read back.

    Cuts the lineage: later reads survive lost executors and see the same rows.
    """
    spark = df.sparkSession
    path = scratch_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def group_count(spark: SparkSession, amount: float, per_group: float) -> int:
    """How many groups hold ``amount`` units at ``per_group`` each (1 at least)."""
    return max(1, math.ceil(amount / per_group))


def bounded_sample(rows: DataFrame, label: str, per_class: int) -> DataFrame:
    """About ``per_class`` rows of each value of ``label``, picked by a hash of doc_id.

    The share to pick follows from the values' counts, which are the only thing
    the driver gets; a value with fewer rows keeps them all. The same rows are
    picked at every run, whatever the partitioning.
    """
    share = F.lit(0.0)
    for value, n in rows.groupBy(label).count().collect():
        share = F.when(F.col(label) == F.lit(value), F.lit(min(1.0, per_class / n))).otherwise(share)
    u = F.pmod(F.xxhash64(F.col("doc_id").cast("string"), F.lit(17)), F.lit(1 << 40)) / float(1 << 40)
    return rows.where(u < share)


def slices(batch: pa.RecordBatch, text_at: int, most_bytes: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """``batch`` in runs of rows whose texts behind the first have ``most_bytes`` together at most.

    What a task makes of a batch (Python strings, its result) is then bounded by
    bytes, not by the number of rows that Spark puts into a batch.
    """
    sizes = pc.fill_null(pc.binary_length(batch.column(text_at)), 0).to_numpy(zero_copy_only=False)
    run = np.cumsum(sizes.astype(np.int64) + 64) // most_bytes
    starts = np.flatnonzero(np.diff(run, prepend=-1))
    for start, end in zip(starts, [*starts[1:], batch.num_rows]):
        yield batch.slice(int(start), int(end - start))


def release() -> None:
    """Give memory that this worker no longer uses back to the system.

    Python workers outlive their tasks; what their allocators keep for later
    would count against the executor while other stages run.
    """
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except AttributeError:  # another C library
        pass
