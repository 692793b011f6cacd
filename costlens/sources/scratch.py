"""Results kept for a second reader, in the shared checkpoint folder."""

from __future__ import annotations

from pyspark.sql import DataFrame

from costlens.session import scratch_dir


def stored(df: DataFrame, label: str) -> DataFrame:
    """``df`` written as Parquet to a fresh shared folder and read back.

    Later readers see the same rows in the same partitions' files, also after
    executors were lost, and nothing below is computed again.
    """
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
