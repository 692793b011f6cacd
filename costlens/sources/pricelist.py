"""Landed price-list documents.

The live pricing service is not called; its responses are expected to be
landed as files first. Two layouts are read:

* JSON Lines text, one document per line;
* Parquet / a table with ``doc_pos`` and ``doc`` columns.

``doc_pos`` only has to be orderable: document order decides which price is
first. For text it is a struct (file path, split start, row id within the
split), which follows file order and line order exactly without any global
sort or numbering pass.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def read_price_documents_text(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_pos, doc)`` from text files holding one JSON document per line."""
    return spark.read.text(path).select(
        F.struct(
            F.col("_metadata.file_path").alias("file"),
            F.col("_metadata.file_block_start").alias("block"),
            F.monotonically_increasing_id().alias("row"),
        ).alias("doc_pos"),
        F.col("value").alias("doc"),
    )


def read_price_documents(spark: SparkSession, path: str) -> DataFrame:
    """``(doc_pos, doc)`` from Parquet."""
    return spark.read.parquet(path).select(
        F.col("doc_pos").cast("bigint").alias("doc_pos"), F.col("doc").cast("string").alias("doc")
    )
