"""Corpus pipeline: filters, near-duplicate removal, repeated passages and packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame; all but the last
return the columns of ``docs``. Models are trained on the labels (stage 1) and
languages (stage 2) of the rows that the stage gets, without the held-out folds.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.llm import langid, toxicity
from costlens.llm.common import fold, read_table, shared_copy
from costlens.llm.minhash_dedup import near_duplicates
from costlens.llm.packing import pack_documents
from costlens.llm.suffix_dedup import remove_repeats

#: Bytes of a batch that goes to a Python worker.
BATCH_BYTES = 4 << 20
TOXIC_SCORE = 0.3
LEAST_LANGUAGE_SCORE = 0.5


def _bounded(stage: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """The stage, with Spark's batches for Python workers cut at ``BATCH_BYTES``.

    The setting stays for the session: what the stage returns is computed later. It
    bounds memory only, not what is computed.
    """

    @wraps(stage)
    def run_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)
        return stage(spark, docs, sf_dir)

    return run_stage


def _kept(docs: DataFrame, judge: Callable[[DataFrame], DataFrame], keep: Column) -> DataFrame:
    """The rows of ``docs`` that ``judge``'s columns pass; no column name of ``docs`` can be in their way.

    Every column, text included, travels once.
    """
    plain = {c: "text" if c == "text" else f"c{k}" for k, c in enumerate(docs.columns)}
    judged = judge(docs.select(*(F.col(f"`{c}`").cast("string").alias(n) if n == "text" else F.col(f"`{c}`").alias(n) for c, n in plain.items())))
    return judged.where(keep).select(*(F.col(n).alias(c) for c, n in plain.items()))


@_bounded
def toxicity_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a toxicity below 0.3 stay; null and empty texts do."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    labels = labels.where(fold("doc_id", 4) != 2)
    model = toxicity.learn(docs.select("doc_id", F.col("text").cast("string").alias("text")), labels)
    return _kept(docs, lambda d: toxicity.score_documents(d, model), F.col("score") < TOXIC_SCORE)


@_bounded
def language_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents in a learnt language stay; texts without letters, or too uncertain, go."""
    model = langid.learn(docs.where(fold("doc_id", 4) != 2).select("doc_id", F.col("text").cast("string").alias("text"), "lang"))
    known = (F.col("lang_pred") != langid.UNKNOWN) & (F.col("score") >= LEAST_LANGUAGE_SCORE)
    return _kept(docs, lambda d: langid.classify(d, model), known)


@_bounded
def near_duplicate_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class stays, once; rows without an id stay."""
    classes = near_duplicates(docs)
    first = classes.where("doc_id = class_id").select("doc_id").distinct()
    kept = docs.join(first, "doc_id", "left_semi").dropDuplicates(["doc_id"])
    return kept.unionByName(docs.where("doc_id is null")).select(*docs.columns)


def _whole_characters(kept: bytes, spans: list[dict]) -> bytes:
    """``kept`` without the rests of characters that an edge of a removed span goes through."""
    cuts, gone = [0], 0
    for span in spans:
        cuts.append(span["start"] - gone)
        gone += span["length"]
    out = []
    for k, (s, e) in enumerate(zip(cuts, [*cuts[1:], len(kept)])):
        if k:  # behind a span
            most = min(e, s + 3)
            while s < most and 0x80 <= kept[s] <= 0xBF:
                s += 1
        if k < len(spans):  # before a span
            lead = e - 1
            while lead > s and lead > e - 3 and 0x80 <= kept[lead] <= 0xBF:
                lead -= 1
            if lead >= s and kept[lead] >= 0xC0 and e - lead < (2 if kept[lead] < 0xE0 else 3 if kept[lead] < 0xF0 else 4):
                e = lead
        out.append(kept[s:e])
    return b"".join(out)


def _cut_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [_whole_characters(k, s) if s else k for k, s in zip(batch.column(1).to_pylist(), batch.column(2).to_pylist())]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(texts, pa.binary())], ["doc_id", "text"])


@_bounded
def repeated_passage_filter(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents stay, without the 50-byte strings that an earlier one has.

    Where a cut goes through a character, what is left of it goes too; nothing
    else changes, and texts without a repeated passage stay as they are.
    ``n_chars`` is that of the new text. Ids are unique after the stage before.
    """
    with_text = F.col("doc_id").isNotNull() & F.col("text").isNotNull()
    cut = remove_repeats(docs.where(with_text)).select("doc_id", "kept", "spans")
    cut = cut.mapInArrow(_cut_texts, "doc_id long, text binary").withColumn("text", F.col("text").cast("string"))
    rest = docs.where(with_text).drop("text", "n_chars")
    new = rest.join(cut, "doc_id").withColumn("n_chars", F.length("text").cast("long"))
    return new.select(*docs.columns).unionByName(docs.where(~with_text))


@_bounded
def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row per piece of a document with its place in a sequence of 1024 tokens."""
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


STAGES = [
    ("toxicity", toxicity_filter),
    ("language_id", language_filter),
    ("near_duplicates", near_duplicate_filter),
    ("repeated_passages", repeated_passage_filter),
    ("packing", packing),
]

#: Trained models, alignments and packing have no SQL form.
ORACLE_SQL: str | None = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``documents`` through every stage; each result is written to the shared folder for the next."""
    docs = read_table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = shared_copy(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
