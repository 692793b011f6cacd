"""The registered queries of this subpackage: thin calls that shape the digest columns."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from costlens.llm import conversation_repair, quality, toxicity
from costlens.llm.bpe_chunks import encode_documents
from costlens.llm.common import fold, read_table, shared_copy
from costlens.llm.langid import identify
from costlens.llm.minhash_dedup import near_duplicates
from costlens.llm.packing import pack_documents
from costlens.llm.source_mix import mix
from costlens.llm.suffix_dedup import remove_repeats
from costlens.llm.topk_search import sign_codes, top_k
from costlens.llm.url_filter import url_verdicts
from costlens.llm.vector_graph import audit_recall, linked
from costlens.llm.whitening import whitened


#: The query's rules.
URL_RULES = (("block", "net/"), ("allow", "example.net/en/"), ("block", "example.com/de/"), ("allow", "org/fr/"))


def op1_topk_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 10 nearest sign codes of every embedding whose id is divisible by 100."""
    codes = sign_codes(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", bits=64)
    return top_k(codes, F.col("id") % 100 == 0, k=10)


OP1_SQL = """
WITH v AS (
  SELECT DISTINCT vec_id AS id, list_transform(embedding, lambda x: x > 0) AS bits FROM embeddings
  WHERE vec_id IS NOT NULL AND len(embedding) = 64
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), p AS (
  SELECT q.id AS query_id, v.id AS neighbor_id,
         CAST(list_sum(list_transform(list_zip(q.bits, v.bits), lambda z: CASE WHEN z[1] <> z[2] THEN 1 ELSE 0 END)) AS INTEGER) AS distance
  FROM v AS q, v WHERE q.id % 100 = 0 AND v.id <> q.id
)
SELECT query_id, neighbor_id, distance,
       CAST(row_number() OVER (PARTITION BY query_id ORDER BY distance, neighbor_id) AS INTEGER) AS rank
FROM p QUALIFY rank <= 10
"""


def op2_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The toxicity of every document, learnt from labels that are not held out."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("toxic").alias("label"))
    return toxicity.judge(read_table(spark, sf_dir, "documents"), labels, held_out=fold("doc_id", 4) == 2)


def op3_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's url judged by the rules, else by its host's trust and distrust."""
    return url_verdicts(read_table(spark, sf_dir, "pages"), URL_RULES)


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document without the 50-byte strings that an earlier document has."""
    cut = remove_repeats(read_table(spark, sf_dir, "documents"))
    return cut.select(
        "doc_id",
        "n_bytes",
        (F.col("n_bytes") - F.octet_length("kept")).cast("long").alias("n_removed"),
        F.size("spans").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def op5_minhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the smallest id of its near-duplicate class."""
    classes = near_duplicates(read_table(spark, sf_dir, "documents"))
    return classes.withColumn("kept", F.coalesce(F.col("doc_id") == F.col("class_id"), F.lit(True)))


def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The quality of every document, learnt from labels that are not held out."""
    labels = read_table(spark, sf_dir, "labels").select("doc_id", F.col("quality").alias("label"))
    return quality.judge(read_table(spark, sf_dir, "documents"), labels, held_out=fold("doc_id", 3) == 1)


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding's links with a cosine of at least 0.9, and the audit's recall beside them."""
    nodes, units = linked(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", least=0.9)
    nodes = shared_copy(nodes, "linked")
    recall = audit_recall(units, nodes, least=0.9).first()["recall"]
    return nodes.select(
        F.col("id").alias("vec_id"),
        "n_links",
        "component_id",
        F.coalesce(F.col("id") == F.col("component_id"), F.lit(True)).alias("kept"),
        F.lit(float(recall)).alias("audit_recall"),
    )


def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The language of every document, learnt from the folds that are not held out."""
    return identify(read_table(spark, sf_dir, "documents"), held_out=fold("doc_id", 4) == 2)


def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents packed into sequences of 1024 byte-level BPE ids."""
    docs = read_table(spark, sf_dir, "documents")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"), capacity=1024, end_id=2)


def op10_bpe_chunks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document encoded and decoded with the word-end BPE vocabulary."""
    docs = read_table(spark, sf_dir, "documents")
    coded = encode_documents(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )


def op11_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation, damaged by a hash of its rows, with its faults and cheapest repair."""
    return conversation_repair.repair(conversation_repair.damage(read_table(spark, sf_dir, "conversations")))


def op12_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every embedding on the first 32 whitened principal components of all."""
    return whitened(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", most=32)


#: Weight in the mix of documents whose label says good or poor; others weigh 1.
GOOD_WEIGHT, POOR_WEIGHT = 2.0, 0.5


def op13_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All documents mixed by source, those of labelled quality first or last."""
    labels = read_table(spark, sf_dir, "labels").where("doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    weight = F.when(F.col("quality") == 1, GOOD_WEIGHT).when(F.col("quality") == 0, POOR_WEIGHT)
    return mix(read_table(spark, sf_dir, "documents"), labels.select("doc_id", weight.alias("weight")))


OP13_SQL = r"""
WITH q AS (SELECT doc_id, max(quality) AS quality FROM labels WHERE doc_id IS NOT NULL GROUP BY doc_id),
d AS (
  SELECT doc_id, source, CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
         CASE quality WHEN 1 THEN 2.0::DOUBLE WHEN 0 THEN 0.5::DOUBLE ELSE 1.0::DOUBLE END AS weight, md5(coalesce(text, '')) AS digest
  FROM documents LEFT JOIN q USING (doc_id)
), k AS (
  SELECT *, -ln((CAST('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '') || ':' || digest), 1, 13) AS BIGINT) + 0.5::DOUBLE)
                / 4503599627370496::DOUBLE) / weight AS key FROM d
), s AS (
  SELECT source, CAST(sum(size) AS HUGEINT) AS n,
         [5, 2, 1][CAST((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1 AS INTEGER)] AS w FROM d GROUP BY source
), c AS (
  SELECT *, w * sum(3 * n) OVER o + 3 * n * (sum(w) OVER () - sum(w) OVER o) <= w * sum(n) OVER () AS capped
  FROM s WINDOW o AS (ORDER BY n::DOUBLE / w, source ROWS UNBOUNDED PRECEDING)
), t AS (
  SELECT source, CAST(n AS BIGINT) AS source_size,
         CASE WHEN capped THEN CAST(3 * n AS DOUBLE)
              ELSE CAST(w * (sum(n) OVER () - coalesce(sum(3 * n) FILTER (WHERE capped) OVER (), 0)) AS DOUBLE)
                   / CAST(sum(w) FILTER (WHERE NOT capped) OVER () AS DOUBLE) END AS target FROM c
), p AS (
  SELECT k.*, t.source_size, t.target, CAST(round(t.target) AS BIGINT) AS budget,
         CAST(coalesce(sum(size) OVER (PARTITION BY k.source ORDER BY key, doc_id NULLS LAST, digest ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS BIGINT) AS upto
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source
), e AS (SELECT *, CASE WHEN source_size = 0 THEN 0 ELSE budget // source_size END AS epochs FROM p),
f AS (SELECT *, greatest(0, least(size, budget - epochs * source_size - upto)) AS part FROM e)
SELECT doc_id, size, source_size, target, CAST(epochs * size + part AS BIGINT) AS taken, CAST(epochs AS BIGINT) AS epochs,
       CAST(part AS BIGINT) AS part FROM f
"""


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_topk_search": op1_topk_search,
    "op2_toxicity": op2_toxicity,
    "op3_url_filter": op3_url_filter,
    "op4_suffix_dedup": op4_suffix_dedup,
    "op5_minhash_dedup": op5_minhash_dedup,
    "op6_quality": op6_quality,
    "op7_embedding_dedup": op7_embedding_dedup,
    "op8_language_id": op8_language_id,
    "op9_packing": op9_packing,
    "op10_bpe_chunks": op10_bpe_chunks,
    "op11_conversation_repair": op11_conversation_repair,
    "op12_embedding_whitening": op12_embedding_whitening,
    "op13_source_mix": op13_source_mix,
}

ORACLE_SQL: dict[str, str] = {
    "op1_topk_search": OP1_SQL,
    "op13_source_mix": OP13_SQL,
}
