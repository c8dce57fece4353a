"""Registered queries of the dealt operators, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dryspell.llm import (bpe, conversation_repair, decontaminate, jaccard_join, language_id, license_scan, line_crf,
                          line_dedup, substring_dedup, topk, toxicity_knn, treap_search, warc)
from dryspell.llm.common import doc_table, id_bucket
from dryspell.operators._exec import materialize
from dryspell.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def learnable(spark: SparkSession, sf_dir: str, label: str, modulus: int, held: int) -> DataFrame:
    """(doc_id, label) outside the held-out remainder; a repeated id keeps its largest label."""
    return (table(spark, sf_dir, "labels")
            .select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col(label).cast("int").alias("label"))
            .where(F.col("doc_id").isNotNull() & F.col("label").isNotNull() & (id_bucket(modulus) != held))
            .groupBy("doc_id").agg(F.max("label").alias("label")))


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = doc_table(table(spark, sf_dir, "documents"))
    model = line_crf.fit(docs, learnable(spark, sf_dir, "quality", 3, 1))
    return line_crf.score(docs, model).select(
        "doc_id", (id_bucket(3) == 1).alias("held_out"), "score", "predicted", "n_lines", "n_bad_lines")


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = doc_table(table(spark, sf_dir, "documents"))
    return bpe.encode_documents(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text")


def op3_jaccard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard_join.join(table(spark, sf_dir, "documents"), n=4, percent=85)


def op4_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.archive(table(spark, sf_dir, "pages"), scratch_path(spark, "warc")).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")


def op5_license(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.scan(table(spark, sf_dir, "documents"))


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup(doc_table(table(spark, sf_dir, "documents")), least_words=1)


def op7_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = doc_table(table(spark, sf_dir, "documents"))
    return decontaminate.scan(docs, table(spark, sf_dir, "benchmark")).drop("text")


def op8_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = materialize(topk.integer_vectors(table(spark, sf_dir, "embeddings")), "topk-vectors")
    return topk.top_k(vectors, vectors.where("vec_id % 20 = 0"), k=20)


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = doc_table(table(spark, sf_dir, "documents"))
    model = toxicity_knn.fit(docs, learnable(spark, sf_dir, "toxic", 5, 0))
    return toxicity_knn.score(docs, model).select(
        "doc_id", (id_bucket(5) == 0).alias("held_out"), "score", "predicted", "evidence", "similarity")


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"),
        F.col("lang").cast("string").alias("lang"))
    model = language_id.fit(docs.where(id_bucket(3) != 1))
    return language_id.predict(docs.select("doc_id", "text"), model).select(
        "doc_id", (id_bucket(3) == 1).alias("held_out"), "lang_pred", "score", "ambiguous")


def op11_conversation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversation_repair.summaries(conversation_repair.damage(table(spark, sf_dir, "conversations")))


def op12_substring(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.remove_repeats(table(spark, sf_dir, "documents"), window=35).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op13_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return treap_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"), k=20)


QUERIES = {
    "op1_quality": op1_quality,
    "op2_bpe": op2_bpe,
    "op3_jaccard": op3_jaccard,
    "op4_warc": op4_warc,
    "op5_license": op5_license,
    "op6_line_dedup": op6_line_dedup,
    "op7_decontaminate": op7_decontaminate,
    "op8_topk": op8_topk,
    "op9_toxicity": op9_toxicity,
    "op10_language": op10_language,
    "op11_conversation": op11_conversation,
    "op12_substring": op12_substring,
    "op13_search": op13_search,
}

ORACLE_SQL: dict[str, str] = {
    "op4_warc": warc.ORACLE_SQL,
    "op5_license": license_scan.oracle_sql(),
    "op8_topk": topk.oracle_sql(k=20, every=20),
    "op11_conversation": conversation_repair.oracle_sql(),
    "op12_substring": substring_dedup.oracle_sql(window=35),
    "op13_search": treap_search.oracle_sql(k=20),
}
