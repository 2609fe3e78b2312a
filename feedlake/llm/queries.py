"""Registered queries: each operator on its whole table, with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from feedlake.llm import (byte_bpe, decontaminate, fill_middle, langid, mixing, near_dedup, quality, ranked_search, repeats, token_counts, topk,
                          toxicity, warc)
from feedlake.llm.common import fold, stored, table


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(table(spark, sf_dir, "documents"))


def op2_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op3_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    langs, model = langid.fit(docs.where(fold(F.col("doc_id"), 5) != 0))
    return (langid.identify(docs, langs, model)
            .select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "lang_pred", "score", "langs", "shares"))


def op4_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repeats.remove_repeats(table(spark, sf_dir, "documents")).drop("kept")


def op5_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = stored(quality.features(table(spark, sf_dir, "documents")), "quality-features")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality").where(fold(F.col("doc_id"), 4) != 2)
    model = quality.fit(rows.join(labels, "doc_id"), "quality")
    return (quality.score(rows, model)
            .select("doc_id", (fold(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
                    (F.col("score") >= 0.7).cast("int").alias("predicted")))


def op6_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.nearest(table(spark, sf_dir, "embeddings"), lambda vec_id: vec_id % 100 == 0)


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(table(spark, sf_dir, "documents"))


def op8_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(table(spark, sf_dir, "documents"))


def op9_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    labels = (table(spark, sf_dir, "labels").where(F.col("toxic").isNotNull() & (fold(F.col("doc_id"), 5) != 0))
              .select("doc_id", F.col("toxic").alias("label")))
    sample = toxicity.sample_labels(labels, "doc_id")
    rows = stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id").select("text", "label"), "toxicity-sample")
    return (toxicity.predict(docs, toxicity.fit(rows))
            .select("doc_id", (fold(F.col("doc_id"), 5) == 0).alias("held_out"), "score", "expected_severity", "grade",
                    (F.col("score") >= 0.5).cast("int").alias("predicted")))


def op10_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (warc.archive_and_read(table(spark, sf_dir, "pages"))
            .select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"))


def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    index = stored(ranked_search.build(table(spark, sf_dir, "documents")), "search-index")
    return ranked_search.search(index, table(spark, sf_dir, "benchmark"))


def op12_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    frames = stored(fill_middle.store(table(spark, sf_dir, "documents")), "frames")
    return fill_middle.digests(fill_middle.transform(frames))


def op13_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    vocabulary = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    encoded = byte_bpe.encode(table(spark, sf_dir, "documents"), vocabulary, public_tokenizers.PATTERN)
    return (byte_bpe.decode(encoded, vocabulary)
            .select("doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
                    F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256")))


QUERIES = {f.__name__: f for f in (op1_token_counts, op2_decontamination, op3_language_id, op4_suffix_array_dedup, op5_quality,
                                  op6_exact_top_k, op7_mixing, op8_near_dedup, op9_toxicity, op10_warc, op11_ranked_search,
                                  op12_fill_in_middle, op13_byte_bpe)}
