"""One query per operator, over its whole table with production parameters."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilrank.llm import (
    bpe, centroids, decontaminate, filter_audit, language, mixing, quality, secret_scan, sharding, simhash,
    token_counts, warc, weighted_sampling,
)
from veilrank.session import scratch_path


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def key_crc(column: str = "doc_id"):
    """CRC-32 of a key written as text."""
    return F.crc32(F.col(column).cast("string").cast("binary"))


def op1_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = scratch_path(spark, "warc")
    warc.archive_pages(table(spark, sf_dir, "pages"), path)
    return warc.read_pages(spark, path)


def op2_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = table(spark, sf_dir, "labels").where(key_crc() % 3 != 1)
    scored = quality.score(docs, *quality.learn(docs, labels))
    return scored.select("doc_id", (key_crc() % 3 == 1).alias("held_out"), "score", "predicted")


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = secret_scan.scan(docs, secret_scan.train(secret_scan.samples(docs)))
    spans, random = F.col("secrets"), secret_scan.KINDS.index("random")
    base = F.filter(spans, lambda x: x["kind"] != random)
    return found.select(
        "doc_id",
        *(secret_scan.count_of(spans, k).alias(f"n_{k}") for k in ("assign", "access", "hex")),
        F.sha2(secret_scan.written(base), 256).alias("base_sha256"),
        secret_scan.written(spans).alias("spans"),
    )


def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    return weighted_sampling.with_edits(table(spark, sf_dir, "documents"))


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark"))


def op6_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return sharding.shard(docs, 40).select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe.encode(docs, public_tokenizers.path("word_bpe_49k.json"))
    return coded.select(
        "doc_id",
        F.size("ids").cast("long").alias("n_tokens"),
        F.sha2(F.concat_ws(" ", F.col("ids").cast("array<string>")), 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = token_counts.read_pieces(public_tokenizers.path("piece_bpe_32k.model"))
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return token_counts.count_tokens(docs, pieces)


def op9_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select(
        "doc_id", "text", "lang", (key_crc() % 5 == 0).alias("held_out")
    )
    model = language.learn(docs.where(~F.col("held_out")))
    return language.identify(docs.select("doc_id", "held_out", "text"), model)


def op10_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"), shingle=3, distance=3)


def op11_centroids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return centroids.with_inertia(*centroids.cluster(table(spark, sf_dir, "embeddings")))


def op12_filter_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    return filter_audit.audit_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op13_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.mix(table(spark, sf_dir, "documents"))
    return mixed.select("doc_id", "size", "source_size", "target", "taken")


QUERIES = {
    "op1_warc": op1_warc,
    "op2_quality": op2_quality,
    "op3_secrets": op3_secrets,
    "op4_fingerprints": op4_fingerprints,
    "op5_decontamination": op5_decontamination,
    "op6_sharding": op6_sharding,
    "op7_bpe": op7_bpe,
    "op8_token_counts": op8_token_counts,
    "op9_language": op9_language,
    "op10_simhash": op10_simhash,
    "op11_centroids": op11_centroids,
    "op12_filter_audit": op12_filter_audit,
    "op13_mixing": op13_mixing,
}
