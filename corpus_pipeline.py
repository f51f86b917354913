"""The corpus pipeline over ``documents``: quality, near copies, decontamination, secrets, tokens.

Every stage takes what the one before it kept.  All but the last return the columns of ``documents``;
a stage that changes texts also mends ``n_chars``.  A document is known by its doc_id and its text
together, so that rows of a null or repeated doc_id are told apart by their texts.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from veilrank.llm import bpe, decontaminate, quality, secret_scan, simhash
from veilrank.llm.queries import key_crc, table
from veilrank.session import scratch_path

COLUMNS = ("doc_id", "text", "lang", "source", "n_chars")


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that the quality classifier rejects: a score under one half.

    It learns word vectors from the stage's own documents and labels from those not held out.
    """
    labels = table(spark, sf_dir, "labels").where(key_crc() % 3 != 1)
    own = docs.select(*COLUMNS)
    scored = quality.score(own, *quality.learn(own, labels), keep_text=True)
    return scored.where("predicted = 1").select(*COLUMNS)


def row_id(doc_id: str = "doc_id", text: str = "text") -> Column:
    """A name of a document, never null: its doc_id and the digest of its text, ``-`` for nulls."""
    return F.concat_ws(
        ":", F.coalesce(F.col(doc_id).cast("string"), F.lit("-")), F.coalesce(F.sha2(text, 256), F.lit("-"))
    )


def keep_one_copy(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep one document in each group of near copies: that of the smallest doc_id, then digest of the text.

    A null doc_id comes last.  Rows that repeat a doc_id and its text count once.
    """
    named = docs.select(*COLUMNS).withColumn("row_id", row_id())
    groups = simhash.grouped(named, shingle=3, distance=3, carried=["row_id"])
    first = F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "row_id")).alias("first")
    kept = groups.groupBy("root").agg(first).select("first.row_id")
    return named.join(kept, "row_id", "left_semi").dropDuplicates(["row_id"]).select(*COLUMNS)


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop the documents that hold an item of the benchmark; rows of the same doc_id without one stay."""
    named = docs.select(*COLUMNS).withColumn("row_id", row_id())
    found = decontaminate.contaminated(named, table(spark, sf_dir, "benchmark"), carried=["row_id"])
    return named.join(found.select("row_id").distinct(), "row_id", "left_anti").select(*COLUMNS)


def mask_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replace every secret by a mark; documents stay, and so do null texts."""
    weights = secret_scan.train(secret_scan.samples(docs))
    found = secret_scan.scan(docs.select(*COLUMNS), weights)
    text = F.when(F.col("text").isNotNull(), secret_scan.masked(F.col("text"), F.col("secrets")))
    changed = F.size("secrets") > 0
    return found.withColumn("text", text).withColumn(
        "n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars"))
    ).select(*COLUMNS)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The ids of every text, with its keys."""
    path = public_tokenizers.path("word_bpe_49k.json")
    coded = bpe.encode(docs.select("doc_id", "text", "lang", "source"), path, decode=False)
    return coded.withColumn("n_tokens", F.size("ids").cast("long"))


STAGES = [
    ("quality classifier", keep_good),
    ("SimHash near-dedup", keep_one_copy),
    ("benchmark decontamination", drop_benchmark),
    ("secret scans", mask_secrets),
    ("BPE encoding and decoding", encode),
]

ORACLE_SQL = None  # the stages learn models, which SQL cannot express


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = scratch_path(spark, name.replace(" ", "_"))
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
