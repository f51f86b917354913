"""Redaction of arriving files, and the latest entities of every résumé id."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from veilrank.catalog import SCORE_THRESHOLD
from veilrank.functions.text import resume_id
from veilrank.operators.entities import entities_by_resume, entity_map
from veilrank.plans.redaction_job import redaction_table


def stream_parquet(
    spark: SparkSession,
    folder: str,
    schema: StructType,
    pattern: str | None = None,
    files_per_batch: int = 1000,
) -> DataFrame:
    reader = spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_batch)
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.parquet(folder)


def incremental_redact(
    docs: DataFrame,
    output: str,
    checkpoint: str,
    key: str = "doc_id",
    text: str = "text",
    types: Iterable[str] | None = None,
    partitions: int | None = None,
    threshold: float = SCORE_THRESHOLD,
) -> StreamingQuery:
    """Redact what has arrived since the last run and append it to a Parquet table.

    Each batch holds the redacted text and the entities found in it, by spans, so that no chosen
    type stays in the text.  Stateless: the file sink
    and the checkpoint make a restart add nothing twice, and memory depends on a batch only.
    ``partitions`` spreads the rows of a batch where few files arrive at a time.
    """
    if partitions:
        docs = docs.repartition(partitions, key)
    redacted = redaction_table(docs.select(key, text), text, types, threshold=threshold).select(
        key, "anonymized_content", "resume_id", "entities"
    )
    return (
        redacted.writeStream.format("parquet")
        .option("path", output)
        .option("checkpointLocation", checkpoint)
        .outputMode("append")
        .trigger(availableNow=True)
        .start()
    )


_BATCH = "batch_id"


def incremental_entities(
    docs: DataFrame,
    output: str,
    checkpoint: str,
    key: str = "doc_id",
    text: str = "text",
    types: Iterable[str] | None = None,
) -> StreamingQuery:
    """Keep the entities of every résumé id: those of its last document that has any.

    The aggregate of ``entities_by_resume`` runs with state: for each id the document of the greatest key seen
    so far.  An earlier document that arrives late changes nothing, so any order of files gives
    the batch result.  Each batch writes the ids it changed to a folder of its own number; a batch that is
    repeated after a failure writes the same folder again.  ``latest_entities`` reads the table.
    State grows with the ids, not with the documents; for many of them choose the RocksDB state store.
    """
    found = docs.select(
        key, resume_id(F.col(text)).alias("resume_id"), entity_map(F.col(text), types).alias("entities")
    )

    def write(changed: DataFrame, batch: int) -> None:
        changed.write.mode("overwrite").parquet(f"{output}/{_BATCH}={batch}")

    return (
        entities_by_resume(found, key, "resume_id", "entities")
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(availableNow=True)
        .start()
    )


def latest_entities(spark: SparkSession, output: str, key: str = "doc_id") -> DataFrame:
    """``(resume_id, key, entities)`` as of the last batch: for each id the row that was written last."""
    rows = spark.read.parquet(output)
    last = F.max_by(F.struct(key, "entities"), _BATCH).alias("last")
    return rows.groupBy("resume_id").agg(last).select("resume_id", f"last.{key}", "last.entities")


def compact_entities(spark: SparkSession, output: str, compacted: str, key: str = "doc_id") -> None:
    """Write the latest rows alone to another folder, which ``latest_entities`` reads as well."""
    latest_entities(spark, output, key).withColumn(_BATCH, F.lit(0).cast("long")).write.parquet(compacted)
