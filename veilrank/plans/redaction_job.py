"""The whole redaction job: read, sample, choose content, redact, extract, write, report."""

from __future__ import annotations

from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilrank.catalog import SCORE_THRESHOLD
from veilrank.functions.text import resume_id
from veilrank.operators.content import choose_content, discover_content_columns
from veilrank.operators.entities import (
    all_spans,
    entities_by_resume,
    entity_map,
    mask_spans,
    resolve_overlaps,
    span_entities,
)
from veilrank.operators.ranks import sample_n
from veilrank.operators.redact import redact_column, text_status
from veilrank.operators.statistics import entity_counts, entity_total, pii_coverage
from veilrank.session import remove, scratch_path
from veilrank.sources.writers import write_entities_json, write_redacted


@dataclass(frozen=True)
class RedactionReport:
    redacted: DataFrame
    entities: DataFrame
    coverage: DataFrame
    total: DataFrame
    counts: DataFrame
    path: str

    def close(self) -> None:
        """Delete the job's own table; the report's tables cannot be read afterwards."""
        remove(self.redacted.sparkSession, self.path)


def redaction_table(
    df: DataFrame,
    content: str,
    types: Iterable[str] | None = None,
    method: str = "spans",
    keep_raw: bool = False,
    threshold: float = SCORE_THRESHOLD,
) -> DataFrame:
    """Redacted text, status, résumé id and entities in one projection over the content.

    ``method`` is ``spans`` (detect, merge, mask) or ``rules`` (rule after rule); the spans
    give the entities too, with those of the field extractors, from the same search, and so
    redact every type.  ``threshold`` is the least score of a span.
    """
    text = F.col(content)
    if method == "rules":
        made = df.withColumns(
            {
                "anonymized_content": redact_column(text, types),
                "entities": entity_map(text, types),
            }
        )
    elif method == "spans":
        spans = F.col("_spans")
        made = (
            df.withColumn("_spans", all_spans(text, types, threshold))
            .withColumns(
                {
                    "anonymized_content": mask_spans(text, resolve_overlaps(spans)),
                    "entities": span_entities(spans),
                }
            )
            .drop("_spans")
        )
    else:
        raise ValueError(f"unknown method: {method}")
    made = made.withColumns(
        {
            "resume_id": resume_id(text),
            "status": text_status(text, F.col("anonymized_content")),
        }
    )
    return made if keep_raw else made.drop(content)


def run_redaction(
    df: DataFrame,
    output: str,
    entities_output: str,
    key: str = "doc_id",
    types: Iterable[str] | None = None,
    sample_size: int | None = None,
    content_column: str | None = "content",
    method: str = "spans",
    keep_raw: bool = False,
    format: str = "csv",
    threshold: float = SCORE_THRESHOLD,
) -> RedactionReport:
    """Write the redacted table and the entity JSON; return them with the statistics.

    The projection is written to the shared folder once; the redacted sink and the entities of each résumé id
    read that table, so no text is searched twice.  Those entities are written beside it, so that the JSON sink
    and the statistics do not work them out again each.  The redacted table has all columns of the input
    but, without ``keep_raw``, those that the content was made from.  The table in the shared
    folder holds the entities' texts: ``close()`` of the report deletes it.
    """
    table = df if sample_size is None else sample_n(df, sample_size, key)
    table, content = choose_content(table, content_column, key=key)
    made = redaction_table(table, content, types, method, keep_raw, threshold)
    if not keep_raw and content not in df.columns:
        made = made.drop(*discover_content_columns(df, key))
    path = scratch_path(df.sparkSession, "redaction")

    def stored(table: DataFrame, name: str) -> DataFrame:
        table.write.parquet(f"{path}/{name}")
        return df.sparkSession.read.schema(table.schema).parquet(f"{path}/{name}")

    made = stored(made, "documents")

    write_redacted(made.drop("status", "resume_id", "entities"), output, format)
    latest = stored(entities_by_resume(made, key, "resume_id", "entities"), "entities")
    write_entities_json(latest, entities_output)
    return RedactionReport(
        redacted=made,
        entities=latest,
        coverage=pii_coverage(made, "resume_id"),
        total=entity_total(latest),
        counts=entity_counts(latest),
        path=path,
    )
