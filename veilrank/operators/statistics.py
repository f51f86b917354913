"""Statistics of a redaction run."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilrank.operators.entities import explode_map


def pii_coverage(df: DataFrame, rid: str, entities: str = "entities") -> DataFrame:
    """Distinct résumé ids with entities against all rows; no percentage for an empty table."""
    found = F.count_distinct(F.when(F.size(entities) > 0, F.col(rid)))
    rows = F.count(F.lit(1))
    percent = F.try_divide(found * 100.0, rows)
    return df.agg(
        found.alias("n_with_pii"), rows.alias("n_rows"), F.round(percent, 2).alias("pct_with_pii")
    )


def entity_total(df: DataFrame, entities: str = "entities") -> DataFrame:
    """Entities over all rows, each text once per row and type."""
    total = F.coalesce(F.sum(F.size("texts")), F.lit(0).cast("long"))
    return explode_map(df, entities=entities).agg(total.alias("n_entities"))


def entity_counts(df: DataFrame, entities: str = "entities") -> DataFrame:
    """Entities per type, most frequent first."""
    return (
        explode_map(df, entities=entities)
        .groupBy("entity_type")
        .agg(F.sum(F.size("texts")).alias("n_entities"))
        .orderBy(F.desc("n_entities"), "entity_type")
    )
