"""Redaction by rule: one projection, no shuffle, no Python on the rows."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilrank.catalog import select_rules, select_types
from veilrank.functions.matching import replace_rules
from veilrank.functions.text import is_blank


def redact_column(
    text: Column, types: Iterable[str] | None = None, order: str = "specific_first"
) -> Column:
    """Apply the rules of the chosen types one after the other, each to the changed text.

    Null and blank text holds nothing a rule could match and comes through unchanged.  A chosen
    type that no rule can find raises: field-only types are masked by spans.
    """
    if types is not None:
        types = set(types) if not isinstance(types, str) else types
        bare = sorted(set(select_types(types)) - {r.entity_type for r in select_rules(types)})
        if bare:
            raise ValueError(f"no rule redacts {', '.join(bare)}; use the spans")
    return replace_rules(text, select_rules(types, order))


def redact(
    df: DataFrame,
    text: str = "text",
    types: Iterable[str] | None = None,
    order: str = "specific_first",
    keep_raw: bool = False,
    output: str = "anonymized_content",
) -> DataFrame:
    """Add the redacted text; the raw text is dropped unless ``keep_raw``."""
    out = df.withColumn(output, redact_column(F.col(text), types, order))
    return out if keep_raw or output == text else out.drop(text)


def blank_guard(text: Column, changed: Column) -> Column:
    """``changed`` for text with content; null and blank text stays as it is."""
    return F.when(is_blank(text), text).otherwise(changed)


def text_status(text: Column, changed: Column) -> Column:
    return (
        F.when(is_blank(text), "blank").when(changed == text, "clean").otherwise("redacted")
    )
