"""Entities and spans.

Spans stay in an array next to their document: detection, overlap resolution and masking are
one projection, so the text is never shuffled.  ``explode_spans`` gives the row form.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilrank.catalog import (
    DEFAULT_PLACEHOLDER,
    DETECTORS,
    PLACEHOLDERS,
    SCORE_THRESHOLD,
    select_fields,
    select_rules,
    select_types,
)
from veilrank.functions.arrays import cut, fold_out, let, text_blocks
from veilrank.functions.context import lift_scores
from veilrank.functions.matching import SPAN_TYPE, field_spans, gated, rule_spans, rule_texts

_ISLAND = (
    "struct<start:int,end:int,label:struct<score:double,width:int,entity_type:string>>"
)


def entity_map(text: Column, types: Iterable[str] | None = None) -> Column:
    """``map<type, array<text>>`` in lower-case types; texts distinct in first-seen order.

    Detection runs on the original text, so a placeholder is never taken for a value.
    """
    rules = select_rules(types)
    by_type = {t: [r for r in rules if r.entity_type == t] for t in select_types(types)}
    by_type = {t: rs for t, rs in by_type.items() if rs}
    if not by_type:
        return F.create_map().cast("map<string,array<string>>")

    def found(text: Column, may: Callable) -> Column:
        entries = [
            F.struct(
                F.lit(t.lower()).alias("key"),
                F.array_distinct(F.concat(*[rule_texts(text, r, may(r, text)) for r in rs])).alias("value"),
            )
            for t, rs in by_type.items()
        ]
        return F.map_from_entries(F.filter(F.array(*entries), lambda e: F.size(e["value"]) > 0))

    return gated(text, rules, found)


def explode_entities(df: DataFrame, key: str, entities: str = "entities") -> DataFrame:
    """Long form ``(key, entity_type, ord, entity_text)``; ``ord`` counts from 0."""
    by_type = explode_map(df, key, entities=entities)
    return by_type.select(key, "entity_type", F.posexplode("texts").alias("ord", "entity_text"))


def explode_map(df: DataFrame, *keys: str, entities: str = "entities") -> DataFrame:
    """Rows ``(keys, entity_type, texts)`` of an entity map column.

    An outer explode: the inner one infers a filter on the map, which would be pushed below
    the projection that makes the map and search every text twice.
    """
    rows = df.select(*keys, F.explode_outer(entities).alias("entity_type", "texts"))
    return rows.where(F.col("entity_type").isNotNull())


def extract_entities(
    df: DataFrame, key: str = "doc_id", text: str = "text", types: Iterable[str] | None = None
) -> DataFrame:
    """Entities of every document as rows."""
    found = df.select(key, entity_map(F.col(text), types).alias("entities"))
    return explode_entities(found, key)


def detect_spans(text: Column, types: Iterable[str] | None = None) -> Column:
    """Every hit of every rule: ``array<struct<start,end,score,entity_type,text,rule_id>>``."""
    rules = select_rules(types)
    if not rules:
        return F.array().cast(f"array<{SPAN_TYPE}>")
    return rule_spans(text, rules)


def extra_spans(text: Column, types: Iterable[str] | None = None) -> Column:
    """Spans of the once-per-document field extractors, of the chosen types."""
    chosen = set(select_types(types))
    fields = select_fields(types)
    if not fields:
        return F.array().cast(f"array<{SPAN_TYPE}>")
    spans = F.concat(*[field_spans(text, f, chosen) for f in fields])
    return F.filter(spans, lambda s: s["end"] > s["start"])


def above_threshold(spans: Column, threshold: float = SCORE_THRESHOLD) -> Column:
    return F.filter(spans, lambda s: s["score"] >= threshold)


def spans_in_context(
    text: Column, types: Iterable[str] | None = None, threshold: float = SCORE_THRESHOLD
) -> Column:
    """Rule hits at or above the threshold once the words near them have lifted their scores."""
    return let(detect_spans(text, types), lambda s: above_threshold(lift_scores(text, s), threshold))


def all_spans(
    text: Column,
    types: Iterable[str] | None = None,
    threshold: float = SCORE_THRESHOLD,
    context: bool = False,
) -> Column:
    """Rule hits at or above the threshold, and the field extractors' spans.

    With ``context`` the words near a hit lift its score first.
    """
    hits = spans_in_context(text, types, threshold) if context else above_threshold(
        detect_spans(text, types), threshold
    )
    return F.concat(hits, extra_spans(text, types))


def span_entities(spans: Column) -> Column:
    """The entity map of a span array: distinct texts per lower-case type, in span order."""
    types = F.array_distinct(F.transform(spans, lambda s: s["entity_type"]))

    def texts(entity_type: Column) -> Column:
        own = F.filter(spans, lambda s: s["entity_type"] == entity_type)
        return F.array_distinct(F.transform(own, lambda s: s["text"]))

    return F.map_from_arrays(F.transform(types, F.lower), F.transform(types, texts))


def detector_names(entity_type: Column) -> Column:
    """The detector names a type stands for: ``array<string>``."""
    mapped = reduce(
        lambda chain, item: chain.when(
            entity_type == item[0], F.array(*[F.lit(n) for n in item[1]])
        ),
        DETECTORS.items(),
        F.when(F.lit(False), F.array(F.lit(""))),
    )
    return mapped.otherwise(F.array(entity_type))


def resolve_overlaps(spans: Column) -> Column:
    """Merge overlapping spans into islands ``array<struct<start,end,label>>``.

    Touching spans stay apart.  An island carries the type of its best span: highest score,
    then longest, then last type name.
    """

    def add(island: Column, span: Column) -> tuple[Column, Column]:
        label = F.struct(
            span["score"].alias("score"),
            (span["end"] - span["start"]).alias("width"),
            span["entity_type"].alias("entity_type"),
        )
        fresh = island.isNull() | (span["start"] >= island["end"])
        following = F.when(
            fresh,
            F.struct(span["start"].alias("start"), span["end"].alias("end"), label.alias("label")),
        ).otherwise(
            F.struct(
                island["start"].alias("start"),
                F.greatest(island["end"], span["end"]).alias("end"),
                F.greatest(island["label"], label).alias("label"),
            )
        )
        done = F.when(island.isNotNull() & fresh, F.array(island)).otherwise(
            F.array().cast(f"array<{_ISLAND}>")
        )
        return following, done

    nothing = F.lit(None).cast(_ISLAND)
    return let(F.array_sort(spans), lambda ordered: let(
        fold_out(ordered, nothing, add, f"array<{_ISLAND}>"),
        lambda acc: F.when(acc["state"].isNull(), acc["out"]).otherwise(
            F.concat(acc["out"], F.array(acc["state"]))
        ),
    ))


def placeholder(entity_type: Column) -> Column:
    pairs = [F.lit(v) for item in PLACEHOLDERS.items() for v in item]
    return F.coalesce(F.create_map(*pairs)[entity_type], F.lit(DEFAULT_PLACEHOLDER))


def mask_spans(text: Column, islands: Column) -> Column:
    """Replace every island by the placeholder of its type.  Null text stays null."""

    def around(found: Column) -> Column:
        islands, blocks = found["islands"], found["blocks"]

        def piece(island: Column, i: Column) -> Column:
            before = F.coalesce(F.get(islands, i - 1)["end"], F.lit(0))
            between = cut(blocks, before, island["start"])
            return F.concat(between, placeholder(island["label"]["entity_type"]))

        rest = cut(blocks, F.get(islands, F.size(islands) - 1)["end"], F.char_length(text))
        masked = F.concat(F.array_join(F.transform(islands, piece), ""), rest)
        return F.when(F.size(islands) > 0, masked).otherwise(text)

    return let(F.struct(islands.alias("islands"), text_blocks(text).alias("blocks")), around)


def redact_by_spans(
    df: DataFrame,
    text: str = "text",
    types: Iterable[str] | None = None,
    threshold: float = SCORE_THRESHOLD,
    keep_raw: bool = False,
    output: str = "anonymized_content",
    context: bool = False,
) -> DataFrame:
    """Detect, merge and mask in one pass over the text."""
    staged = df.withColumn("_spans", all_spans(F.col(text), types, threshold, context))
    staged = staged.withColumn("_islands", resolve_overlaps(F.col("_spans")))
    out = staged.withColumn(output, mask_spans(F.col(text), F.col("_islands")))
    out = out.drop("_spans", "_islands")
    return out if keep_raw or output == text else out.drop(text)


def explode_spans(df: DataFrame, key: str, spans: str = "spans") -> DataFrame:
    """Row form of a span array; an outer explode for the reason given in ``explode_map``."""
    rows = df.select(key, F.explode_outer(spans).alias("span"))
    return rows.where(F.col("span").isNotNull()).select(key, "span.*")


def entities_by_resume(df: DataFrame, key: str, rid: str, entities: str) -> DataFrame:
    """One entity map per résumé id: of the last document that has entities.

    An aggregate, not a window: an id shared by very many documents is reduced to one
    candidate per task before anything is shuffled.
    """
    has_any = F.when(F.size(entities) > 0, F.col(key))
    last = F.max_by(F.struct(key, entities), has_any).alias("last")
    latest = df.groupBy(rid).agg(last).where(F.col("last").isNotNull())
    return latest.select(
        rid, F.col(f"last.{key}").alias(key), F.col(f"last.{entities}").alias(entities)
    )
