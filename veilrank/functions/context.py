"""Scores lifted by words that stand near a span."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilrank.catalog import CONTEXT_LIFT, CONTEXT_WINDOW, CONTEXT_WORDS
from veilrank.functions.arrays import cut, let, text_blocks

_INNER = "\ue002"  # a word character for the pattern below: what is cut off does not begin a word


def context_pattern(words: Sequence[str]) -> str:
    """Any of the words, whole and in either case, in a window with its marks."""
    quoted = "|".join(rf"\Q{w}\E" for w in sorted(words, key=len, reverse=True))
    return rf"(?iU)(?<![\w{_INNER}])(?:{quoted})(?![\w{_INNER}])"


def lift_scores(
    text: Column,
    spans: Column,
    words: Mapping[str, Sequence[str]] = CONTEXT_WORDS,
    lift: float = CONTEXT_LIFT,
    window: int = CONTEXT_WINDOW,
) -> Column:
    """``spans`` with the scores raised by ``lift``, to 1 at most, where a word of their type is near.

    Near is within ``window`` characters before or behind the span; a word that the window's edge
    cuts, or that reaches into the span, does not count.  Types without words keep their scores, and a
    null text has no spans.  Only the windows are searched, so the cost grows with the spans.
    """
    listed = {t: context_pattern(w) for t, w in words.items() if w}
    if not listed:
        return spans

    def lifted(found: Column) -> Column:
        own, blocks, size = found["spans"], found["blocks"], found["size"]

        def one(span: Column) -> Column:
            start, end = F.greatest(span["start"] - window, F.lit(0)), F.least(span["end"] + window, size)
            edge = F.lit(_INNER)
            around = F.concat(
                F.when(start > 0, edge).otherwise(""), cut(blocks, start, span["start"]), edge, F.lit(" "), edge,
                cut(blocks, span["end"], end), F.when(end < size, edge).otherwise(""),
            )

            def score(around: Column) -> Column:
                hit = F.lit(False)
                for entity_type, pattern in listed.items():
                    hit = F.when(span["entity_type"] == entity_type, around.rlike(pattern)).otherwise(hit)
                return F.when(hit, F.least(F.round(span["score"] + lift, 6), F.lit(1.0))).otherwise(span["score"])

            return span.withField("score", let(around, score))

        return F.transform(own, one)

    # Texts without a span, most of a large table, are not cut into blocks.
    some = F.size(spans) > 0
    found = F.struct(spans.alias("spans"), F.when(some, text_blocks(text)).alias("blocks"),
                     F.char_length(text).alias("size"))
    return let(found, lifted)
