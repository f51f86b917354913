"""Spark expressions for one detection rule.

Every expression reads its input column once, so that rules can be nested or placed side by
side without the expression tree growing faster than the number of rules.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from veilrank.catalog import GATES, Field, Rule
from veilrank.functions.arrays import let, running_totals

UNICODE = "(?U)"
_MARK, _ASIDE = "\u0001", "\u0002"  # control characters: of no class a rule names, and a byte each
SPAN_TYPE = (
    "struct<start:int,end:int,score:double,entity_type:string,text:string,rule_id:string>"
)


def spark_pattern(rule: Rule) -> str:
    """Java form of the rule: Unicode classes, and a cheap look at the first character."""
    head = f"(?={rule.head})" if rule.head else ""
    return UNICODE + head + rule.pattern


def contains_any(text: Column, needles: tuple[str, ...]) -> Column:
    return reduce(lambda a, b: a | b, [text.contains(n) for n in needles])


def gated(text: Column, rules: Sequence[Rule], body: Callable[[Column, Callable], Column]) -> Column:
    """``body(text, may)`` where ``may(rule, text)`` tells cheaply whether the rule can match a text.

    The gates that the rules share are searched once, in the text given here; ``may`` also takes this text
    with values of other rules masked.  No condition at all is ``None``.
    """
    names = {r.gate for r in rules if r.gate}
    names |= {GATES[n][0] for n in names if GATES[n][0]}

    def opened(name: str) -> Column:
        first, pattern = GATES[name]
        found = text.rlike(UNICODE + pattern)
        return found if first is None else text.rlike(UNICODE + GATES[first][1]) & found

    def bound(read: Column) -> Column:
        def may(rule: Rule, now: Column) -> Column | None:
            tests = [read[rule.gate]] if rule.gate else []
            if rule.needs:
                tests.append(contains_any(now, rule.needs))
            return reduce(lambda a, b: a & b, tests) if tests else None

        return body(read["text"], may)

    gates = [opened(n).alias(n) for n in GATES if n in names]
    return let(F.struct(text.alias("text"), *gates), bound)


def only_where(text: Column, possible: Callable[[Column], Column | None], change: Callable[[Column], Column]) -> Column:
    """``change(text)`` where ``possible(text)`` holds (or is ``None``: everywhere), else ``text``.

    ``text`` may be a deep expression: binding it to a lambda variable keeps it from being
    copied into both branches, which would double the tree with every nested rule.
    """

    def bound(t: Column) -> Column:
        condition = possible(t)
        return change(t) if condition is None else F.when(condition, change(t)).otherwise(t)

    return let(text, bound)


def replace_rules(text: Column, rules: Sequence[Rule]) -> Column:
    """The rules one after the other, each on the text that the last one left."""

    def folded(text: Column, may: Callable) -> Column:
        return reduce(lambda now, rule: only_where(
            now, lambda t: may(rule, t), lambda t: F.regexp_replace(t, spark_pattern(rule), rule.replacement)
        ), rules, text)

    return gated(text, rules, folded) if rules else text


def rule_texts(text: Column, rule: Rule, possible: Column | None = None) -> Column:
    """All values the rule finds, in text order: ``array<string>``, empty where it is not ``possible``."""
    found = F.regexp_extract_all(text, F.lit(spark_pattern(rule)), F.lit(rule.value))
    nothing = F.array().cast("array<string>")
    return found if possible is None else F.when(possible, found).otherwise(nothing)


def _marked(rule: Rule) -> str:
    """A replacement that keeps the match and puts a mark on either side of its value.

    The groups of a rule make up its match, so those beside the value stay where they are.
    """
    value = f"{_MARK}${rule.value}{_MARK}"
    return {0: value, 1: value + "$2", 2: "$1" + value}[rule.value]


def rule_spans(text: Column, rules: Sequence[Rule]) -> Column:
    """All values the rules find with 0-based, end-exclusive offsets: ``array<SPAN_TYPE>``.

    A rule searches the text once: its matches come back with marks around their values, and cutting
    at the marks leaves gaps and values in turn, whose running lengths are the offsets.  Where the
    text holds the mark itself, another character stands in for it and values are read from the text.
    """
    nothing = F.array().cast(f"array<{SPAN_TYPE}>")
    foreign = text.contains(_MARK)
    plain = F.when(foreign, F.translate(text, _MARK, _ASIDE)).otherwise(text)

    def hits(clean: Column, possible: Column | None, rule: Rule) -> Column:
        def cut_up(marked: Column) -> Column:
            return F.when(marked.contains(_MARK), F.struct(
                F.lit(rule.rule_id).alias("rule_id"),
                F.lit(rule.entity_type).alias("entity_type"),
                F.lit(float(rule.score)).alias("score"),
                F.split(marked, _MARK, -1).alias("pieces"),
            ))

        marked = F.regexp_replace(clean, spark_pattern(rule), _marked(rule))
        found = let(marked, cut_up)
        return found if possible is None else F.when(possible, found)

    def spans_of(rule: Column, foreign: Column) -> Column:
        pieces = rule["pieces"]

        def span(start: Column, value: Column) -> Column:
            end = start + F.length(value)
            own = F.when(foreign, F.substring(text, start + 1, F.length(value))).otherwise(value)
            return F.struct(
                start.alias("start"),
                end.alias("end"),
                rule["score"].alias("score"),
                rule["entity_type"].alias("entity_type"),
                own.alias("text"),
                rule["rule_id"].alias("rule_id"),
            )

        at = F.sequence(F.lit(1), F.size(pieces) - 2, F.lit(2))
        several = let(running_totals(F.transform(pieces, F.length)), lambda starts: F.transform(
            at, lambda i: span(F.get(starts, i), F.get(pieces, i))
        ))
        # One match, as most rules have where they have any, needs no running lengths.
        return F.when(F.size(pieces) == 3, F.array(
            span(F.length(F.get(pieces, 0)), F.get(pieces, 1))
        )).otherwise(several)

    def all_of(read: Column) -> Column:
        def found(clean: Column, may: Callable) -> Column:
            return F.array_compact(F.array(*[hits(clean, may(r, clean), r) for r in rules]))

        return F.flatten(F.transform(gated(read["clean"], rules, found), lambda rule: spans_of(rule, read["foreign"])))

    read = F.struct(plain.alias("clean"), foreign.alias("foreign"))
    return F.coalesce(let(read, all_of), nothing)


def field_spans(text: Column, field: Field, types: set[str]) -> Column:
    """Spans of the first match of a field extractor; values lose trailing white space.

    A text is searched once.  Patterns look at nothing beyond their match, so that its groups are those of the
    match alone, and it is where its characters first stand.
    """
    pattern = UNICODE + field.pattern
    nothing = F.array().cast(f"array<{SPAN_TYPE}>")

    def around(match: Column) -> Column:
        before = F.instr(text, match) - 1
        spans = []
        for group, entity_type in field.values:
            if entity_type not in types:
                continue
            lead = [F.length(F.regexp_extract(match, pattern, g)) for g in range(1, group)]
            begin = reduce(lambda a, b: a + b, lead, before)
            value = F.regexp_replace(F.regexp_extract(match, pattern, group), UNICODE + r"\s+\z", "")

            def span(found: Column) -> Column:
                return F.struct(
                    found["begin"].alias("start"),
                    (found["begin"] + F.length(found["value"])).alias("end"),
                    F.lit(field.score).alias("score"),
                    F.lit(entity_type).alias("entity_type"),
                    found["value"].alias("text"),
                    F.lit("field_" + field.field_id).alias("rule_id"),
                )

            spans.append(let(F.struct(begin.alias("begin"), value.alias("value")), span))
        return F.when(match != "", F.array(*spans).cast(f"array<{SPAN_TYPE}>")).otherwise(nothing)

    match = F.regexp_extract(text, pattern, 0)
    return F.when(contains_any(text, field.needs), let(match, around)).otherwise(nothing)
