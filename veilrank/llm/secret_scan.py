"""Secrets in texts: three base rules, and strings that a Markov model takes for random.

Two character models are trained from labelled samples, one on random strings and one on ordinary
identifiers, as counts of character pairs over all samples.  A run of token characters is scored
by the sum of its log-likelihood ratios, kept in whole thousandths so that it is exact in any order.
Everything is an expression of built-in functions: texts never shuffle, and only pair counts are
grouped, at most one row for each label and pair.

Positions are code points.  They come from the gaps between matches, added up in chunks, so that a
text with very many matches costs no more than a small multiple of its length.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilrank.functions.arrays import cut, fold_out, text_blocks

# The base rules.
ASSIGN = (
    r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
)
ASSIGN_LEAST = 6
# Runs of one class are maximal, so a least length within the pattern finds the same matches as a
# filter behind it.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
KINDS = ("assign", "access", "hex", "random")

ALPHABET = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789+/_=-"
_CLASS = "A-Za-z0-9+/_=-"
CANDIDATE = rf"(?<![{_CLASS}])[{_CLASS}]{{16,}}"
IDENTIFIER = rf"(?<![{_CLASS}])[A-Za-z_][A-Za-z0-9_]{{11,}}(?![{_CLASS}])"
SMOOTH = 1.0
LEAST_TOTAL = 12_000  # thousandths of a nat, over the whole string
LEAST_MEAN = 500  # and for each of its pairs
LEAST_PIECE = 8  # characters of a random string beside a base span
_CHUNK = 256


def _let(value: Column, body) -> Column:
    """``body`` of a value that is worked out once."""
    return F.get(F.transform(F.array(value), body), 0)


def prefix_sums(numbers: Column) -> Column:
    """For each number of an array the sum of those before it."""
    empty = F.array().cast("array<long>")

    def fold(part: Column, total: Column) -> Column:
        return F.aggregate(
            part,
            F.struct(total.alias("total"), empty.alias("sums")),
            lambda acc, x: F.struct(
                (acc["total"] + x).alias("total"), F.array_append(acc["sums"], acc["total"]).alias("sums")
            ),
        )

    def add(acc: Column, chunk: Column) -> Column:
        return _let(
            fold(F.slice(numbers, chunk * _CHUNK + 1, _CHUNK), acc["total"]),
            lambda x: F.struct(x["total"].alias("total"), F.concat(acc["sums"], x["sums"]).alias("sums")),
        )

    chunks = F.sequence(F.lit(0), F.floor((F.size(numbers) - 1) / _CHUNK).cast("int"))
    start = F.struct(F.lit(0).cast("long").alias("total"), empty.alias("sums"))
    return F.when(F.size(numbers) == 0, empty).otherwise(
        F.aggregate(chunks, start, add)["sums"]
    )


def _spans(text: Column, pattern: str, kind: int, matches: Column, keep: Column | None = None) -> Column:
    """Spans of a pattern's matches as an array of ``(start, kind, end)``; ``keep`` says which stay."""
    rows = "array<struct<start:long,kind:int,end:long>>"

    def found(m: Column) -> Column:
        length = F.transform(m, lambda x: F.char_length(x).cast("long"))
        steps = F.zip_with(
            F.slice(F.transform(F.split(text, pattern, -1), lambda x: F.char_length(x).cast("long")), 1, F.size(m)),
            length, lambda gap, own: gap + own,
        )
        # a match starts where the ones before it end, and its own gap later
        return F.zip_with(
            F.zip_with(prefix_sums(steps), steps, lambda before, step: before + step), length,
            lambda end, own: F.struct((end - own).alias("start"), F.lit(kind).alias("kind"), end.alias("end")),
        )

    spans = _let(matches, found)
    if keep is not None:
        spans = F.filter(F.arrays_zip(spans.alias("span"), keep.alias("keep")), lambda x: x["keep"])
        spans = F.transform(spans, lambda x: x["span"])
    return F.when(F.size(matches) > 0, spans.cast(rows)).otherwise(F.array().cast(rows))


def _matches(text: Column, pattern: str, group: int = 0) -> Column:
    return F.regexp_extract_all(text, F.lit(pattern), F.lit(group))


def samples(docs: DataFrame) -> DataFrame:
    """``(value, label)`` from texts: what the base rules find is 1, other long identifiers are 0."""
    text = F.coalesce("text", F.lit(""))
    found = F.concat(
        F.filter(_matches(text, ASSIGN, 2), lambda x: F.char_length(x) >= ASSIGN_LEAST),
        _matches(text, ACCESS), _matches(text, HEX),
    )
    rest = F.regexp_replace(F.regexp_replace(text, ASSIGN, " "), f"{ACCESS}|{HEX}", " ")
    both = F.concat(
        F.transform(found, lambda x: F.struct(x.alias("value"), F.lit(1).alias("label"))),
        F.transform(_matches(rest, IDENTIFIER), lambda x: F.struct(x.alias("value"), F.lit(0).alias("label"))),
    )
    return docs.select(F.inline(both))


def train(labelled: DataFrame) -> list[int]:
    """Weights of character pairs in thousandths of a nat, from ``(value, label)``; label 1 is random.

    Values are counted whole, over all rows; characters outside the alphabet and nulls count for
    nothing.  A label without samples has a uniform model.
    """
    pairs = labelled.where("value IS NOT NULL AND label IN (0, 1)").select(
        "label", F.explode(_matches(F.col("value"), r"(?s)(?=(..))", 1)).alias("pair")
    )
    # At most 2 x 67 x 67 rows that matter; others are left out before they are gathered.
    inside = F.col("pair").rlike(rf"^[{_CLASS}]{{2}}$")
    counted = pairs.where(inside).groupBy("label", "pair").count().collect()
    n = len(ALPHABET)
    counts = [[[SMOOTH] * n for _ in range(n)] for _ in range(2)]
    for label, pair, number in counted:
        counts[label][ALPHABET.index(pair[0])][ALPHABET.index(pair[1])] += number
    weights = []
    for a in range(n):
        totals = [sum(counts[label][a]) for label in (0, 1)]
        weights += [
            round(1000 * math.log(counts[1][a][b] / totals[1] * totals[0] / counts[0][a][b]))
            for b in range(n)
        ]
    return weights


def likelihood_ratio(value: Column, weights: list[int]) -> Column:
    """Thousandths of a nat for random against ordinary, for a string of the alphabet."""
    table = F.split(F.lit(",".join(map(str, weights))), ",").cast("array<int>")
    n = len(ALPHABET)
    alphabet = F.lit(ALPHABET)

    def step(acc: Column, c: Column) -> Column:
        return _let(F.instr(alphabet, c) - 1, lambda i: F.struct(
            i.alias("last"),
            (acc["sum"] + F.when(acc["last"] < 0, 0).otherwise(F.get(table, acc["last"] * n + i))).alias("sum"),
        ))

    start = F.struct(F.lit(-1).alias("last"), F.lit(0).alias("sum"))
    return F.aggregate(F.split(value, ""), start, step)["sum"]


def _uncovered(added: Column, base: Column) -> Column:
    """What base spans leave of the added ones: one fold over both, by start."""
    rows = "array<struct<start:long,kind:int,end:long>>"

    def step(state: Column, x: Column) -> tuple[Column, Column]:
        """The state: how far base spans cover, and the end of the added span that is open."""
        stop = F.when(x["kind"] == 3, state["open"]).otherwise(F.least(state["open"], x["start"]))
        piece = F.array(F.struct(state["from"].alias("start"), F.lit(3).alias("kind"), stop.alias("end")))
        long_enough = stop - state["from"] >= LEAST_PIECE
        # An added span ends before the next one starts, so either kind of start may close it.
        out = F.when(long_enough, piece).otherwise(F.array().cast(rows))
        covered = F.when(x["kind"] == 3, state["covered"]).otherwise(F.greatest(state["covered"], x["end"]))
        opened = F.when(x["kind"] == 3, x["end"]).otherwise(state["open"])
        first = F.when(x["kind"] == 3, F.greatest(x["start"], covered)).otherwise(F.greatest(state["from"], x["end"]))
        return F.struct(covered.alias("covered"), opened.alias("open"), first.alias("from")), out

    zero = F.lit(0).cast("long")
    start = F.struct(zero.alias("covered"), zero.alias("open"), zero.alias("from"))
    end = F.struct(F.lit(2**62).alias("start"), F.lit(0).alias("kind"), F.lit(2**62).alias("end"))
    both = F.concat(F.array_sort(F.concat(added, base)), F.array(end)).cast(rows)
    return F.when(F.size(added) == 0, added).otherwise(fold_out(both, start, step, rows)["out"])


def scan(docs: DataFrame, weights: list[int]) -> DataFrame:
    """``docs`` with ``secrets``: an array of ``(start, kind, end)`` by start, then kind.

    ``kind`` is an index of ``KINDS``; matches of one kind never overlap.  A random string is scored whole, from
    16 characters on; where base spans cover parts of it, what is left of it is told, from
    ``LEAST_PIECE`` characters on.  A null text has no spans.  A column of this name is replaced, other columns and
    repeated rows stay.
    """
    docs = docs.drop("secrets")
    text = F.coalesce("text", F.lit(""))
    step = docs.withColumns({
        "_text": text,
        "_assign": _matches(text, ASSIGN),
        "_access": _matches(text, ACCESS),
        "_hex": _matches(text, HEX),
        "_long": _matches(text, CANDIDATE),
    })
    own = F.col("_text")
    enough = F.transform(_matches(own, ASSIGN, 2), lambda x: F.char_length(x) >= ASSIGN_LEAST)
    random = F.transform("_long", lambda x: _let(
        likelihood_ratio(x, weights),
        lambda ratio: (ratio >= LEAST_TOTAL) & (ratio >= LEAST_MEAN * (F.char_length(x) - 1)),
    ))
    step = step.withColumns({
        "_base": F.concat(
            _spans(own, ASSIGN, 0, F.col("_assign"), enough),
            _spans(own, ACCESS, 1, F.col("_access")),
            _spans(own, HEX, 2, F.col("_hex")),
        ),
        "_random": random,
    })
    added = F.when(
        F.exists("_random", lambda x: x), _spans(own, CANDIDATE, 3, F.col("_long"), F.col("_random"))
    ).otherwise(F.array().cast("array<struct<start:long,kind:int,end:long>>"))
    return step.withColumn("secrets", F.array_sort(F.concat("_base", _uncovered(added, F.col("_base"))))).drop(
        "_text", "_assign", "_access", "_hex", "_long", "_base", "_random"
    )


def written(spans: Column) -> Column:
    """Spans as text: kind:start:end, joined by commas."""
    names = F.array(*map(F.lit, KINDS))
    return F.array_join(F.transform(spans, lambda x: F.concat_ws(
        ":", F.get(names, x["kind"]), x["start"].cast("string"), x["end"].cast("string")
    )), ",")


def count_of(spans: Column, kind: str) -> Column:
    return F.size(F.filter(spans, lambda x: x["kind"] == KINDS.index(kind))).cast("long")


def masked(text: Column, spans: Column, mark: str = "<SECRET>") -> Column:
    """The text with every span, or run of overlapping spans, replaced by the mark.

    Linear in text and spans: overlapping spans are joined by a fold in chunks, and what lies between is cut
    from blocks of the text.
    """
    run = "struct<start:long,end:long>"

    def join(held: Column, x: Column) -> tuple[Column, Column]:
        apart = held.isNull() | (x["start"] >= held["end"])
        start = F.when(apart, x["start"]).otherwise(held["start"])
        end = F.when(apart, x["end"]).otherwise(F.greatest(held["end"], x["end"]))
        done = F.when(held.isNotNull() & apart, F.array(held)).otherwise(F.array().cast(f"array<{run}>"))
        return F.struct(start.alias("start"), end.alias("end")), done

    def around(found: Column) -> Column:
        runs, blocks = found["runs"], found["blocks"]
        last = F.get(runs, F.size(runs) - 1)["end"].cast("int")

        def piece(x: Column, i: Column) -> Column:
            before = F.coalesce(F.get(runs, i - 1)["end"], F.lit(0)).cast("int")
            return F.concat(cut(blocks, before, x["start"].cast("int")), F.lit(mark))

        return F.concat(F.array_join(F.transform(runs, piece), ""), cut(blocks, last, F.char_length(text)))

    folded = fold_out(spans, F.lit(None).cast(run), join, f"array<{run}>")
    runs = _let(folded, lambda x: F.concat(x["out"], F.array(x["state"])))
    whole = _let(F.struct(runs.alias("runs"), text_blocks(text).alias("blocks")), around)
    return F.when(F.size(spans) > 0, whole).otherwise(text)
