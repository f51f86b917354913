"""Array expressions whose cost grows with the array and not with its square.

A fold that appends to its state copies all of it at every step.  Here a fold appends to a short array,
one for every ``CHUNK`` elements, and those are joined once a chunk.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

CHUNK = 256
BLOCK = 4096  # characters


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body(value)`` with the value worked out once.

    The end of a fold over nothing: an element of a transformed array would be copied whole, and its
    type, which merges those of all rules, worked out anew for every row.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, body)


def fold_out(
    values: Column, state: Column, step: Callable[[Column, Column], tuple[Column, Column]], out: str
) -> Column:
    """A fold that gives out rows: a struct of ``state``, the last one, and ``out``, an array.

    ``step(state, value)`` returns the next state and an array of the rows given out there, of none or few
    elements; ``out`` is the type of that array.
    """
    nothing = F.array().cast(out)
    start = F.struct(state.alias("state"), nothing.alias("out"))

    def folded(values: Column) -> Column:
        chunks = F.sequence(F.lit(0), F.floor((F.size(values) - 1) / CHUNK).cast("int"))
        whole = F.aggregate(chunks, start, lambda acc, chunk: chunk_step(values, acc, chunk))
        return F.when(F.size(values) == 0, start).otherwise(whole)

    def chunk_step(values: Column, acc: Column, chunk: Column) -> Column:
        def one(inner: Column, value: Column) -> Column:
            following, rows = step(inner["state"], value)
            return F.struct(following.alias("state"), F.concat(inner["out"], rows).alias("out"))

        here = F.struct(acc["state"].alias("state"), nothing.alias("out"))
        part = F.aggregate(F.slice(values, chunk * CHUNK + 1, CHUNK), here, one)
        return let(part, lambda x: F.struct(
            x["state"].alias("state"), F.concat(acc["out"], x["out"]).alias("out")
        ))

    return let(values, folded)


def running_totals(lengths: Column) -> Column:
    """For every number of an ``array<int>`` the sum of those before it."""
    zero = F.lit(0)
    return fold_out(lengths, zero, lambda total, n: (total + n, F.array(total)), "array<int>")["out"]


def text_blocks(text: Column) -> Column:
    """The text in blocks of ``BLOCK`` characters, found in one pass: what ``cut`` takes."""
    many = F.regexp_extract_all(text, F.lit(f"(?s).{{1,{BLOCK}}}"), F.lit(0))
    return F.when(F.char_length(text) <= BLOCK, F.array(text)).otherwise(many)


def cut(blocks: Column, start: Column, end: Column) -> Column:
    """The characters from ``start`` up to ``end``, counted from 0, of a text in blocks.

    A substring of a whole text is looked for from its first character; here only its own blocks are.
    """
    first = F.floor(start / BLOCK).cast("int")
    last = F.floor((end - 1) / BLOCK).cast("int")
    inside = start - first * BLOCK
    one = F.substring(F.get(blocks, first), inside + 1, end - start)
    many = F.concat(
        F.substring(F.get(blocks, first), inside + 1, F.lit(BLOCK)),
        F.array_join(F.slice(blocks, first + 2, last - first - 1), ""),
        F.substring(F.get(blocks, last), F.lit(1), end - last * BLOCK),
    )
    return F.when(end <= start, "").when(first == last, one).otherwise(many)
