"""How filters act on each other: which document goes at which step of every order of the filters.

A document that fails some of five filters survives a subset of them if the subset holds none of those
it fails.  Its survival word has one bit for each of the 32 subsets: the conjunction, over the filters
it fails, of the truth table of "the subset does not hold this filter".  The words of a part are counted
bit by bit with carry-save adders, which gives the survivors of every subset, for all documents and
for those of a label.  Whatever is asked of any order of the filters is a difference of these numbers, so
a document is looked at once and not once for every order.

The words are made and counted in tasks; what is added up over tasks is 32 numbers for a part and a label.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from itertools import permutations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from veilrank.session import materialize

MOST_FILTERS = 5
_FULL = (1 << 32) - 1
#: Truth tables over all subsets: bit s of table f tells whether subset s holds filter f.
HOLDS = [sum(1 << s for s in range(32) if s >> f & 1) for f in range(MOST_FILTERS)]
_ADDER = 16  # words that one tree of carry-save adders takes
_HELD_ROWS = 1 << 20  # words kept in a task before they are counted


def survival_word(fails: Sequence[Column]) -> Column:
    """The survival word of at most five filters as a whole number below 2**32.

    Bit s is set if the document fails no filter of subset s; filter i is bit i of s.
    """
    if len(fails) > MOST_FILTERS:
        raise ValueError(f"at most {MOST_FILTERS} filters make a word")
    word = F.lit(_FULL)
    for table, fail in zip(HOLDS, fails):
        word = word.bitwiseAND(F.when(fail, F.lit(_FULL ^ table)).otherwise(F.lit(_FULL)))
    return word


def _add(a: np.ndarray, b: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A full adder for each bit: sum and carry."""
    half = a ^ b
    return half ^ c, (a & b) | (half & c)


def positional_popcounts(words: np.ndarray) -> np.ndarray:
    """How many of the 32-bit words have each bit set.

    Sixteen words at a time go through a tree of carry-save adders; only the five words that come out,
    of weight 1 to 16, are taken apart into bits.
    """
    lanes = -(-len(words) // _ADDER)
    rows = np.zeros(lanes * _ADDER, np.uint32)
    rows[: len(words)] = words
    level = list(rows.reshape(_ADDER, lanes))
    zero = np.zeros(lanes, np.uint32)
    total = np.zeros(32, np.int64)
    weight = 1
    while level:
        carries: list[np.ndarray] = []
        one = level[0]
        for i in range(1, len(level), 2):
            one, carry = _add(one, level[i], level[i + 1] if i + 1 < len(level) else zero)
            carries.append(carry)
        bits = np.unpackbits(one.astype("<u4").view(np.uint8).reshape(-1, 4), axis=1, bitorder="little")
        total += weight * bits.sum(0, dtype=np.int64)
        level, weight = carries, weight * 2
    return total


def subset_survivors(words: DataFrame, part: str, word: str, labels: Sequence[str]) -> DataFrame:
    """``(part, label, subset, survivors)``: all 32 subsets for label ``""`` (all documents) and each label.

    ``labels`` are columns that tell by true whether the document has the label.
    """
    names = ["", *labels]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, list[tuple]] = {}
        rows = 0

        def counted() -> pa.RecordBatch:
            out: list[tuple] = []
            for key, pieces in held.items():
                all_words = np.concatenate([p[0] for p in pieces])
                for i, name in enumerate(names):
                    own = all_words if i == 0 else all_words[np.concatenate([p[i] for p in pieces])]
                    out += [(key, name, s, n) for s, n in enumerate(positional_popcounts(own).tolist())]
            held.clear()
            return pa.RecordBatch.from_pylist(
                [dict(zip(("part", "label", "subset", "survivors"), r)) for r in out],
                schema=pa.schema([("part", pa.string()), ("label", pa.string()),
                                  ("subset", pa.int32()), ("survivors", pa.int64())]),
            )

        for batch in batches:
            keys = batch.column(0).dictionary_encode()
            codes = keys.indices.to_numpy()
            order = np.argsort(codes, kind="stable")
            own = batch.column(1).to_numpy()[order].astype(np.uint32)
            flags = [batch.column(i + 2).to_numpy(zero_copy_only=False).astype(bool)[order] for i in range(len(labels))]
            ends = np.searchsorted(codes[order], np.arange(len(keys.dictionary) + 1))
            for i, key in enumerate(keys.dictionary.to_pylist()):
                cut = slice(ends[i], ends[i + 1])
                held.setdefault(key, []).append((own[cut], *(f[cut] for f in flags)))
            rows += batch.num_rows
            if rows >= _HELD_ROWS:
                yield counted()
                rows = 0
        if held:
            yield counted()

    parts = words.select(part, word, *(F.coalesce(x, F.lit(False)).alias(x) for x in labels)).mapInArrow(
        run, "part string, label string, subset int, survivors long"
    )
    return parts.groupBy("part", "label", "subset").agg(F.sum("survivors").alias("survivors"))


def audit(survivors: DataFrame, filters: str, labels: Sequence[str] = ()) -> DataFrame:
    """One row for each part, order of the filters and step, from ``subset_survivors``.

    ``filters`` has one letter for each filter.  ``kept``, ``removed``, ``redundant`` (fails, but was removed
    earlier), ``unique_fails`` (fails this filter alone), ``shapley`` (``removed`` of the filter summed
    over all orders) and ``<label>_lost`` for each label.
    """
    n = len(filters)
    every = (1 << n) - 1
    steps = [  # a fixed table: the order, the step, the filter's bit and those applied before it
        ("".join(filters[i] for i in order), at + 1, 1 << f, sum(1 << i for i in order[:at]))
        for order in permutations(range(n)) for at, f in enumerate(order)
    ]
    table = F.array(*(
        F.struct(F.lit(o).alias("filter_order"), F.lit(s).alias("step"), F.lit(b).alias("bit"), F.lit(p).alias("before"))
        for o, s, b, p in steps
    ))
    names = ["", *labels]
    arrays = survivors.groupBy("part").agg(*(
        F.sort_array(F.collect_list(F.when(F.col("label") == name, F.struct("subset", "survivors")))).alias(f"_{i}")
        for i, name in enumerate(names)
    ))

    def left(i: int, subset: Column) -> Column:
        return F.get(F.col(f"_{i}"), subset)["survivors"]

    def removed(i: int, before: Column, bit: Column) -> Column:
        return left(i, before) - left(i, before.bitwiseOR(bit))

    bit, before = F.col("bit"), F.col("before")
    # The orders in which exactly ``before`` comes first and the filter next.
    weights = {}
    for _, _, b, p in steps:
        weights[b, p] = weights.get((b, p), 0) + 1
    shares = F.create_map(*(
        x for f in range(n) for x in (
            F.lit(1 << f),
            sum((removed(0, F.lit(p), F.lit(b)) * w for (b, p), w in weights.items() if b == 1 << f), F.lit(0)),
        )
    ))
    by_filter = arrays.withColumn("_shares", shares)
    return by_filter.select("*", F.inline(table)).select(
        "part", "filter_order", "step",
        left(0, before.bitwiseOR(bit)).alias("kept"),
        removed(0, before, bit).alias("removed"),
        (removed(0, F.lit(0), bit) - removed(0, before, bit)).alias("redundant"),
        removed(0, F.lit(every) - bit, bit).alias("unique_fails"),
        *(removed(i + 1, before, bit).alias(f"{name}_lost") for i, name in enumerate(labels)),
        F.col("_shares")[bit].cast("long").alias("shapley"),
    )


#: The five filters, in the order of their bits.
FILTERS = "ABCDE"
_BLANK = r"[\x20\x09-\x0D]+"


def text_fails(text: Column) -> list[Column]:
    """Filters A to D of a text that is not null: too few words, too few distinct ones, too many
    capitals, or a mark character."""
    words = F.array_remove(F.split(text, _BLANK), "")
    n = F.size(words)
    return [
        n < 50,
        F.size(F.array_distinct(words)) * F.lit(100) < n * 65,
        (F.char_length(text) - F.char_length(F.regexp_replace(text, "[A-Z]+", ""))).cast("long") * 100
        > F.char_length(text).cast("long") * 5,
        text.rlike(r"[#$%&*|]"),
    ]


def document_words(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """``(part, word, good, toxic)`` for every document.

    Filter E: the text is that of a smaller doc_id, anywhere in the table.  A null doc_id has no smaller one and is
    none; rows that repeat doc_id and text pass alike.  A null text is empty, a null source the part
    ``""``.  A document is good, or toxic, if any row of ``labels`` for its doc_id says 1.

    Equal texts are found by the SHA-256 of the text: the first id of each is an aggregate, and it comes back by
    digest and id together, so that the copies of one text are not gathered anywhere.
    """
    text = F.coalesce("text", F.lit(""))
    narrow = materialize(
        docs.select("doc_id", F.coalesce("source", F.lit("")).alias("part"), text.alias("body")).select(
            "doc_id", "part", F.unhex(F.sha2("body", 256)).alias("digest"),
            *(f.alias(f"fail{i}") for i, f in enumerate(text_fails(F.col("body")))),
        ), "filters",
    )
    first = narrow.where("doc_id IS NOT NULL").groupBy("digest").agg(
        F.min("doc_id").alias("doc_id"), F.lit(True).alias("first")
    )
    known = labels.where("doc_id IS NOT NULL").groupBy("doc_id").agg(
        F.max(F.col("quality") == 1).alias("good"), F.max(F.col("toxic") == 1).alias("toxic")
    )
    copy = F.col("first").isNull() & F.col("doc_id").isNotNull()
    fails = [*(F.col(f"fail{i}") for i in range(4)), copy]
    met = narrow.join(first, ["digest", "doc_id"], "left").join(known, "doc_id", "left")
    return met.select(
        "part", survival_word(fails).alias("word"),
        F.coalesce("good", F.lit(False)).alias("good"), F.coalesce("toxic", F.lit(False)).alias("toxic"),
    )


def audit_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The audit of the five filters over ``documents``, by source; an empty table has no parts."""
    words = document_words(docs, labels)
    return audit(subset_survivors(words, "part", "word", ["good", "toxic"]), FILTERS, ["good", "toxic"])
