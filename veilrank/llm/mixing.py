"""Mixing sources to target weights by weighted fair queueing, in built-in functions alone.

Every source is a queue of its documents in an order shuffled by hash, then the same once more.  A queue
of target weight T serves its words at the rate T, so a piece of a document whose last word is the c-th
of its queue has the virtual finish time c / T.  Pieces of all sources are ranked by finish time and cut where
the total budget is used up.  As every queue moves at its own rate, any stretch of the mix holds the
sources in the wanted shares, and the cut leaves each within a piece of its target.

Long documents are cut into pieces of ``PIECE`` words, as a scheduler cuts long messages, so that none holds
up the others; the piece on the budget's edge gives its first words.

Running totals are worked out in two steps, totals of buckets and rows within a bucket, so that neither
a source with most rows nor the ranking of all pieces is in one task.  The buckets of the ranking are equal
stretches of virtual time: all queues together serve about the same number of words in each.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilrank.session import materialize

PIECE = 1024  # words
BUCKET_ROWS = 25_000
WEIGHTS = (5, 2, 1)
SHARE = (3, 2)  # of all words that the mix holds, as a fraction
EPOCHS = 2
HASH_BITS = 60


def words_in(text: Column) -> Column:
    """Words of a text, as a long; none for null."""
    body = F.coalesce(text, F.lit(""))
    return F.size(F.array_remove(F.split(body, r"[\x20\x09-\x0D]+"), "")).cast("long")


def shuffled_place(key: Column, text: Column) -> Column:
    """A hash of key and text below 2**60: the place of a document in its source's order."""
    digest = F.md5(F.concat(F.coalesce(key.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))).cast("binary"))
    return F.conv(F.substring(digest, 1, HASH_BITS // 4), 16, 10).cast("long")


def targets(sizes: DataFrame) -> DataFrame:
    """``(source, source_size, weight, target)`` from ``(source, source_size)``.

    Sources in the order of code points, null last, weigh 5, 2, 1, repeating.  They share one and a half times all
    words by weight.  No target is above twice its source: what is over is shared again among the rest,
    until none is above.  That end is found at once: sources are full in the order of size by weight, so
    one running total tells from where on the others share what is left.
    """
    # One row for each source, some thousands of times fewer than documents.
    by_name = Window.orderBy(F.asc_nulls_last("source"))
    weights = F.array(*(F.lit(w).cast("long") for w in WEIGHTS))
    weighed = sizes.withColumn(
        "weight", F.get(weights, F.pmod(F.row_number().over(by_name) - 1, F.lit(len(WEIGHTS))))
    ).withColumn("most", F.col("source_size") * EPOCHS)
    ranked = Window.orderBy(F.col("most") / F.col("weight"), F.asc_nulls_last("source"))
    before = ranked.rowsBetween(Window.unboundedPreceding, -1)
    from_here = ranked.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everywhere = Window.partitionBy()
    budget = F.sum("source_size").over(everywhere) * SHARE[0] / SHARE[1]
    # the words for a weight of one that are left from here on if all sources before are full
    level = (budget - F.coalesce(F.sum("most").over(before), F.lit(0))) / F.sum("weight").over(from_here)
    full = F.col("most") <= F.col("level") * F.col("weight")
    levelled = weighed.withColumn("level", level).withColumn("full", full)
    # Full sources come first, and the level of the first other one is the highest of the rest.
    common = F.max(F.when(~F.col("full"), F.col("level"))).over(everywhere)
    return levelled.select(
        "source", "source_size", "weight",
        F.when(F.col("full"), F.col("most").cast("double")).otherwise(common * F.col("weight")).alias("target"),
    )


def _queue(source: Column) -> Column:
    """A name that is never null."""
    return F.when(source.isNull(), "").otherwise(F.concat(F.lit("="), source))


def schedule(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """Every piece of every document, ranked: the mix is the pieces with ``at`` below ``budget``, by ``at``.

    ``at`` is the number of words in all pieces before.  ``queue``, ``bucket`` and ``row`` name a row of ``docs``, whose
    pieces tell ``epoch``, ``first_word``, ``words`` and, cut at the budget, ``taken``.  A document
    without words, or a null one, has an empty piece.  A null source is one of its own.  Rows that repeat key and text
    are queued one behind the other in no order of their own; as they are equal, so is the result.
    """
    narrow = materialize(docs.select(
        key, "source", words_in(F.col("text")).alias("size"),
        shuffled_place(F.col(key), F.col("text")).alias("place"),
    ).withColumn("queue", _queue(F.col("source"))), "sizes")
    rows, words = narrow.agg(F.count(F.lit(1)), F.coalesce(F.sum("size"), F.lit(0))).first()
    budget = words * SHARE[0] // SHARE[1]
    buckets = -(-rows // BUCKET_ROWS) or 1
    stretches = -(-EPOCHS * (rows + words // PIECE) // BUCKET_ROWS) or 1
    bucket = F.shiftright(F.shiftright("place", HASH_BITS - 32) * F.lit(buckets).cast("long"), 32)
    placed = narrow.withColumn("bucket", bucket)

    goals = targets(narrow.groupBy("source").agg(F.sum("size").alias("source_size")))
    goals = goals.withColumn("queue", _queue(F.col("source"))).select("queue", "source_size", "target")
    of_queue = Window.partitionBy("queue").orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        placed.groupBy("queue", "bucket").agg(F.sum("size").alias("own"))
        .select("queue", "bucket", F.coalesce(F.sum("own").over(of_queue), F.lit(0)).alias("offset"))
        .join(goals, "queue")
    )
    line = Window.partitionBy("queue", "bucket").orderBy("place", key, "size")
    queued = placed.withColumns({
        "row": F.row_number().over(line),
        "within": F.sum("size").over(line.rowsBetween(Window.unboundedPreceding, Window.currentRow)),
    }).join(offsets, ["queue", "bucket"]).withColumn("start", F.col("offset") + F.col("within") - F.col("size"))

    last, zero = F.greatest(F.col("size") - 1, F.lit(0).cast("long")), F.lit(0).cast("long")
    pieces = (
        queued.withColumn("epoch", F.explode(F.array(*map(F.lit, range(EPOCHS)))))
        .withColumn("first_word", F.explode(F.sequence(zero, last, F.lit(PIECE).cast("long"))))
        .withColumns({
            "words": F.least(F.lit(PIECE).cast("long"), F.col("size") - F.col("first_word")),
            "begin": F.col("epoch") * F.col("source_size") + F.col("start") + F.col("first_word"),
        })
    )
    some = F.col("words") > 0
    finish = F.when(some, (F.col("begin") + F.col("words")) / F.col("target")).otherwise(F.lit(0.0))
    # An empty piece changes nothing wherever it stands, so it need not stand with all others.
    stretch = F.when(some, F.floor(F.col("finish") * stretches)).otherwise(F.pmod("place", F.lit(stretches)))
    pieces = pieces.withColumn("finish", finish).withColumn("stretch", stretch)
    # One row for each stretch, some ten thousand times fewer than pieces.
    in_turn = Window.orderBy("stretch").rowsBetween(Window.unboundedPreceding, -1)
    turns = pieces.groupBy("stretch").agg(F.sum("words").alias("own")).select(
        "stretch", F.coalesce(F.sum("own").over(in_turn), F.lit(0)).alias("served")
    )
    ranked = Window.partitionBy("stretch").orderBy("finish", "queue", "begin")
    before = F.coalesce(F.sum("words").over(ranked.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    out = pieces.withColumn("before", before).join(turns, "stretch")
    out = out.withColumns({"at": F.col("served") + F.col("before"), "budget": F.lit(budget).cast("long")})
    left = F.col("budget") - F.col("at")
    return out.select(
        key, "source", "size", "source_size", "target", "queue", "bucket", "row", "epoch", "first_word",
        "words", "finish", "at", "budget",
        F.greatest(F.lit(0).cast("long"), F.least("words", left)).alias("taken"),
    )


def mix(docs: DataFrame, key: str = "doc_id") -> DataFrame:
    """``(key, source, size, source_size, target, taken)``: the words of each row that the mix takes.

    ``taken`` counts repeats and is at most twice ``size``.  Columns are those of ``schedule``; no rows give none.
    """
    return schedule(docs, key).groupBy("queue", "bucket", "row", key, "source", "size").agg(
        F.max("source_size").alias("source_size"), F.max("target").alias("target"),
        F.sum("taken").alias("taken"),
    ).select(key, "source", "size", "source_size", "target", "taken")
