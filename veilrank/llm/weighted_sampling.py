"""Document fingerprints by consistent weighted sampling, in built-in functions alone.

A document is a bag of lower-cased words, weighted by their counts.  For sample k every word draws
r and c from Gamma(2, 1) and b from the unit interval, all from a hash of the word and k.  A word of
weight w stands for the step t = floor(ln w / r + b), and the word of least
``ln c - r (t - b + 1)`` is the sample, together with its step.  Two documents agree on a sample with a
probability of their generalised Jaccard similarity: the sum of the lesser weights over the sum of the
greater.

Texts move once, to partitions of whole documents; word counts and samples are grouped where they
are.  A long document only has more rows there, and equal documents are not grouped at all.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from veilrank.session import materialize

SAMPLES = 64  # of a fingerprint
#: Words that can come below this many times the expected least rank of a text are drawn first.
REACH = 10.0
NONE = 0xFFFFFFFF  # the sample of a text without words
_LOW = -(2**63)
#: Rows of one bucket of neighbours, at most about so many, and the most cells of the id histogram.
BUCKET_ROWS, CELLS = 4096, 1000
BROADCAST_BUCKETS = 1_000_000  # of 24 bytes


def _unit(bits: Column, from_: int, width: int) -> Column:
    """A number in (0, 1] from some bits of a hash."""
    part = F.shiftrightunsigned(bits, from_).bitwiseAND(F.lit((1 << width) - 1))
    return (part.cast("double") + 1.0) * F.lit(2.0**-width)


def _keys(tokens: DataFrame, sides: int) -> DataFrame:
    """For each side the key of a word in its sample: least first, null where the word has no weight.

    ``tokens`` has the sample's hash of the word as ``one`` and log weights ``w0``, ``w1`` and so on.
    Each step is a projection of its own, so that what several expressions need is worked out once.
    """
    below_one = 1 - 2.0**-50  # so that no logarithm is zero
    drawn = tokens.withColumn("two", F.xxhash64("one", F.lit(1))).withColumns({
        "r": -F.log(_unit(F.col("one"), 0, 21) * _unit(F.col("one"), 21, 21) * below_one),
        "c": F.log(-F.log(_unit(F.col("one"), 42, 22) * _unit(F.col("two"), 0, 22) * below_one)),
        "b": _unit(F.col("two"), 22, 22),
    }).withColumns({f"t{i}": F.floor(F.col(f"w{i}") / F.col("r") + F.col("b")) for i in range(sides)})
    for i in range(sides):
        rank = F.col("c") - F.col("r") * (F.col(f"t{i}") - F.col("b") + 1)
        # 39 bits of the rank, which is between -81 and 4, before 24 bits that name the word and its step
        name = F.xxhash64("two", f"t{i}").bitwiseAND(F.lit(0xFFFFFF))
        key = F.shiftleft(((rank + 128) * 2.0**31).cast("long"), 24).bitwiseOR(name)
        drawn = drawn.withColumn(f"key{i}", F.when(F.col(f"w{i}").isNotNull(), key))
    return drawn


def _sampled(rows: DataFrame, keys: list[str], texts: list[str], carried: Column, reach: float) -> DataFrame:
    """``keys``, ``carried``, samples of each text, and ``sure``: whether no other word can be a sample.

    The exponential of the least rank of a text of n words is exponential itself, of rate n; so it is
    below ``reach / n`` but for odds of exp(-reach).  That of a word of weight w is at least
    ``u (1 - v1 + 1 - v2) / w``, where ``-ln u`` is its r and ``-ln v1 - ln v2`` its c.  Words for which this
    is above ``reach / n`` are refused before any logarithm, most of them by v1 alone; a least rank below the
    bound is then the least of all words.
    """
    sides = len(texts)
    split = rows.select(
        *keys, carried.alias("carried"),
        *(F.split(F.lower(F.coalesce(t, F.lit(""))), r"\s+").alias(f"words{i}") for i, t in enumerate(texts)),
        *(F.coalesce(F.col(t).rlike(r"\S"), F.lit(False)).alias(f"any{i}") for i, t in enumerate(texts)),
    )
    sizes = [f"size{i}" for i in range(sides)]
    split = split.withColumns({
        f"size{i}": F.when(F.col(f"any{i}"), F.size(f"words{i}")).otherwise(0) for i in range(sides)
    })
    sets = F.array(*(
        F.struct(F.lit(i).alias("side"), w.alias("words"))
        for i, w in enumerate([*(F.col(f"words{i}") for i in range(sides)), F.array("carried")])
    ))
    tokens = split.select(*keys, *sizes, F.inline(sets)).select(*keys, *sizes, "side", F.explode("words").alias("word"))
    tokens = tokens.where("word <> '' OR side = " + str(sides))
    marked = F.col("side") == sides
    counted = tokens.groupBy(*keys, *sizes, marked.alias("mark"), "word").agg(
        *(F.count_if(F.col("side") == i).alias(f"n{i}") for i in range(sides))
    )
    own = {i: ~F.col("mark") & (F.col(f"n{i}") > 0) for i in range(sides)}
    h = counted.select(
        *keys, *sizes, "mark",
        F.when(F.col("mark"), F.col("word")).alias("carried"),
        F.xxhash64("word").alias("h"),
        *(F.when(own[i], F.log(f"n{i}")).alias(f"w{i}") for i in range(sides)),
        F.when(F.col("mark"), F.lit(2.0)).otherwise(F.greatest(F.lit(0.0), *(
            F.when(own[i], F.col(f"n{i}") * F.lit(reach) / F.col(f"size{i}")) for i in range(sides)
        ))).alias("most"),
    )
    hashes = F.when(F.col("mark"), F.array(F.lit(0).cast("long"))).otherwise(
        F.array(*(F.xxhash64("h", F.lit(i)) for i in range(SAMPLES)))
    )
    one = F.col("one")
    u = _unit(one, 0, 21) * _unit(one, 21, 21)
    v1, v2 = _unit(one, 42, 22), _unit(F.xxhash64(one, F.lit(1)), 0, 22)
    near = h.select(
        *keys, *sizes, "mark", "carried", "most", *(f"w{i}" for i in range(sides)),
        F.posexplode(hashes).alias("sample", "one"),
    ).where((u * (1.0 - v1) <= F.col("most")) & (u * (2.0 - v1 - v2) <= F.col("most")))
    lane = _keys(near, sides).groupBy(
        *keys, F.when(F.col("mark"), -1).otherwise(F.col("sample")).alias("sample"), *sizes, "carried"
    ).agg(*(F.min(f"key{i}").alias(f"key{i}") for i in range(sides)))
    keyed = [f"key{i}" for i in range(sides)]
    whole = lane.groupBy(*keys).agg(
        F.max("carried").alias("carried"), *(F.max(s).alias(s) for s in sizes),
        *(F.count(k).alias(f"count{i}") for i, k in enumerate(keyed)),
        *(F.max(k).alias(f"max{i}") for i, k in enumerate(keyed)),
        F.sort_array(F.collect_list(F.struct("sample", *keyed))).alias("parts"),
    )
    sure = F.lit(True)
    for i in range(sides):
        # two units of the rank's last bit make up for its rounding
        rank = (F.shiftright(f"max{i}", 24) + 2) / F.lit(2.0**31) - 128
        size = F.col(f"size{i}")
        sure = sure & ((size == 0) | (
            (F.col(f"count{i}") == SAMPLES) & (rank < F.log(F.lit(reach) / F.greatest(size, F.lit(1))))
        ))
    none = F.array_repeat(F.lit(NONE), SAMPLES)

    def samples(side: int) -> Column:
        # the low half of a key: the name, and the rank's last bits
        names = F.transform(
            F.slice("parts", 2, SAMPLES),
            lambda p: F.coalesce(p[f"key{side}"].bitwiseAND(F.lit(NONE)), F.lit(NONE)),
        )
        return F.when(F.col(f"size{side}") == 0, none).otherwise(names).alias(f"samples{side}")

    return whole.select(
        *keys, "carried", F.coalesce(sure, F.lit(False)).alias("sure"), *map(samples, range(sides))
    )


def sample(rows: DataFrame, keys: list[str], texts: list[str], carried: Column) -> DataFrame:
    """``keys``, ``carried`` and for each text column an array of ``SAMPLES`` samples.

    ``rows`` has one row for each value of ``keys`` and should lie hashed by the first of them; then
    words do not move.  ``carried`` is any text that goes along with the row.  Samples are written once, in the
    shared folder; rows with a sample that is not sure to be the least of all words, one in hundreds, are
    sampled again with every word.
    """
    found = materialize(_sampled(rows, keys, texts, carried, REACH), "samples")
    unsure = found.where("NOT sure").select(*(F.col(k).alias(f"_{k}") for k in keys))
    same = [rows[k].eqNullSafe(unsure[f"_{k}"]) for k in keys]
    again = _sampled(rows.join(unsure, same, "left_semi"), keys, texts, carried, float("inf"))
    return found.where("sure").unionByName(again).drop("sure")


def written(samples: Column) -> Column:
    """Eight hexadecimal digits for each sample."""
    return F.array_join(F.transform(
        samples, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")
    ), "")


def likeness(a: Column, b: Column) -> Column:
    """The share of equal samples."""
    equal = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda x: x)
    return F.size(equal) / F.lit(float(SAMPLES))


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``(doc_id, fingerprint, samples)`` for each row; a null text is an empty one.

    Rows that repeat the key are told apart by their text; rows equal in both are one.
    """
    own = docs.select(key, F.coalesce(text, F.lit("")).alias("body")).distinct()
    rows = own.select(key, F.xxhash64("body").alias("text_hash"), "body")
    found = sample(rows.repartition(key), [key, "text_hash"], ["body"], F.lit("-"))
    return found.select(key, written(F.col("samples0")).alias("fingerprint"), F.col("samples0").alias("samples"))


def neighbours(docs: DataFrame) -> DataFrame:
    """Every row of ``docs(doc_id, text)`` in buckets of neighbours, so that each meets the next one.

    Rows stand in descending order of doc_id (nulls last), then by text; the first follows the last.
    Buckets are ranges of the key from an equi-depth histogram of all rows, refined evenly
    within its cells.  The first row of the following bucket comes into a bucket as a guest.
    ``(bucket, pos, guest, doc_id, text, next)``.
    """
    key = F.coalesce(F.col("doc_id").cast("long"), F.lit(_LOW + 1))
    keyed = docs.select(key.alias("key"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    n, low, high = keyed.agg(F.count(F.lit(1)), F.min("key"), F.max("key")).first()
    cells = max(1, min(CELLS, n // 64))
    inner = max(1, -(-n // (cells * BUCKET_ROWS)))
    splits: list[int] = []
    if cells > 1:
        splits = keyed.agg(
            F.percentile_approx("key", [i / cells for i in range(1, cells)], 10 * CELLS)
        ).first()[0]
    edges = sorted({*splits} - {low})
    ends = F.split(F.lit(",".join(map(str, [low or 0, *edges, (high or 0) + 1]))), ",").cast("array<long>")
    cell = F.size(F.filter(ends, lambda e: e <= F.col("key"))) - 1
    part = F.col("key").cast("decimal(20,0)") - F.get(ends, cell)
    width = F.get(ends, cell + 1).cast("decimal(20,0)") - F.get(ends, cell)
    bucket = cell.cast("long") * inner + (
        F.floor(part * inner / width).cast("long") if inner > 1 else F.lit(0)
    )
    placed = keyed.withColumn("bucket", bucket)
    tops = placed.groupBy("bucket").agg(F.max("key").alias("top"))
    # One row for a bucket, thousands of times fewer than documents.
    order = Window.orderBy("bucket")
    all_ = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    hosts = tops.select(
        F.coalesce(F.lead("bucket").over(order), F.min("bucket").over(all_)).alias("host"), "top"
    )
    if cells * inner <= BROADCAST_BUCKETS:
        hosts = F.broadcast(hosts)
    met = placed.join(hosts, placed.key == hosts.top, "left").select(
        "key", "doc_id", "text",
        F.inline(F.when(
            F.col("host").isNull(), F.array(F.struct(F.col("bucket"), F.lit(False).alias("guest")))
        ).otherwise(F.array(
            F.struct(F.col("bucket"), F.lit(False).alias("guest")),
            F.struct(F.col("host").alias("bucket"), F.lit(True).alias("guest")),
        ))),
    )
    line = Window.partitionBy("bucket").orderBy("guest", F.desc("key"), "text")
    return met.withColumns({
        "pos": F.row_number().over(line), "next": F.lead("text").over(line)
    }).select("bucket", "pos", "guest", "doc_id", "text", "next")


def with_edits(docs: DataFrame) -> DataFrame:
    """Each row's fingerprint, that of its edited text, and their likenesses.

    The edited text has the last third of the text, rounded down, replaced by as many characters of
    the following row's text.  A row that is alone follows itself.
    """
    rows = neighbours(docs)
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    edited = F.concat(
        F.substring("text", F.lit(1), n - third),
        F.substring(F.coalesce("next", F.lit("")), F.lit(1), third),
    )
    rows = rows.withColumns({"n": n, "edited": edited})
    carried = F.concat_ws(
        ":", F.coalesce(F.col("doc_id").cast("string"), F.lit("")), "n", F.col("guest").cast("string"),
        F.sha2("edited", 256),
    )
    found = sample(rows, ["bucket", "pos"], ["text", "edited"], carried)
    line = Window.partitionBy("bucket").orderBy("pos")
    told = F.split("carried", ":")
    return found.withColumns({"told": told, "following": F.lead("samples0").over(line)}).where(
        F.col("told")[2] == "false"
    ).select(
        F.when(F.col("told")[0] != "", F.col("told")[0].cast("long")).alias("doc_id"),
        F.col("told")[1].cast("long").alias("n_chars"),
        F.col("told")[3].alias("edited_sha256"),
        written(F.col("samples0")).alias("fingerprint"),
        written(F.col("samples1")).alias("edited_fingerprint"),
        likeness(F.col("samples0"), F.col("samples1")).alias("near_edited"),
        likeness(F.col("samples0"), F.col("following")).alias("near_next"),
    )
