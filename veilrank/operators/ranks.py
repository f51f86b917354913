"""Exact global ranks and cuts in hash order, without a one-task sort.

Keys are ordered by ``md5(seed:key)``.  The first digits of the hash split the order into
buckets of equal expected size whatever the keys look like, so a rank is the rows in earlier
buckets plus the rank inside the own bucket.  Nothing depends on partitioning: a lost and
recomputed task gives the same ranks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_DIGITS = 4  # 16**4 = 65536 buckets: also the most rows the offsets table can have
_BUCKET = "_bucket"
_HASH = "_hash"


def hash_order(key: Column, seed: int) -> Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))


def _keyed(df: DataFrame, key: str, seed: int) -> DataFrame:
    hashed = df.withColumn(_HASH, hash_order(F.col(key), seed))
    return hashed.withColumn(_BUCKET, F.substring(_HASH, 1, _DIGITS))


def _rows_before(window: Window) -> Column:
    earlier = F.sum("_n").over(window.rowsBetween(Window.unboundedPreceding, -1))
    return F.coalesce(earlier, F.lit(0).cast("long"))


def hash_rank(df: DataFrame, key: str, seed: int, output: str) -> DataFrame:
    """Add the row's rank (from 1) in hash order of a unique key."""
    keyed = _keyed(df, key, seed)
    counts = keyed.groupBy(_BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    offsets = counts.select(
        _BUCKET, _rows_before(Window.orderBy(_BUCKET)).alias("_before")
    )
    inside = F.row_number().over(Window.partitionBy(_BUCKET).orderBy(_HASH, key))
    return (
        keyed.withColumn("_inside", inside)
        .join(F.broadcast(offsets), _BUCKET)
        .withColumn(output, F.col("_before") + F.col("_inside"))
        .drop(_BUCKET, _HASH, "_inside", "_before")
    )


def grouped_rank(df: DataFrame, group: str, key: str, seed: int, output: str) -> DataFrame:
    """Add the row's rank (from 1) in the hash order of ``group``, then of the key.

    A group may hold most of the rows: it is split by hash like everything else.  The groups
    themselves are ordered by hash buckets, so there may be as many of them as rows.
    """
    keyed = _keyed(df, key, seed)
    counts = keyed.groupBy(group, _BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    sizes = counts.groupBy(group).agg(F.sum("_n").alias("_n"))
    placed = _keyed(sizes, group, seed)
    whole = placed.groupBy(_BUCKET).agg(F.sum("_n").alias("_n"))
    first = whole.select(_BUCKET, _rows_before(Window.orderBy(_BUCKET)).alias("_first"))
    earlier = _rows_before(Window.partitionBy(_BUCKET).orderBy(_HASH, group))
    starts = (
        placed.withColumn("_earlier", earlier)
        .join(F.broadcast(first), _BUCKET)  # at most 65,536 rows
        .select(group, (F.col("_first") + F.col("_earlier")).alias("_start"))
    )
    within = counts.withColumn(
        "_before", _rows_before(Window.partitionBy(group).orderBy(_BUCKET))
    ).drop("_n")
    offsets = within.join(starts, group)
    inside = F.row_number().over(Window.partitionBy(group, _BUCKET).orderBy(_HASH, key))
    return (
        keyed.withColumn("_inside", inside)
        .join(offsets, [group, _BUCKET])
        .withColumn(output, F.col("_start") + F.col("_before") + F.col("_inside"))
        .drop(_BUCKET, _HASH, "_inside", "_before", "_start")
    )


def hash_cuts(df: DataFrame, group: str, key: str, seed: int, targets: list[Column]) -> DataFrame:
    """Per group, the ``(hash, key)`` of the row whose rank equals each target.

    ``targets`` are expressions over ``n_group``, the rows of the group.  Rows up to the i-th
    target are those with ``(hash, key) <= cut_i``; a group has no cut for a target of 0.
    Counting buckets and ranking the few rows of the buckets the targets fall in is all the
    work: the table itself is never shuffled or sorted.
    """
    keyed = _keyed(df.select(group, key), key, seed)
    counts = keyed.groupBy(group, _BUCKET).agg(F.count(F.lit(1)).alias("_n"))
    per_group = Window.partitionBy(group)
    placed = counts.withColumn("_before", _rows_before(per_group.orderBy(_BUCKET))).withColumn(
        "n_group", F.sum("_n").over(per_group)
    )
    wanted = F.array(
        *[
            F.struct(F.lit(i).alias("cut"), t.cast("long").alias("target"))
            for i, t in enumerate(targets)
        ]
    )
    straddled = (
        placed.select(group, _BUCKET, "_n", "_before", F.inline(wanted))
        .where((F.col("_before") < F.col("target")))
        .where(F.col("target") <= F.col("_before") + F.col("_n"))
        .select(group, _BUCKET, "cut", (F.col("target") - F.col("_before")).alias("_nth"))
    )
    # One bucket per group and target.
    rank = F.row_number().over(Window.partitionBy(group, _BUCKET, "cut").orderBy(_HASH, key))
    hits = (
        keyed.join(F.broadcast(straddled), [group, _BUCKET])
        .withColumn("_rank", rank)
        .where(F.col("_rank") == F.col("_nth"))
    )
    at = F.struct(_HASH, key)
    return hits.groupBy(group).agg(
        *[F.max(F.when(F.col("cut") == i, at)).alias(f"cut_{i}") for i in range(len(targets))]
    )


def up_to(cut: Column, key: Column, seed: int) -> Column:
    """Whether a row's place in hash order is at or before a cut; false without a cut."""
    here = F.struct(hash_order(key, seed).alias(_HASH), key)
    return F.coalesce(here <= cut, F.lit(False))


def sample_n(df: DataFrame, n: int, key: str = "doc_id", seed: int = 42) -> DataFrame:
    """Exactly ``min(n, rows)`` rows, the first in hash order of a unique key."""
    if n < 0:
        raise ValueError("n must not be negative")
    whole = df.select(F.lit(0).alias("_all"), key)
    cuts = hash_cuts(whole, "_all", key, seed, [F.least(F.lit(n).cast("long"), F.col("n_group"))])
    cut = cuts.agg(F.first("cut_0").alias("cut")).scalar()
    return df.where(up_to(cut, F.col(key), seed))
