"""Shards of near equal bytes by histogram sort.

Rows are ordered by a hash of the text, then by key.  Bytes below candidate boundaries are counted
exactly over all partitions, a round at a time, and the candidates close in on each splitter until
it is within tolerance of its share or no row lies between its candidates.  A boundary between two
texts is tried first, so that equal texts stay together; only a splitter that falls into a group
too large for the tolerance goes on by key and cuts the group.  Splitters known, rows move once.

What the driver holds and does grows with the number of shards and not with the bytes.  Within a shard rows are
dealt to parts of a bounded number of bytes by hash, and counted once by part, which numbers the slots.
"""

from __future__ import annotations

from bisect import bisect_left, bisect_right
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

from veilrank.session import materialize

OVERHEAD = 16  # bytes of a row besides its text
TASK_BYTES = 256 << 20
PROBES = 32  # candidates for a splitter in a round
TOLERANCE = 0.005  # of a shard's share
_LOW, _HIGH = -(2**63), 2**63 - 1


def _below(rows: DataFrame, probes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Exact bytes and rows below each probe ``(hash, key)``; probes are sorted.

    A task adds up its rows between neighbouring probes, one small table a task.
    """
    first, last = probes[:, 0].copy(), probes[:, 1].copy()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size, count = np.zeros(len(first) + 1), np.zeros(len(first) + 1)
        for batch in batches:
            at = position(first, last, batch.column(0).to_numpy(), batch.column(1).to_numpy())
            size += np.bincount(at, batch.column(2).to_numpy(), len(first) + 1)
            count += np.bincount(at, minlength=len(first) + 1)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(size))), pa.array(size.astype(np.int64)), pa.array(count.astype(np.int64))],
            names=["at", "size", "n"],
        )

    sums = (
        rows.select("hash", "key", "size").mapInArrow(run, "at long, size long, n long")
        .groupBy("at").agg(F.sum("size").alias("size"), F.sum("n").alias("n"))
    )
    size, count = np.zeros(len(first) + 1, np.int64), np.zeros(len(first) + 1, np.int64)
    for at, s, n in sums.collect():  # one row for each probe
        size[at], count[at] = s, n
    return np.cumsum(size), np.cumsum(count)


def position(first: np.ndarray, last: np.ndarray, hash_: np.ndarray, key: np.ndarray) -> np.ndarray:
    """How many boundaries ``(first, last)``, sorted, are at or below each ``(hash, key)``."""
    at = np.searchsorted(first, hash_, "left")
    end = np.searchsorted(first, hash_, "right")
    # Only rows whose hash is that of a boundary look at keys as well.
    for i in np.flatnonzero(end > at):
        at[i] += np.searchsorted(last[at[i] : end[i]], key[i], "right")
    return at


def splitters(rows: DataFrame, shares: list[float], tolerance: float) -> tuple[list[tuple[int, int]], list[int]]:
    """Boundaries ``(hash, key)`` with the wanted shares of all bytes below them, and rows below.

    ``tolerance`` is a share of all bytes.
    """
    total, all_rows = rows.agg(F.coalesce(F.sum("size"), F.lit(0)), F.count(F.lit(1))).first()
    n = len(shares)
    goal = [round(total * s) for s in shares]
    # The interval of each splitter, at first over hashes (key -1: below all rows of that hash).
    bounds = [[(_LOW, _LOW), (_HIGH, _HIGH)] for _ in range(n)]
    known: dict[tuple[int, int], tuple[int, int]] = {
        (_LOW, _LOW): (0, 0), (_HIGH, _HIGH): (total, all_rows)
    }
    best: list[tuple[int, int] | None] = [None] * n

    def miss(i: int, p: tuple[int, int]) -> int:
        return abs(known[p][0] - goal[i])

    while True:
        asked: set[tuple[int, int]] = set()
        for i in range(n):
            if best[i] is not None and miss(i, best[i]) <= tolerance * total:
                continue
            (h0, k0), (h1, k1) = bounds[i]
            if known[bounds[i][1]][1] - known[bounds[i][0]][1] <= 1:
                continue  # one row is left between them
            if h0 + 1 < h1:  # cut the range of hashes
                steps = min(PROBES, h1 - h0 - 1)
                asked |= {(h0 + (h1 - h0) * j // (steps + 1), _LOW) for j in range(1, steps + 1)}
                asked.add((h1, _LOW))
            elif k0 + 1 < k1 or h0 < h1:  # within one hash: cut the range of keys
                top = k1 if h1 == h0 else _HIGH
                steps = min(PROBES, top - k0 - 1)
                asked |= {(h0, k0 + (top - k0) * j // (steps + 1)) for j in range(1, steps + 1)}
                if h0 < h1:
                    asked |= {(h0, _HIGH), (h1, _LOW)}
        asked -= set(known)
        if not asked:
            break
        probes = np.array(sorted(asked), np.int64)
        size, count = _below(rows, probes)
        for p, s, c in zip(sorted(asked), size.tolist(), count.tolist()):
            known[p] = (s, c)
        points = sorted(known)
        totals = [known[p][0] for p in points]
        for i in range(n):
            over = bisect_right(totals, goal[i])  # the first point above the goal
            bounds[i] = [max(bounds[i][0], points[over - 1]), min([bounds[i][1], *points[over : over + 1]])]
            # of points with the same rows below, the first: it lies before a text and not within one
            near = [points[bisect_left(totals, totals[j])] for j in (over - 1, over) if j < len(points)]
            best[i] = min(near, key=lambda p: miss(i, p))
    chosen = [b or (_LOW, _LOW) for b in best]
    return chosen, [known[p][1] for p in chosen]


def shard(docs: DataFrame, shards: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``docs`` with ``size``, ``text_crc32``, ``shard`` and ``slot`` (from 0 in every shard, gapless).

    A row's size is the UTF-8 bytes of its text, none for null, and 16 more.  Shards differ by no more
    than the tolerance and one row, unless many rows repeat both key and text: such rows have no order
    among them and stay in one shard.  A null key comes before all others.  Columns of the new names
    are replaced, others kept.  An empty table has no rows in any shard.
    """
    docs = docs.drop("size", "text_crc32", "shard", "slot")
    body = F.coalesce(F.col(text), F.lit(""))
    sized = docs.withColumns({
        "size": F.octet_length(body).cast("long") + OVERHEAD,
        "text_crc32": F.crc32(F.encode(body, "UTF-8")),
        "_hash": F.xxhash64(body),
        "_key": F.coalesce(F.col(key).cast("long"), F.lit(_LOW)),
    })
    narrow = materialize(
        sized.select(F.col("_hash").alias("hash"), F.col("_key").alias("key"), "size"), "sizes"
    )
    total = narrow.agg(F.coalesce(F.sum("size"), F.lit(0))).first()[0]
    cuts, _ = splitters(narrow, [i / shards for i in range(1, shards)], TOLERANCE / shards)
    first = np.array([h for h, _ in cuts], np.int64)
    last = np.array([k for _, k in cuts], np.int64)

    def placed(rows: DataFrame, hash_: str, key_: str) -> DataFrame:
        def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                at = position(first, last, batch.column(hash_).to_numpy(), batch.column(key_).to_numpy())
                yield pa.RecordBatch.from_arrays(
                    [*batch.columns, pa.array(at.astype(np.int32))], names=[*batch.schema.names, "shard"]
                )

        schema = StructType([*rows.schema.fields, StructField("shard", IntegerType())])
        part = F.pmod(F.xxhash64(hash_, key_), F.lit(inner)).alias("_part")
        return rows.mapInArrow(place, schema).select("*", part)

    # Parts of a shard, by hash, keep a task to a bounded number of bytes; a part's first slot is the
    # number of rows in the parts before it.
    inner = max(1, -(-total // (shards * TASK_BYTES)))
    earlier = Window.partitionBy("shard").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = placed(narrow, "hash", "key").groupBy("shard", "_part").agg(F.count(F.lit(1)).alias("_n")).select(
        "shard", "_part", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("_before")
    )
    order = Window.partitionBy("shard", "_part").orderBy("_hash", "_key")
    numbered = placed(sized, "_hash", "_key").withColumn("_at", F.row_number().over(order) - 1)
    return numbered.join(offsets, ["shard", "_part"]).select(
        *docs.columns, "size", "text_crc32", "shard", (F.col("_at") + F.col("_before")).alias("slot")
    )
