"""Exact clustering of vectors in whole numbers by dimension-sharded Lloyd rounds.

A vector of many components is cut into blocks of columns.  One shard is a block of a range of vectors; it
holds its slice of the vectors and is given its slice of the centroids.  In a round every shard works out
the squared distances of its columns alone.  These are reduced by range: the blocks of a vector add up to its
distances, and the nearest centroid is taken there.  The assignment goes back to the shards of the range, and
every block adds up its own columns by cluster and divides.  Once the vectors are cut, no task has more than
a block's columns of a vector or of a centroid.

The shards lie in a bucketed table that is written once, so that rounds exchange distances (by range) and
assignments, but never vectors.  All sums are whole numbers, so that order and lost tasks change nothing.
What the driver holds is a slice of centroids for each block.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from veilrank.session import materialize, remove, scratch_path

BLOCK = 32  # columns of a shard
RANGE_ROWS = 4096  # vectors of a shard
BUCKET_BYTES = 128 << 20
MOST = 1 << 26  # greatest magnitude of a component: distances of 512 columns stay below 2**63
_EXACT = 1 << 21  # up to this, products of a block's columns are exact in 64-bit floats


def whole_numbers(vectors: DataFrame, dims: int, scale: float, vector: str = "embedding") -> DataFrame:
    """``vectors`` of exactly ``dims`` components, none null or not finite, with ``floor(scale * x)``.

    Components are numbers of any type, taken as doubles.
    """
    values = F.col(vector).cast("array<double>")
    sound = ~F.exists(values, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    kept = vectors.where(F.col(vector).isNotNull() & (F.size(vector) == dims) & F.coalesce(sound, F.lit(False)))
    # as doubles: whole numbers there as well, and a component out of bounds is told by ``cluster``
    return kept.withColumn(vector, F.transform(values, lambda x: _floor(x * F.lit(float(scale)))))


def _floor(x):
    """The floor of a double as a double, also where it is beyond the whole numbers of 64 bits."""
    return F.when(F.abs(x) < 2.0**53, F.floor(x).cast("double")).otherwise(x)


def _first_centroids(kept: DataFrame, clusters: int, key: str, vector: str, seed: int) -> np.ndarray:
    """The vectors of the smallest hashes of ``seed:key``; ties by components, a null key comes last."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.col(key).cast("string")), 256)
    rows = (
        kept.select(digest.alias("digest"), F.col(vector).alias("v"))
        .orderBy(F.asc_nulls_last("digest"), "v").limit(clusters).collect()
    )
    return np.array([r.v for r in rows], np.float64)


def _shards(kept: DataFrame, key: str, vector: str, dims: int, spark: SparkSession):
    """The bucketed table of shards, its name and folder, and the keys of each range.

    A range is some following rows of one task's input; task and place name it.
    """
    key_type = kept.schema[key].dataType.simpleString()
    blocks = range(0, dims, BLOCK)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, at = TaskContext.get().partitionId(), 0
        for batch in batches:
            for start in range(0, batch.num_rows, RANGE_ROWS):
                piece = batch.slice(start, RANGE_ROWS)
                lists = piece.column(1)
                table = lists.flatten().to_numpy().reshape(-1, dims).astype(np.int64)
                number = part << 32 | at
                at += 1
                n = len(blocks)
                yield pa.RecordBatch.from_arrays(
                    [pa.array([number] * n, pa.int64()), pa.array(range(n), pa.int32()),
                     pa.array([len(table)] * n, pa.int32()),
                     pa.array([np.ascontiguousarray(table[:, b : b + BLOCK]).astype(np.int32).tobytes() for b in blocks], pa.binary()),
                     # the keys go with the first block, the others have empty lists
                     pa.ListArray.from_arrays(pa.array([0] + [len(table)] * n, pa.int32()), piece.column(0))],
                    names=["range", "block", "n", "columns", "keys"],
                )

    ddl = f"range long, block int, n int, columns binary, keys array<{key_type}>"
    pieces = kept.select(key, vector).mapInArrow(cut, ddl)
    raw = scratch_path(spark, "shards")
    pieces.write.parquet(raw)
    raw_rows = spark.read.schema(pieces.schema).parquet(raw)
    size = raw_rows.agg(F.coalesce(F.sum(F.octet_length("columns")), F.lit(0))).first()[0]
    buckets = max(1, spark.sparkContext.defaultParallelism, -(-size // BUCKET_BYTES))
    # a catalogue table, as only those keep their buckets; its files are in the shared folder
    name, path = f"shards_{uuid.uuid4().hex}", scratch_path(spark, "bucketed")
    (
        raw_rows.select("range", "block", "n", "columns").repartition(buckets, "range", "block")
        .write.format("parquet").bucketBy(buckets, "range", "block").option("path", path).saveAsTable(name)
    )
    keys = materialize(raw_rows.where("block = 0").select("range", "keys"), "keys")
    remove(spark, raw)
    return spark.table(name), (name, path), keys


def _numbers(data: bytes, dtype=np.int64) -> np.ndarray:
    return np.frombuffer(data, dtype)


def _distances(shards: DataFrame, slices: list[np.ndarray]) -> DataFrame:
    """``(range, block, n, partial)``: the exact squared distances of each shard's columns."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                row = batch.slice(i, 1)
                own = slices[row.column("block")[0].as_py()]
                x = _numbers(row.column("columns")[0].as_buffer(), np.int32).reshape(-1, own.shape[1])
                kind = np.float64 if max(_greatest(x), _greatest(own)) <= _EXACT else np.int64
                x, c = x.astype(kind), own.astype(kind)
                part = (x * x).sum(1)[:, None] - 2 * (x @ c.T) + (c * c).sum(1)
                width = np.int32 if _greatest(part) < 2**31 else np.int64
                yield pa.RecordBatch.from_arrays(
                    [row.column("range"), row.column("n"), pa.array([np.dtype(width).itemsize], pa.int32()),
                     pa.array([part.astype(width).tobytes()], pa.binary())],
                    names=["range", "n", "width", "partial"],
                )

    return shards.mapInArrow(run, "range long, n int, width int, partial binary")


def _greatest(x: np.ndarray) -> int:
    return int(np.abs(x).max(initial=0))


def _assigned(partials: DataFrame) -> DataFrame:
    """``(range, cluster, distance)``: the blocks of each range added up, and the nearest centroid.

    Of equally near centroids the first is taken.
    """

    def nearest(rows: pd.DataFrame) -> pd.DataFrame:
        n = int(rows["n"].iloc[0])
        total: np.ndarray | None = None
        for width, data in zip(rows["width"], rows["partial"]):
            part = _numbers(data, np.int32 if width == 4 else np.int64).reshape(n, -1).astype(np.int64)
            total = part if total is None else total + part
        cluster = total.argmin(1)
        return pd.DataFrame({
            "range": rows["range"].iloc[:1].to_numpy(),
            "cluster": [cluster.astype(np.int32).tobytes()],
            "distance": [total[np.arange(n), cluster].tobytes()],
        })

    return partials.groupBy("range").applyInPandas(nearest, "range long, cluster binary, distance binary")


def _updated(shards: DataFrame, assigned: DataFrame, slices: list[np.ndarray]) -> list[np.ndarray]:
    """The next slice of every block: sums of its columns by cluster, divided; empty clusters stay."""
    blocks = F.explode(F.sequence(F.lit(0), F.lit(len(slices) - 1))).alias("block")
    given = assigned.select("range", "cluster", blocks)
    met = shards.join(given.hint("shuffle_hash"), ["range", "block"]).select("block", "columns", "cluster")
    k = len(slices[0])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            for block, columns, cluster in zip(batch.column(0).to_pylist(), batch.column(1), batch.column(2)):
                at = _numbers(cluster.as_buffer(), np.int32)
                x = _numbers(columns.as_buffer(), np.int32).reshape(len(at), -1).astype(np.int64)
                if block not in held:
                    held[block] = (np.zeros((k, x.shape[1]), np.int64), np.zeros(k, np.int64))
                order = np.argsort(at, kind="stable")
                own, starts = np.unique(at[order], return_index=True)
                held[block][0][own] += np.add.reduceat(x[order], starts, axis=0)
                held[block][1][own] += np.bincount(at, minlength=k)[own]
        yield pa.RecordBatch.from_arrays(
            [pa.array(list(held), pa.int32()), pa.array([s.tobytes() for s, _ in held.values()], pa.binary()),
             pa.array([c.tobytes() for _, c in held.values()], pa.binary())],
            names=["block", "sums", "counts"],
        )

    def divide(rows: pd.DataFrame) -> pd.DataFrame:
        block = int(rows["block"].iloc[0])
        counts = sum(_numbers(x) for x in rows["counts"])
        sums = sum(_numbers(x) for x in rows["sums"]).reshape(k, -1)
        out = slices[block].copy()
        some = counts > 0
        out[some] = sums[some] // counts[some, None]  # rounds down, below zero too
        return pd.DataFrame({"block": [block], "centroids": [out.tobytes()]})

    parts = met.mapInArrow(add, "block int, sums binary, counts binary")
    new = list(slices)
    for block, data in parts.groupBy("block").applyInPandas(divide, "block int, centroids binary").collect():
        new[block] = _numbers(data).reshape(k, -1)
    return new


def cluster(
    vectors: DataFrame, clusters: int = 16, dims: int = 64, rounds: int = 3, scale: float = 64.0,
    seed: int = 1, key: str = "vec_id", vector: str = "embedding",
) -> tuple[DataFrame, np.ndarray]:
    """``(key, cluster, distance)`` for each kept vector, and the final centroids.

    Vectors that ``whole_numbers`` does not keep have no row; rows that repeat a key are vectors of their own, a null
    key is kept as such.  With fewer vectors than clusters each is a centroid; repeated vectors give
    equal centroids, of which the first gets all.  No vectors, no rows.  A component of a magnitude beyond
    ``MOST`` raises, as distances would leave 64 bits.  ``distance`` is squared.
    """
    spark = vectors.sparkSession
    kept = whole_numbers(vectors.select(key, vector), dims, scale, vector)
    most = kept.agg(F.max(F.array_max(F.transform(vector, F.abs)))).first()[0]
    if most is None:
        nothing = spark.createDataFrame([], f"{key} {vectors.schema[key].dataType.simpleString()}, cluster int, distance long")
        return nothing, np.zeros((0, dims), np.int64)
    if most > MOST:
        raise ValueError(f"a component of magnitude {most:.0f}, beyond {MOST}: distances would leave 64 bits")
    start = _first_centroids(kept, clusters, key, vector, seed).astype(np.int64)
    slices = [np.ascontiguousarray(start[:, b : b + BLOCK]) for b in range(0, dims, BLOCK)]
    shards, (name, path), keys = _shards(kept, key, vector, dims, spark)
    for _ in range(rounds):
        slices = _updated(shards, _assigned(_distances(shards, slices)), slices)
    last = materialize(_assigned(_distances(shards, slices)), "assigned")
    spark.sql(f"DROP TABLE {name}")
    remove(spark, path)
    whole = keys.join(last, "range")

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0)[i].values, pa.array(_numbers(batch.column(1)[i].as_buffer(), np.int32)),
                     pa.array(_numbers(batch.column(2)[i].as_buffer()))],
                    names=[key, "cluster", "distance"],
                )

    ddl = f"{key} {vectors.schema[key].dataType.simpleString()}, cluster int, distance long"
    return whole.select("keys", "cluster", "distance").mapInArrow(rows, ddl), np.hstack(slices)


def with_inertia(assigned: DataFrame, centroids: np.ndarray) -> DataFrame:
    """``assigned`` with ``cluster_inertia``, ``inertia`` and ``centroid_sha256`` of each row's cluster."""
    sums = assigned.groupBy("cluster").agg(F.sum("distance").alias("s")).collect()  # a row for each cluster
    inertia = dict((r.cluster, r.s) for r in sums)
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids.tolist()]
    if not inertia:
        return assigned.withColumns({
            "cluster_inertia": F.lit(None).cast("long"), "inertia": F.lit(None).cast("long"),
            "centroid_sha256": F.lit(None).cast("string"),
        })
    of = F.create_map(*(x for c, s in inertia.items() for x in (F.lit(c), F.lit(s).cast("long"))))
    names = F.array(*map(F.lit, digest))
    return assigned.withColumns({
        "cluster_inertia": of[F.col("cluster")],
        "inertia": F.lit(sum(inertia.values())).cast("long"),
        "centroid_sha256": F.get(names, F.col("cluster")),
    })
