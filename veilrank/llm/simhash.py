"""Near copies by SimHash: a generalised pigeonhole search over distinct fingerprints.

Two fingerprints within ``distance`` bits agree, on at least one of m bit partitions, up to that
partition's own threshold, whenever the thresholds add up to ``distance - m + 1``; a threshold of -1
leaves a partition out.  Correlated bits are put into one partition.  For every number of partitions,
partition and threshold the number of candidate pairs is estimated from sketches over all
fingerprints, and dynamic programming picks the thresholds of least cost.  A threshold of 0 probes
the partition's value, a threshold of 1 its value with each bit left out in turn.  Whatever is chosen,
no link is lost; the choice only sets the cost.

Rows with equal fingerprints are one node.  A bucket of candidates is cut into tiles of bounded size,
so no task ever holds an unbounded one, and a tile yields the verified links of a spanning forest, not
its pairs.  Components grow in rounds of large and small stars, each written to the shared folder.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilrank.llm.arrow import replaced, replaced_schema, text_chunks
from veilrank.session import materialize

BITS, SEED = 64, 42
TILE = 2048  # fingerprints of a bucket in one tile's half
_SKETCH = 1024
_PAIR_COST = 0.005  # of one comparison, in rows probed
_LAG = 8  # buckets up to this size are compared all at once, larger ones one after another


def fingerprint(text: str, shingle: int = 3) -> int:
    """Bits that are set in over half of the hashes of the word shingles; 0 without words."""
    words = text.encode("utf-8", "surrogatepass").lower().split()  # lower: A-Z alone, in bytes
    if not words:
        return 0
    digest, join = xxhash.xxh64_intdigest, b" ".join
    if len(words) < shingle:
        runs = [words]
    else:
        runs = zip(*(words[i:] for i in range(shingle)))
    hashes = np.array([digest(join(r), SEED) for r in runs], np.uint64)
    counts = np.zeros(BITS, np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(0, dtype=np.int64)
    return int(np.packbits(2 * counts > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``docs`` with ``fp`` (a signed long) instead of the text; a null text is an empty one."""
    docs = docs.drop("fp")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, texts in text_chunks(batch):
                prints = np.array([fingerprint(t, shingle) for t in texts], np.uint64)
                yield replaced(part, ["fp"], [pa.array(prints.view(np.int64))])

    return docs.mapInArrow(run, replaced_schema(docs.schema, "fp long"))


def _bits(values: np.ndarray) -> np.ndarray:
    """A row of 64 zeros and ones for each value, lowest bit first."""
    return np.unpackbits(values.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")


def bit_counts(nodes: DataFrame) -> np.ndarray:
    """How many nodes have both bits set, for all pairs of bits: sums of one small table a task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, n = np.zeros((BITS, BITS), np.int64), 0
        for batch in batches:
            bits = _bits(batch.column(0).to_numpy()).astype(np.float32)
            total += np.rint(bits.T @ bits).astype(np.int64)
            n += len(bits)
        flat = np.append(total.ravel(), n)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.arange(len(flat))), pa.array(flat)], names=["cell", "n"]
        )

    cells = nodes.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    out = np.zeros(BITS * BITS + 1, np.int64)
    for cell, n in cells.collect():  # 4,097 rows
        out[cell] = n
    return out


def correlated_groups(counts: np.ndarray, m: int) -> list[list[int]]:
    """m groups of bits of near equal size; each takes the bits most correlated with what it has."""
    n = max(1, int(counts[-1]))
    both = counts[:-1].reshape(BITS, BITS) / n
    p = np.diag(both)
    spread = np.sqrt(np.maximum(p * (1 - p), 1e-9))
    corr = np.abs(both - np.outer(p, p)) / np.outer(spread, spread)
    np.fill_diagonal(corr, 0)
    free, groups = set(range(BITS)), []
    for i in range(m):
        size = (BITS * (i + 1)) // m - (BITS * i) // m
        order = sorted(free, key=lambda b: (-corr[b, sorted(free)].sum(), b))
        group = [order[0]]
        while len(group) < size:
            rest = sorted(free - set(group))
            group.append(max(rest, key=lambda b: (corr[b, group].sum(), -b)))
        free -= set(group)
        groups.append(sorted(group))
    return groups


def masks(group: list[int], threshold: int) -> list[int]:
    """The bit masks whose values are probed for a partition."""
    full = sum(1 << b for b in group)
    return [[], [full], [full & ~(1 << b) for b in group]][threshold + 1]


def _mix(values: np.ndarray, salt: int) -> np.ndarray:
    x = (values ^ np.uint64(salt * 0x9E3779B97F4A7C15 & (2**64 - 1))) * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(32))


def candidate_counts(nodes: DataFrame, probes: list[list[int]]) -> np.ndarray:
    """Estimated candidate pairs of each list of masks: a count sketch of its keys over all nodes.

    The sum of the squared bucket sums estimates the sum of the squared key counts.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(probes), _SKETCH), np.int64)
        for batch in batches:
            values = batch.column(0).to_numpy().view(np.uint64)
            for i, own in enumerate(probes):
                for mask in own:
                    h = _mix(values & np.uint64(mask), mask)
                    sign = ((h >> np.uint64(40)) & np.uint64(1)).astype(np.float64) * 2 - 1
                    bucket = (h % np.uint64(_SKETCH)).astype(np.int64)
                    sums[i] += np.rint(np.bincount(bucket, sign, _SKETCH)).astype(np.int64)
        flat = sums.ravel()
        some = np.flatnonzero(flat)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(flat[some])], names=["cell", "n"])

    cells = nodes.select("fp").mapInArrow(run, "cell long, n long").groupBy("cell").agg(F.sum("n").alias("n"))
    sums = np.zeros(len(probes) * _SKETCH)
    for cell, n in cells.collect():  # at most 1,024 rows for each list
        sums[cell] = n
    return (sums.reshape(len(probes), _SKETCH) ** 2).sum(1)


def plan_masks(nodes: DataFrame, distance: int) -> list[int]:
    """The masks to probe: the cheapest numbers of partitions and thresholds for all nodes.

    A partition has a threshold of -1 (not probed), 0 or 1, and there are 2 to ``distance`` + 1 partitions:
    the thresholds add up to ``distance`` less the partitions, plus 1, which loses no link.  Larger thresholds
    are not tried, as a partition of many bits would be probed by all pairs of its bits.
    """
    counts = bit_counts(nodes)
    n = int(counts[-1])
    layouts = [correlated_groups(counts, m) for m in range(2, distance + 2) if distance - m + 1 <= m]
    cells = [(g, t) for groups in layouts for g in groups for t in (0, 1)]
    squares = candidate_counts(nodes, [masks(g, t) for g, t in cells])
    cost = {(tuple(g), -1): 0.0 for groups in layouts for g in groups}
    for (g, t), square in zip(cells, squares):
        keys = n * len(masks(g, t))
        cost[tuple(g), t] = keys + _PAIR_COST * max(0.0, square - keys) / 2
    best: tuple[float, list[int]] | None = None
    for groups in layouts:
        # least cost of the first partitions for each sum of their thresholds
        table: dict[int, tuple[float, list[int]]] = {0: (0.0, [])}
        for g in groups:
            step: dict[int, tuple[float, list[int]]] = {}
            for total, (spent, chosen) in table.items():
                for t in (-1, 0, 1):
                    new = (spent + cost[tuple(g), t], [*chosen, t])
                    if total + t not in step or new < step[total + t]:
                        step[total + t] = new
            table = step
        found = table.get(distance - len(groups) + 1)
        if found and (best is None or found[0] < best[0]):
            best = (found[0], [m for g, t in zip(groups, found[1]) for m in masks(g, t)])
    return best[1]


def _forest(values: np.ndarray, distance: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Links that connect all of a bucket that its pairs within the distance connect."""
    rest = values
    while len(rest) > 1:
        frontier, rest = [rest[0]], rest[1:]
        while frontier and len(rest):
            x = frontier.pop()
            near = np.bitwise_count(rest ^ x) <= distance
            if near.any():
                new = rest[near]
                yield np.full(len(new), x), new
                frontier.extend(new)
                rest = rest[~near]


def _bucket_links(keys: np.ndarray, values: np.ndarray, distance: int):
    """Links within runs of equal keys; both arrays are sorted by key."""
    edge = np.flatnonzero(np.append(True, (keys[1:] != keys[:-1]).any(1)))
    size = np.diff(np.append(edge, len(keys)))
    out = []
    small = np.repeat(size <= _LAG, size)
    group = np.repeat(np.arange(len(edge)), size)
    for lag in range(1, min(_LAG, len(values))):
        a, b = values[:-lag], values[lag:]
        hit = (group[:-lag] == group[lag:]) & small[:-lag]
        hit &= np.bitwise_count(a ^ b) <= distance
        out.append((a[hit], b[hit]))
    for i in np.flatnonzero(size > _LAG):
        out += _forest(values[edge[i] : edge[i] + size[i]], distance)
    return [np.concatenate(x) if x else np.zeros(0, np.uint64) for x in zip(*out)] or [np.zeros(0, np.uint64)] * 2


def links(nodes: DataFrame, distance: int) -> DataFrame:
    """Verified links ``(a, b)`` between different fingerprints, enough to connect every component."""
    probes = plan_masks(nodes, distance) if distance else [(1 << BITS) - 1]
    keyed = nodes.select(
        "fp",
        F.inline(F.array(*(
            F.struct(F.lit(i).alias("k"), F.col("fp").bitwiseAND(F.lit(m - (m >> 63 << 64))).alias("v"))
            for i, m in enumerate(probes)
        ))),
    )
    hot = keyed.groupBy("k", "v").count().where(F.col("count") > TILE).select(
        "k", "v", F.ceil(F.col("count") / TILE).cast("int").alias("c")
    )
    own = F.pmod(F.xxhash64("fp"), F.col("c")).cast("int")
    # A row of a hot bucket goes to the tiles of its own part and each part.
    tiles = F.when(F.col("c").isNull(), F.array(F.struct(F.lit(0).alias("s"), F.lit(0).alias("t")))).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.col("c") - 1),
            lambda j: F.struct(F.least(own, j).alias("s"), F.greatest(own, j).alias("t")),
        )
    )
    dealt = (
        keyed.join(hot, ["k", "v"], "left")
        .select("k", "v", "fp", F.inline(tiles))
        .repartition("k", "v", "s", "t")
        .sortWithinPartitions("k", "v", "s", "t")
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def told(keys: np.ndarray, values: np.ndarray) -> pa.RecordBatch:
            a, b = _bucket_links(keys, values, distance)
            return pa.RecordBatch.from_arrays(
                [pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], names=["a", "b"]
            )

        for batch in batches:
            if not batch.num_rows:
                continue
            column = {n: batch.column(i).to_numpy() for i, n in enumerate(batch.schema.names)}
            keys = np.stack([column[n].astype(np.int64) for n in ("k", "v", "s", "t")], 1)
            held.append((keys, column["fp"].view(np.uint64)))
            # The last bucket may go on in the next batch; the ones before it are complete.
            if (keys[0] == keys[-1]).all():
                continue
            keys, values = (np.concatenate(x) for x in zip(*held))
            cut = len(keys) - int((keys == keys[-1]).all(1)[::-1].argmin())
            yield told(keys[:cut], values[:cut])
            held = [(keys[cut:], values[cut:])]
        if held:
            yield told(*(np.concatenate(x) for x in zip(*held)))

    return dealt.mapInArrow(run, "a long, b long").where("a <> b").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of an edge ``(a, b)``; the root is the component's least node.

    Rounds of large stars and small stars; minima come from aggregates, so a node with very many
    edges is a skewed join side and never a window.
    """
    edges = materialize(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")), "links")
    before = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(least, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        joined = large.join(least, "u")
        small = (
            joined.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
            .unionByName(least.select("u", F.col("m").alias("v")))
            .distinct()
        )
        edges = materialize(small, "links")
        now = tuple(edges.agg(
            F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))
        ).first())
        if now == before:
            return edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
        before = now


def grouped(
    docs: DataFrame, shingle: int = 3, distance: int = 3, carried: Sequence[str] = ()
) -> DataFrame:
    """``(doc_id, carried, fp, root, component_id)`` for each row of ``docs(doc_id, text)``.

    ``root`` is the least fingerprint of the component and names it also where no row has a doc_id;
    ``carried`` are columns that go along, such as one that tells rows of equal or null doc_id apart.
    """
    own = docs.select("doc_id", *carried, "text")
    prints = materialize(fingerprints(own, shingle), "fingerprints")
    classes = materialize(prints.groupBy("fp").agg(F.min("doc_id").alias("first")), "nodes")
    roots = components(links(classes.select("fp"), distance))
    rooted = classes.join(roots, classes.fp == roots.node, "left").select(
        "fp", "first", F.coalesce("root", "fp").alias("root")
    )
    named = rooted.groupBy("root").agg(F.min("first").alias("component_id"))
    classes = rooted.join(named, "root").select("fp", "root", "component_id")
    return prints.join(classes, "fp").select("doc_id", *carried, "fp", "root", "component_id")


def near_duplicates(docs: DataFrame, shingle: int = 3, distance: int = 3) -> DataFrame:
    """``(doc_id, fingerprint, component_id)`` for each row of ``docs(doc_id, text)``.

    Fingerprints at most ``distance`` bits apart are linked; a component is named by the smallest
    doc_id that can be reached.  A null text has the fingerprint of an empty one, 0.  A null doc_id
    never names a component that has another; repeated rows are in one component.  A distance of 0
    leaves equal fingerprints together and links no others.
    """
    return grouped(docs, shingle, distance).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )
