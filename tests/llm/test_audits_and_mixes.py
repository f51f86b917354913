"""Filter audits, mixes of sources and exact clusters against brute force."""

import hashlib
import math
import random
import re
from collections import Counter, defaultdict
from itertools import permutations

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_prose import prose
from veilrank.llm import centroids, filter_audit, mixing

# --- Filter audits -----------------------------------------------------------


def test_positional_popcounts_of_any_length():
    draw = np.random.default_rng(3)
    for n in (0, 1, 15, 16, 17, 1000, 4099):
        words = draw.integers(0, 1 << 32, n, dtype=np.uint32)
        plain = [int(sum(int(w) >> b & 1 for w in words)) for b in range(32)]
        assert filter_audit.positional_popcounts(words).tolist() == plain


def test_survival_word_of_every_mask(spark):
    masks = spark.range(32)
    word = filter_audit.survival_word([F.col("id").bitwiseAND(1 << i) != 0 for i in range(5)])
    for r in masks.select("id", word.alias("word")).collect():
        assert [r.word >> s & 1 for s in range(32)] == [int(s & r.id == 0) for s in range(32)]
    with pytest.raises(ValueError):
        filter_audit.survival_word([F.lit(True)] * 6)


def plain_fails(rows):
    first = {}
    for i, text, _ in rows:
        if i is not None:
            first[text or ""] = min(i, first.get(text or "", i))
    for i, text, source in rows:
        text = text or ""
        words = re.findall(r"[^\x20\x09-\x0D]+", text)
        yield (
            len(words) < 50, 100 * len(set(words)) < 65 * len(words),
            100 * len(re.findall("[A-Z]", text)) > 5 * len(text), bool(re.search(r"[#$%&*|]", text)),
            i is not None and i > first.get(text, i),
        )


def plain_audit(rows, good, toxic):
    docs = [(s or "", f, i) for (i, _, s), f in zip(rows, plain_fails(rows))]
    out, shapley = {}, Counter()
    for part in {p for p, _, _ in docs}:
        own = [(f, i) for p, f, i in docs if p == part]
        for order in permutations(range(5)):
            alive = list(own)
            for step, f in enumerate(order):
                gone = [d for d in alive if d[0][f]]
                alive = [d for d in alive if not d[0][f]]
                failing = [d for d in own if d[0][f]]
                out[part, "".join("ABCDE"[x] for x in order), step + 1] = [
                    len(alive), len(gone), len(failing) - len(gone),
                    sum(sum(d[0]) == 1 for d in failing),
                    sum(d[1] in good for d in gone), sum(d[1] in toxic for d in gone),
                ]
                shapley[part, f] += len(gone)
    return {k: (*v, shapley[k[0], "ABCDE".index(k[1][k[2] - 1])]) for k, v in out.items()}


def audit_rows():
    draw = random.Random(5)
    texts = [
        prose(1, 60), prose(2, 20), "same words again " * 30, prose(3, 60).upper(), prose(4, 55) + " 50%",
        "", None, "Up And Down | " * 20, prose(5, 70), " \t\n\x0b x " * 60,
    ]
    rows = [(i, draw.choice(texts), draw.choice(["a", "b", None, "", "é"])) for i in range(200)]
    return rows + [(None, texts[0], "a"), (None, texts[8], "b"), (7, rows[7][1], "a"), (9, "one", "a"), (9, "one", "a")]


def told(df):
    return {
        (r.part, r.filter_order, r.step):
        (r.kept, r.removed, r.redundant, r.unique_fails, r.good_lost, r.toxic_lost, r.shapley)
        for r in df.collect()
    }


def test_audit_equals_filtering_in_every_order(spark):
    rows = audit_rows()
    good = {i for i in range(200) if i % 3 == 0}
    toxic = {i for i in range(200) if i % 5 == 0}
    labels = [(i, int(i in good), int(i in toxic)) for i in range(200)]
    labels += [(3, 0, None), (None, 1, 1), (5, None, 0)]  # repeated, null and partly null labels
    got = told(filter_audit.audit_documents(
        spark.createDataFrame(rows, "doc_id long, text string, source string").withColumn("word", F.lit("x")),
        spark.createDataFrame(labels, "doc_id long, quality int, toxic int"),
    ))
    assert got == plain_audit(rows, good, toxic)


def test_audit_of_odd_and_no_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    rows = [(r.doc_id, r.text, r.source) for r in odd_docs.collect()]
    assert told(filter_audit.audit_documents(odd_docs, labels)) == plain_audit(rows, set(), set())
    assert filter_audit.audit_documents(no_docs, labels).count() == 0


def test_audit_counts_flushed_between_batches(spark, monkeypatch):
    monkeypatch.setattr(filter_audit, "_HELD_ROWS", 3)
    words = spark.createDataFrame(
        [("p" if i % 3 else "q", (1 << i % 32) | 1, i % 2 == 0) for i in range(100)], "part string, word long, odd boolean"
    )
    got = {(r.part, r.label, r.subset): r.survivors
           for r in filter_audit.subset_survivors(words, "part", "word", ["odd"]).collect()}
    for part in "pq":
        own = [i for i in range(100) if ("p" if i % 3 else "q") == part]
        assert got[part, "", 0] == len(own)
        assert got[part, "odd", 4] == sum(i % 32 == 4 and i % 2 == 0 for i in own)


# --- Mixes -------------------------------------------------------------------


def plain_targets(sizes):
    """Shares of one and a half times all words; what is over twice a source goes round again."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: (5, 2, 1)[i % 3] for i, s in enumerate(order)}
    out, rest = {}, 1.5 * sum(sizes.values())
    left = set(order)
    while left:
        level = rest / sum(weight[s] for s in left)
        over = {s for s in left if level * weight[s] >= 2 * sizes[s]}
        for s in over or left:
            out[s] = 2.0 * sizes[s] if over else level * weight[s]
        if not over:
            break
        rest -= sum(out[s] for s in over)
        left -= over
    return out


def words_of(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def mix_rows():
    draw = random.Random(8)
    sources = ["hot"] * 6 + ["a", "b", "é", "\U0001f600", None, "", "z"]
    rows = [(i, draw.choice(sources), prose(i, draw.randint(0, 300))) for i in range(500)]
    return rows + [(1000, "b", prose(1, 9000)), (1001, "none", ""), (None, "a", None), (None, "a", "x y"), (3, "a", "x y"),
                   (4, "a", "x y"), (4, "a", "x y")]


def check_mix(rows, got):
    assert sorted((r.doc_id or -1, r.source or "", r.size) for r in got) == sorted(
        (i or -1, s or "", words_of(t)) for i, s, t in rows)
    sizes = Counter()
    for _, s, t in rows:
        sizes[s] += words_of(t)
    goal = plain_targets({s: sizes[s] for s in {s for _, s, _ in rows}})
    taken = Counter()
    for r in got:
        assert r.source_size == sizes[r.source]
        assert math.isclose(r.target, goal[r.source], rel_tol=1e-9, abs_tol=1e-9)
        assert 0 <= r.taken <= 2 * r.size
        taken[r.source] += r.taken
    for s, t in goal.items():
        assert abs(taken[s] - t) <= 2 * mixing.PIECE + 1
    assert sum(taken.values()) == sum(sizes.values()) * 3 // 2


@pytest.mark.parametrize("bucket_rows", [3, 25_000])
def test_mix_meets_its_targets(spark, monkeypatch, bucket_rows):
    monkeypatch.setattr(mixing, "BUCKET_ROWS", bucket_rows)
    rows = mix_rows()
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string").withColumn("taken", F.lit("x"))
    got = mixing.mix(docs).collect()
    check_mix(rows, got)
    again = mixing.mix(docs.repartition(7)).collect()
    assert sorted(map(str, again)) == sorted(map(str, got))


def test_mix_is_a_weighted_fair_queue(spark, monkeypatch):
    """Against one plain queue for each source, pieces sorted by finish time and cut at the budget."""
    monkeypatch.setattr(mixing, "BUCKET_ROWS", 40)
    rows = list({r[0]: r for r in mix_rows() if r[0] is not None}.values())  # of one id, one row
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    queues = defaultdict(list)
    for i, s, t in rows:
        place = int(hashlib.md5(f"{i}:{t or ''}".encode()).hexdigest()[:15], 16)
        queues[s].append((place, i, words_of(t)))
    total = {s: sum(n for _, _, n in q) for s, q in queues.items()}
    goal = plain_targets(total)
    pieces = []
    for s, q in queues.items():
        at = 0
        for _ in range(2):
            for _, i, n in sorted(q):
                for first in range(0, n, mixing.PIECE):
                    words = min(mixing.PIECE, n - first)
                    at += words
                    pieces.append((at / goal[s], "" if s is None else "=" + s, at, i, words))
    left, taken = sum(total.values()) * 3 // 2, Counter()
    for _, _, _, i, words in sorted(pieces):
        taken[i] += min(words, left)
        left -= min(words, left)
    got = {r.doc_id: r.taken for r in mixing.mix(docs).collect()}
    assert sum(abs(got[i] - taken[i]) for i in got) <= 2  # equal but for targets' last bits at the cut


def test_mix_shows_the_shares_in_every_stretch(spark):
    rows = [(i, "abc"[i % 3], prose(i, 100)) for i in range(900)]
    docs = spark.createDataFrame(rows, "doc_id long, source string, text string")
    pieces = mixing.schedule(docs).where("at < budget").collect()
    goal = {r.source: r.target for r in pieces}
    for end in (9_000, 45_000, 90_000):
        served = Counter()
        for r in pieces:
            if r.at < end:
                served[r.source] += r.words
        for s in goal:
            assert abs(served[s] / end - goal[s] / sum(goal.values())) < 0.03


def test_mix_of_odd_and_no_rows(spark, odd_docs, no_docs):
    rows = [(r.doc_id, r.source, r.text) for r in odd_docs.collect()]
    check_mix(rows, mixing.mix(odd_docs).collect())
    assert mixing.mix(no_docs).count() == 0
    empty = spark.createDataFrame([(1, None, None), (2, "s", "")], "doc_id long, source string, text string")
    assert {(r.doc_id, r.size, r.target, r.taken) for r in mixing.mix(empty).collect()} == {(1, 0, 0.0, 0), (2, 0, 0.0, 0)}


# --- Exact clusters ----------------------------------------------------------


def plain_clusters(rows, k, dims, rounds=3):
    kept = [(i, [math.floor(64 * x) for x in v]) for i, v in rows
            if v is not None and len(v) == dims and all(x is not None and math.isfinite(x) for x in v)]
    digest = lambda i: (i is None, hashlib.sha256(f"1:{i}".encode()).hexdigest() if i is not None else "")
    means = [v for _, v in sorted(kept, key=lambda r: (digest(r[0]), r[1]))[:k]]
    far = lambda v, c: sum((x - y) ** 2 for x, y in zip(v, c))
    for t in range(rounds + 1):
        at = [min(range(len(means)), key=lambda c: (far(v, means[c]), c)) for _, v in kept]
        if t < rounds:
            for c in range(len(means)):
                own = [v for (_, v), a in zip(kept, at) if a == c]
                if own:
                    means[c] = [sum(x) // len(own) for x in zip(*own)]
    return sorted((i if i is not None else -1, a, far(v, means[a])) for (i, v), a in zip(kept, at)), means


def vectors(n, dims, seed=1, size=1.0):
    draw = random.Random(seed)
    return [(i, [draw.gauss(i % 5, 1) * size for _ in range(dims)]) for i in range(n)]


def frame(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("cluster", F.lit("clash"))


def clustered(spark, rows, k=16, dims=64):
    df, means = centroids.cluster(frame(spark, rows), clusters=k, dims=dims)
    return sorted((r.vec_id if r.vec_id is not None else -1, r.cluster, r.distance) for r in df.collect()), means.tolist()


@pytest.mark.parametrize("range_rows", [7, 4096])
def test_clusters_equal_plain_lloyd(spark, monkeypatch, range_rows):
    monkeypatch.setattr(centroids, "RANGE_ROWS", range_rows)
    rows = vectors(300, 64) + [(None, [0.5] * 64), (3, [0.25] * 64), (3, [0.25] * 64), (900, None), (901, [1.0] * 63),
                               (902, [1.0] * 63 + [None]), (903, [float("nan")] * 64), (904, [float("inf")] + [0.0] * 63)]
    want, means = plain_clusters(rows, 16, 64)
    assert clustered(spark, rows) == (want, means)


def test_clusters_of_large_components_are_exact(spark):
    rows = vectors(120, 40, 2, size=50_000.0)  # products beyond the exact whole numbers of floats
    rows += [(200 + i, [-300_000.0 * (i + 1)] * 40) for i in range(3)]
    want, means = plain_clusters(rows, 5, 40)
    assert clustered(spark, rows, 5, 40) == (want, means)
    with pytest.raises(ValueError, match="magnitude"):
        clustered(spark, [(1, [2.0**30] * 40)], 5, 40)


def test_clusters_of_equal_few_and_no_vectors(spark):
    same = [(i, [1.0] * 64) for i in range(50)]
    got, means = clustered(spark, same)
    assert {c for _, c, _ in got} == {0} and {d for _, _, d in got} == {0} and len(means) == 16
    few = vectors(3, 64)
    assert clustered(spark, few) == plain_clusters(few, 16, 64)
    assert clustered(spark, [(1, None)]) == ([], [])
    none = centroids.with_inertia(*centroids.cluster(frame(spark, [(1, [])])))
    assert none.count() == 0 and "centroid_sha256" in none.columns


def test_inertia_and_digests(spark):
    rows = vectors(200, 64)
    want, means = plain_clusters(rows, 16, 64)
    told = centroids.with_inertia(*centroids.cluster(frame(spark, rows))).collect()
    by = Counter()
    for _, c, d in want:
        by[c] += d
    assert len(told) == len(want)
    for r in told:
        assert r.inertia == sum(by.values()) and r.cluster_inertia == by[r.cluster]
        assert r.centroid_sha256 == hashlib.sha256(",".join(map(str, means[r.cluster])).encode()).hexdigest()
    assert not [t for t in spark.catalog.listTables() if t.name.startswith("shards_")]
