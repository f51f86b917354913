"""SimHash components and weighted-sampling fingerprints against brute force."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import pytest
import xxhash

from llm_prose import prose
from veilrank.llm import simhash, weighted_sampling


def plain_fingerprint(text, shingle=3):
    data = bytes(x + 32 if 65 <= x <= 90 else x for x in (text or "").encode())
    words = re.findall(rb"[^\x20\x09-\x0D]+", data)
    if not words:
        return 0
    runs = [b" ".join(words[i : i + shingle]) for i in range(len(words) - shingle + 1)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(r, 42) for r in runs]
    return sum(1 << i for i in range(64) if 2 * sum(h >> i & 1 for h in hashes) > len(hashes))


def plain_components(prints, distance):
    parent = list(range(len(prints)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= distance:
                parent[max(find(i), find(j))] = min(find(i), find(j))
    return [find(i) for i in range(len(prints))]


def test_fingerprint():
    for text in [None, "", " \n", "One", "One two", "A b C d", prose(1, 300), "É é", "a\x0bb\x0cc\x1cd"]:
        assert simhash.fingerprint(text or "") == plain_fingerprint(text)
    assert simhash.fingerprint("A B C") == simhash.fingerprint("a b  c\n")


def check(spark, prints, distance=3):
    nodes = spark.createDataFrame([(int(np.uint64(p).view(np.int64)),) for p in prints], "fp long")
    edges = simhash.links(nodes.distinct(), distance)
    rows = edges.collect()
    for a, b in rows:
        assert ((a ^ b) & (2**64 - 1)).bit_count() <= distance
    roots = dict(simhash.components(edges).collect())
    order = sorted(set(prints), key=lambda p: int(np.uint64(p).view(np.int64)))
    signed = [int(np.uint64(p).view(np.int64)) for p in order]
    want = plain_components(order, distance)
    assert [roots.get(s, s) for s in signed] == [signed[w] for w in want]
    return rows


def near(seed, n, bits):
    """A crowd of fingerprints around one, and as many apart."""
    draw = random.Random(seed)
    center = draw.getrandbits(64)
    crowd = []
    for _ in range(n):
        x = center
        for _ in range(draw.randint(0, bits)):
            x ^= 1 << draw.randrange(64)
        crowd.append(x)
    return list({*crowd, *(draw.getrandbits(64) for _ in range(n)), 0})


@pytest.mark.parametrize("tile", [2048, 5])
def test_links_keep_every_component(spark, monkeypatch, tile):
    monkeypatch.setattr(simhash, "TILE", tile)
    rows = check(spark, near(5, 150, 4))
    assert len(rows) < 20 * 150  # a forest from each bucket, not all pairs


@pytest.mark.parametrize("m", [2, 3, 4])
def test_every_layout_finds_all_links(spark, monkeypatch, m):
    groups = [list(range(64 * i // m, 64 * (i + 1) // m)) for i in range(m)]
    left = 3 - m + 1
    thresholds = [1] * left + [0] * (m - left) if m > 2 else [1, 1]
    probes = [x for g, t in zip(groups, thresholds) for x in simhash.masks(g, t)]
    monkeypatch.setattr(simhash, "plan_masks", lambda nodes, distance: probes)
    check(spark, near(6, 80, 4))


def test_correlated_bits_share_a_group():
    draw = np.random.default_rng(1)
    values = draw.integers(0, 2**63, 2000, dtype=np.uint64)
    bits = simhash._bits(values).astype(np.int64)
    bits[:, 40] = bits[:, 3]
    counts = np.append((bits.T @ bits).ravel(), len(bits))
    groups = simhash.correlated_groups(counts, 4)
    assert sorted(b for g in groups for b in g) == list(range(64)) and {len(g) for g in groups} == {16}
    assert [3 in g for g in groups] == [40 in g for g in groups]


def test_near_duplicates_of_odd_rows(odd_docs, no_docs):
    rows = simhash.near_duplicates(odd_docs).collect()
    texts = [(r.doc_id, r.text) for r in odd_docs.collect()]
    prints = [plain_fingerprint(t) for _, t in texts]
    of = plain_components(prints, 3)
    want = []
    for (key, _), p, c in zip(texts, prints, of):
        keys = [k for (k, _), d in zip(texts, of) if d == c and k is not None]
        want.append((key, f"{p:016x}", min(keys, default=None)))
    assert sorted(map(tuple, rows), key=repr) == sorted(want, key=repr)
    assert simhash.near_duplicates(no_docs).count() == 0


def jaccard(a, b):
    a, b = Counter(a.lower().split()), Counter(b.lower().split())
    return sum((a & b).values()) / max(1, sum((a | b).values()))


def test_samples_agree_like_generalised_jaccard(spark):
    texts = [prose(i % 12, 120) + " " + prose(i, 60 + i) for i in range(120)]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.samples for r in weighted_sampling.fingerprints(rows).collect()}
    errors = []
    for i in range(0, 120):
        for j in range(i + 12, 120, 12):
            same = sum(x == y for x, y in zip(got[i], got[j])) / len(got[i])
            errors.append(same - jaccard(texts[i], texts[j]))
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.09


def edits(texts):
    """``texts`` in descending order of keys: what each becomes."""
    out = []
    for i, t in enumerate(texts):
        k = len(t) // 3
        out.append(t[: len(t) - k] + texts[(i + 1) % len(texts)][:k])
    return out


@pytest.mark.parametrize("n", [1, 2, 300])
def test_edited_neighbours(spark, monkeypatch, n):
    monkeypatch.setattr(weighted_sampling, "BUCKET_ROWS", 8)
    keys = sorted(random.Random(n).sample(range(-1000, 10**12), n), reverse=True)
    texts = [prose(i % 50, i % 40) for i in range(n)]
    docs = spark.createDataFrame(list(zip(keys, texts)), "doc_id long, text string")
    rows = {r.doc_id: r for r in weighted_sampling.with_edits(docs).collect()}
    assert len(rows) == n
    for i, (key, text, edited) in enumerate(zip(keys, texts, edits(texts))):
        r = rows[key]
        assert r.n_chars == len(text)
        assert r.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert r.near_next == sum(
            a == b for a, b in zip(*(re.findall("." * 8, rows[k].fingerprint) for k in (key, keys[(i + 1) % n])))
        ) / 64
        assert abs(r.near_edited - jaccard(text, edited)) < 0.35 or not text


def test_words_refused_by_the_bound_change_no_sample(spark, monkeypatch, odd_docs):
    """A low bound leaves nearly every row unsure, an infinite one refuses no word."""
    own = spark.createDataFrame([(i + 100, prose(i, 7 * i)) for i in range(40)], "doc_id long, text string")
    docs = own.union(odd_docs.select("doc_id", "text"))

    def rows(reach):
        monkeypatch.setattr(weighted_sampling, "REACH", reach)
        return sorted(map(repr, weighted_sampling.with_edits(docs).collect()))

    assert rows(0.5) == rows(10.0) == rows(float("inf"))


def test_fingerprints_of_odd_rows(odd_docs, no_docs):
    rows = weighted_sampling.with_edits(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    empty = {r.fingerprint for r in rows if r.n_chars == 0}
    assert empty == {"f" * 512}
    assert len({r.fingerprint for r in rows if r.doc_id in (4, 5)}) == 1
    assert weighted_sampling.with_edits(no_docs).count() == 0


def test_distance_of_zero_links_equal_fingerprints_only(spark):
    docs = spark.createDataFrame([(1, "a b c d"), (2, "a b c d"), (3, "x y z"), (None, None)], "doc_id long, text string")
    got = {(r.doc_id, r.component_id) for r in simhash.near_duplicates(docs, distance=0).collect()}
    assert got == {(1, 1), (2, 1), (3, 3), (None, None)}
