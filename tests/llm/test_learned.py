"""Operators that learn: held-out accuracy, brute force where there is one, and odd rows."""

import random
import re
import time

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_prose import prose
from veilrank.llm import decontaminate, language, quality, secret_scan

SPAM = "buy now cheap click here best price free win prize offer limited subscribe deal".split()


def spam(seed: int, n: int) -> str:
    draw = random.Random(seed)
    return " ".join(draw.choice([draw.choice(SPAM), draw.choice(SPAM).upper(), "!!!"]) for _ in range(n))


def by_id(df):
    return {r.doc_id: r for r in df.collect()}


def test_quality_of_held_out_rows(spark):
    rows = [(i, prose(i, 60) if i % 2 else spam(i, 60)) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(250)], "doc_id long, quality int")
    model = quality.learn(docs, labels)
    got = by_id(quality.score(docs, *model))
    assert np.mean([got[i].predicted == i % 2 for i in range(250, 400)]) > 0.95
    assert all(r.predicted == (r.score >= 0.5) and 0 <= r.score <= 1 for r in got.values())
    again = by_id(quality.score(docs.repartition(7), *quality.learn(docs.repartition(5), labels)))
    # Sums of whole numbers do not depend on the tasks; products of matrices do in their last bits.
    assert {i: r.predicted for i, r in again.items()} == {i: r.predicted for i, r in got.items()}
    assert all(again[i].score == pytest.approx(r.score, rel=1e-6) for i, r in got.items())


def test_temperature_lowers_the_loss():
    draw = np.random.default_rng(3)
    x = draw.normal(size=(2000, 8)).astype(np.float32)
    y = (x[:, 0] + draw.normal(size=2000) > 0).astype(float)
    fresh = draw.normal(size=(4000, 8)).astype(np.float32)
    target = fresh[:, 0] + draw.normal(size=4000) > 0
    p = quality.train(x, y).probabilities(fresh)
    for low in (0.1, 0.4, 0.7):
        own = (p >= low) & (p < low + 0.2)
        assert abs(p[own].mean() - target[own].mean()) < 0.1


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 0), (2, 0), (4, 1), (5, 1), (5, None), (None, 1), (6, 7)], "doc_id long, quality int"
    )
    model = quality.learn(odd_docs, labels)
    rows = quality.score(odd_docs, *model).collect()
    assert len(rows) == odd_docs.count() and all(0 <= r.score <= 1 for r in rows)
    assert {r.key for r in rows} == {None}
    vectors, network = quality.learn(odd_docs, labels.where("false"))
    assert network.constant == 0.5
    assert quality.score(no_docs, *quality.learn(no_docs, labels)).count() == 0


def base_spans(text):
    """The base rules, one match after another."""
    out = []
    assign = r"(?i:(password|passwd|secret|token|api_?key))[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)"
    for m in re.finditer(assign, text or ""):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    for kind, pattern, least in ((1, r"AKIA[A-Z0-9]+", 20), (2, r"[0-9a-f]+", 24)):
        out += [(m.start(), kind, m.end()) for m in re.finditer(pattern, text or "") if len(m[0]) >= least]
    return sorted(out)


def noise(seed: int, n: int, letters: str = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789") -> str:
    return "".join(random.Random(seed).choices(letters, k=n))


SECRET_TEXTS = [
    None, "", "password: short", "PassWord = 'abcdef' and token=\"x.y-z_1\"", "apikey:a api_key=123456",
    "AKIA" + "A1" * 8, "AKIA" + "A" * 15, "xAKIAAKIA" + "Z9" * 10, "0" * 23, "a" * 24, "Zz" + "ab12" * 9 + "z",
    "é😀 secret=" + "q" * 50 + " 😀 " + "f0" * 20, "token = = abcdef", "password=abcdef password=abcdef",
    "tokentoken:abcdef0123456789abcdef0123", "\n".join(f"token={noise(i, 12)}" for i in range(3000)), "x" * 150_000,
    *(f"{prose(i, 30)} secret: {noise(i, 24)} {prose(i, 9)} {noise(i, 40, '0123456789abcdef')}" for i in range(40)),
]


def test_base_spans_equal_plain_matching(spark):
    docs = spark.createDataFrame(list(enumerate(SECRET_TEXTS)), "doc_id long, text string")
    found = secret_scan.scan(docs, secret_scan.train(secret_scan.samples(docs)))
    for r in found.collect():
        spans = [tuple(s) for s in r.secrets]
        assert [s for s in spans if s[1] != 3] == base_spans(r.text), r.doc_id
        base = [s for s in spans if s[1] != 3]
        assert not any(a[0] < b[2] and b[0] < a[2] for a in base for b in spans if b[1] == 3)


def identifier(seed: int) -> str:
    """Snake case, camel case, capitals, or with a number."""
    words = prose(seed, 3).split()
    return [
        "_".join(words), words[0] + "".join(w.title() for w in words[1:]), "_".join(words).upper(),
        "".join(w.title() for w in words[:2]) + str(seed % 100),
    ][seed % 4]


def test_random_strings_against_identifiers(spark):
    labelled = [(x, y) for i in range(2000) for x, y in ((noise(i, 32), 1), (identifier(i), 0))]
    labelled += [(None, 1), ("a", 0), ("é?", 1), ("abc", None)]
    weights = secret_scan.train(spark.createDataFrame(labelled, "value string, label int"))
    fresh = [noise(10_000 + i, 32) for i in range(100)] + [identifier(9000 + i) for i in range(100)]
    docs = spark.createDataFrame([(i, f"see {x} here") for i, x in enumerate(fresh)], "doc_id long, text string")
    got = by_id(secret_scan.scan(docs, weights))
    hits = [bool(got[i].secrets) for i in range(200)]
    assert sum(hits[:100]) >= 95 and sum(hits[100:]) == 0
    assert all(got[i].text[s.start : s.end] == fresh[i] for i in range(200) for s in got[i].secrets)


def test_masked(spark):
    text = "token=abcdef0123456789abcdef01 é AKIA" + "B2" * 8
    docs = spark.createDataFrame([(1, text), (2, "plain"), (3, None)], "doc_id long, text string")
    found = secret_scan.scan(docs, secret_scan.train(secret_scan.samples(docs)))
    rows = by_id(found.withColumn("out", secret_scan.masked(F.col("text"), F.col("secrets"))))
    assert [rows[i].out for i in (1, 2, 3)] == ["<SECRET> é <SECRET>", "plain", None]


def test_secrets_of_odd_rows(odd_docs, no_docs):
    rows = secret_scan.scan(odd_docs, secret_scan.train(secret_scan.samples(odd_docs))).collect()
    assert len(rows) == odd_docs.count()
    assert all([tuple(s) for s in r.secrets if s.kind != 3] == base_spans(r.text) for r in rows)
    weights = secret_scan.train(secret_scan.samples(no_docs))
    assert set(weights) == {0}
    assert secret_scan.scan(no_docs, weights).count() == 0


TONGUES = {
    "aa": "the of and to in that with was for which on had".split(),
    "bb": "der die und das ist nicht ein mit sich auf für wird".split(),
    "cc": "que los una por con del para está más como pero año".split(),
}


def speech(tongue: str, seed: int, n: int) -> str:
    draw = random.Random(f"{tongue}{seed}")
    return " ".join(draw.choice(TONGUES[tongue]) for _ in range(n))


def test_languages_of_held_out_rows(spark):
    rows = [(i, speech(t, i, 20), t) for i, t in enumerate(list(TONGUES) * 60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    model = language.learn(docs.where("doc_id < 90"))
    fresh = docs.where("doc_id >= 90")
    got = by_id(language.identify(fresh, model))
    assert np.mean([got[i].lang_pred == t for i, _, t in rows[90:]]) > 0.97
    assert all(0 <= r.score <= 1 for r in got.values())
    mixed = [(1, speech("aa", 1, 300) + " " + speech("bb", 1, 100)), (2, speech("cc", 1, 10) + " " + speech("bb", 2, 90))]
    mixed = by_id(language.identify(spark.createDataFrame(mixed, "doc_id long, text string"), model))
    assert mixed[1].lang_pred == "aa" and abs(mixed[1].score - 0.75) < 0.1
    assert mixed[2].lang_pred == "bb" and mixed[2].score > 0.8


def test_mixture_in_batches_equals_one_text_alone(spark):
    texts = [speech(t, i, n) for i, (t, n) in enumerate([("aa", 1), ("bb", 400), ("cc", 30), ("aa", 55)])]
    counts = {t: np.zeros(language.CELLS, np.int64) for t in TONGUES}
    for t in TONGUES:
        counts[t] += np.bincount(language.trigrams([speech(t, 7, 500)])[0], minlength=language.CELLS)
    table = language.log_likelihoods(counts)
    choice, score = language.infer(texts, table)
    for i, text in enumerate(texts):
        one, own = language.infer([text], table)
        assert one[0] == choice[i] and own[0] == pytest.approx(score[i])


def test_languages_of_odd_rows(odd_docs, no_docs):
    model = language.learn(odd_docs)
    rows = language.identify(odd_docs, model).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        letter = r.doc_id not in (1, 2, 3) and not (r.doc_id is None and r.score == 0)
        assert r.lang_pred == ("en" if letter else "und")
    assert {r.lang_pred for r in language.identify(odd_docs, {}).collect()} == {"und"}
    assert language.learn(no_docs) == {}
    assert language.identify(no_docs, model).count() == 0


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_common_length():
    draw = np.random.default_rng(5)
    for _ in range(50):
        a, b = draw.integers(0, 6, draw.integers(1, 90)), draw.integers(0, 6, draw.integers(1, 120))
        assert decontaminate.common_length(a, b) == plain_lcs(a.tolist(), b.tolist())


def test_row_sums():
    draw = np.random.default_rng(6)
    table = draw.normal(size=(50, 7))
    starts = np.array([0, 1, 4, 5, 20, 22])
    own = draw.integers(0, 50, 40)
    want = np.add.reduceat(table[own], starts, axis=0)
    assert np.allclose(decontaminate._row_sums(table, own, starts), want)
    assert decontaminate._row_sums(table, own[:0], starts[:0]).shape == (0, 7)


def test_items_in_documents(spark):
    items = [(i, prose(5000 + i, 20 + 3 * i)) for i in range(12)]
    rows, want = [], set()
    for i in range(240):
        words = prose(i, 150).split()
        if i % 4 == 0:
            item = i // 4 % 12
            own = items[item][1].split()
            if i % 8 == 0:  # a paraphrase: one word in eight is another
                own = [w if k % 8 else "other" for k, w in enumerate(own)]
            at = i % 130
            words[at:at] = own
            want.add((i, item))
        rows.append((i, " ".join(words)))
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = decontaminate.contaminated(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id) for r in found} == want
    assert all(r.cosine >= decontaminate.COSINE and r.overlap >= decontaminate.OVERLAP for r in found)


def edited_copies():
    """Items and documents that hold them with two words in five changed; a third of them hold item 0."""
    draw = random.Random(31)

    def words(n):
        return [f"w{int(draw.random() ** 3 * 3000)}" for _ in range(n)]  # some words are frequent

    items = [words(n) for n in (60, 24, 30, 36, 45, 90, 13, 150)]
    rows = []
    for i in range(300):
        text = words(150)
        if i % 3 == 0 or i % 5 == 0:
            own = list(items[0 if i % 3 == 0 else i // 5 % len(items)])
            for k in draw.sample(range(len(own)), 2 * len(own) // 5):
                own[k] = f"w{draw.randrange(3000)}"
            at = draw.randrange(150)
            text[at:at] = own
        rows.append(text)
    return items, rows


def test_edited_items_against_all_pairs(spark, monkeypatch):
    items, rows = edited_copies()
    names: dict[str, int] = {}

    def ids(words):
        return np.array([names.setdefault(w, len(names)) for w in words])

    want = set()
    for n, item in enumerate(items):
        answer = item[-(-3 * len(item) // 4):]
        for i, text in enumerate(rows):
            shared = decontaminate.common_length(ids(item), ids(text)) / len(item)
            told = decontaminate.common_length(ids(answer), ids(text)) / len(answer)
            if shared >= decontaminate.OVERLAP and told >= decontaminate.ANSWER:
                want.add((i, n))
    docs = spark.createDataFrame([(i, " ".join(r)) for i, r in enumerate(rows)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(n, " ".join(x)) for n, x in enumerate(items)], "item_id long, text string")

    def found():
        return {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}

    first = found()
    assert len(want) > 90 and sum(n == 0 for _, n in want) > 60
    assert first <= want and len(first) >= 0.9 * len(want)
    monkeypatch.setattr(decontaminate, "BLOCK", 3)  # the size of the slices changes nothing
    monkeypatch.setattr(decontaminate, "SLICE", 7)
    assert found() == first


def test_refused_windows_hold_no_item():
    draw = np.random.default_rng(8)
    items = [decontaminate.Item(i, draw.integers(0, 40, n), np.zeros(1, int)) for i, n in enumerate((5, 20, 60))]
    ids = draw.integers(-1, 40, 5000)
    begin = draw.integers(0, 4800, 400)
    end, which = begin + draw.integers(0, 200, 400), draw.integers(0, 3, 400)
    may = decontaminate.may_hold(ids, begin, end, which, items, 40)
    assert 0 < may.sum() < 400
    for b, e, n, m in zip(begin, end, which, may):
        own = items[n].ids.tolist()
        shared = sum(min(own.count(w), ids[b:e].tolist().count(w)) for w in set(own))
        assert m == (shared / len(own) >= decontaminate.OVERLAP)
        assert m or decontaminate.common_length(items[n].ids, ids[b:e]) < decontaminate.OVERLAP * len(own)
    assert not len(decontaminate.may_hold(ids, begin[:0], end[:0], which[:0], items, 40))


def test_items_of_one_and_two_words(spark):
    docs = spark.createDataFrame([(1, "some rare thing"), (2, "quite another"), (3, "the two words here"), (4, "words two")],
                                 "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, "Rare"), (2, "two words")], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontaminate.contaminated(docs, benchmark).collect()}
    assert found == {(1, 1), (3, 2)}


def test_items_in_odd_rows(spark, odd_docs, no_docs):
    items = [(1, prose(1, 80)), (2, None), (3, ""), (None, "one two"), (4, prose(1, 80)), (5, prose(3, 40))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    found = [(r.doc_id, r.item_id) for r in decontaminate.contaminated(odd_docs, benchmark).collect()]
    assert sorted(found) == [(4, 1), (4, 4), (5, 1), (5, 1), (5, 4), (5, 4), (6, 5)]
    assert decontaminate.contaminated(no_docs, benchmark).count() == 0
    assert decontaminate.contaminated(odd_docs, benchmark.where("false")).count() == 0


def test_pieces_of_random_strings_beside_base_spans(spark):
    labelled = [(x, y) for i in range(2000) for x, y in ((noise(i, 32), 1), (identifier(i), 0))]
    weights = secret_scan.train(spark.createDataFrame(labelled, "value string, label int"))
    key, rest = "AKIA" + "Q7" * 8, noise(77_000, 40)
    texts = [f"é {key}/{rest} end", f"{rest}/{'0a1b' * 7}-{rest}", f"token={rest}", rest]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    found = secret_scan.scan(docs, weights)
    rows = by_id(found.withColumn("out", secret_scan.masked(F.col("text"), F.col("secrets"))))
    assert rows[0].out == "é <SECRET><SECRET> end"
    assert [tuple(s)[1] for s in rows[0].secrets] == [1, 3] and rows[0].text[rows[0].secrets[1].start:][:41] == "/" + rest
    assert rest not in rows[1].out and "0a1b" not in rows[1].out and rows[2].out == "<SECRET>" and rows[3].out == "<SECRET>"


def test_masks_of_very_many_secrets_take_linear_time(spark):
    one = "password: abcdefgh1234 é "
    docs = spark.createDataFrame([(1, one * 32_000)], "doc_id long, text string")
    found = secret_scan.scan(docs, [0] * len(secret_scan.ALPHABET) ** 2)
    started = time.perf_counter()
    row = found.select(secret_scan.masked(F.col("text"), F.col("secrets")).alias("out")).first()
    assert row.out == "<SECRET> é " * 32_000
    assert time.perf_counter() - started < 30
