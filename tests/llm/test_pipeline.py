"""Each stage of the corpus pipeline against brute force on its own input."""

import re

import public_tokenizers
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from llm_prose import prose
from test_learned import base_spans, noise, spam
from test_near_copies import plain_components, plain_fingerprint

FIELDS = "doc_id long, text string, lang string, source string, n_chars long"
ITEMS = [(i, prose(7000 + i, 30)) for i in range(6)]


def documents():
    out = []
    for i in range(320):
        text = spam(i, 70) if i % 4 == 0 else prose(i, 120)
        if i % 10 == 1:
            text = out[i - 10] if i > 20 else text  # a chain of copies
        if i % 40 == 3:
            text += " " + ITEMS[i // 40 % 6][1]
        if i % 20 == 7:
            text += f" password: {noise(i, 18)} and {noise(i, 40, '0123456789abcdef')} é"
        out.append(text)
    return out


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("corpus"))
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(documents())]
    spark.createDataFrame(rows, FIELDS).write.parquet(f"{path}/documents.parquet")
    labels = [(i, int(i % 4 != 0)) for i in range(320)]
    spark.createDataFrame(labels, "doc_id long, quality int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(ITEMS, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path


@pytest.fixture(scope="module")
def stages(spark, folder, tmp_path_factory):
    """The rows before and after each stage."""
    out, docs = {}, spark.read.parquet(f"{folder}/documents.parquet")
    base = tmp_path_factory.mktemp("stages")
    for name, stage in corpus_pipeline.STAGES:
        path = str(base / name.replace(" ", "_"))
        stage(spark, docs, folder).write.parquet(path)
        after = spark.read.parquet(path)
        out[name] = ({r.doc_id: r for r in docs.collect()}, {r.doc_id: r for r in after.collect()})
        if name != corpus_pipeline.STAGES[-1][0]:
            assert after.columns == list(corpus_pipeline.COLUMNS)
        docs = after
    return out


def test_rejects_go_and_clean_documents_stay(stages):
    before, after = stages["quality classifier"]
    assert len(before) == 320
    kept = [i in after for i in before]
    right = sum(k == (i % 4 != 0) for i, k in zip(before, kept))
    assert right >= 0.97 * len(before)
    assert all(before[i] == r for i, r in after.items())


def test_one_of_each_group_stays(stages):
    before, after = stages["SimHash near-dedup"]
    order = sorted(before)
    roots = plain_components([plain_fingerprint(before[i].text) for i in order], 3)
    assert set(after) == {order[r] for r in roots}
    assert len(after) < len(before)


def test_documents_with_items_go(stages):
    before, after = stages["benchmark decontamination"]
    held = {i for i, r in before.items() if any(t in r.text for _, t in ITEMS)}
    assert held and set(after) == set(before) - held


def test_secrets_are_masked(stages):
    before, after = stages["secret scans"]
    assert set(before) == set(after)
    changed = 0
    for i, r in before.items():
        spans, text = base_spans(r.text), after[i].text
        assert after[i].n_chars == len(text)
        assert not any(r.text[a:b] in text for a, _, b in spans)
        changed += text != r.text
        if not spans and not re.search(r"[A-Za-z0-9+/_=-]{16,}", r.text):
            assert text == r.text
    assert changed


def test_ids_are_those_of_the_library(stages):
    before, after = stages["BPE encoding and decoding"]
    library = Tokenizer.from_file(str(public_tokenizers.path("word_bpe_49k.json")))
    library.no_truncation(), library.no_padding()
    assert set(before) == set(after)
    for i, r in after.items():
        assert list(r.ids) == library.encode(before[i].text, add_special_tokens=False).ids
        assert r.n_tokens == len(r.ids)


def test_run_is_all_stages(spark, folder, stages):
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, folder).collect()}
    assert got == stages[corpus_pipeline.STAGES[-1][0]][1]


def test_stages_of_odd_and_no_rows(spark, folder, odd_docs, no_docs):
    for name, stage in corpus_pipeline.STAGES:
        left = stage(spark, odd_docs, folder).collect()
        assert len(left) <= odd_docs.count(), name
        if name in ("secret scans", "BPE encoding and decoding"):
            assert len(left) == odd_docs.count()
        assert stage(spark, no_docs, folder).count() == 0, name


def rows_left(spark, folder, stage, rows):
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], FIELDS)
    return sorted(((r.doc_id, r.text) for r in dict(corpus_pipeline.STAGES)[stage](spark, docs, folder).collect()), key=str)


def test_one_copy_of_null_and_repeated_ids(spark, folder):
    texts = [prose(9000 + i, 60) for i in range(5)]
    rows = [(1, texts[0]), (3, texts[1]), (None, texts[0]), (None, texts[2]), (None, texts[3]), (7, texts[1]), (7, texts[4])]
    want = [(1, texts[0]), (3, texts[1]), (None, texts[2]), (None, texts[3]), (7, texts[4])]
    assert rows_left(spark, folder, "SimHash near-dedup", rows) == sorted(want, key=str)
    # a group without any id, rows that repeat, and texts without words
    rows = [(None, texts[0]), (None, texts[0]), (5, texts[1]), (5, texts[1]), (None, ""), (None, None), (8, " ")]
    assert rows_left(spark, folder, "SimHash near-dedup", rows) == sorted(
        [(None, texts[0]), (5, texts[1]), (8, " ")], key=str)


def test_benchmark_rows_of_null_and_repeated_ids(spark, folder):
    held = prose(9100, 40) + " " + ITEMS[2][1]
    clean = [prose(9101 + i, 60) for i in range(3)]
    rows = [(None, held), (None, clean[0]), (None, None), (7, held), (7, clean[1]), (8, clean[2]), (8, clean[2])]
    assert rows_left(spark, folder, "benchmark decontamination", rows) == sorted(
        [(None, clean[0]), (None, None), (7, clean[1]), (8, clean[2]), (8, clean[2])], key=str)


def test_good_rows_of_null_and_repeated_ids(spark, folder):
    docs = documents()
    good, bad = docs[5], docs[4]
    rows = [*enumerate(docs), (None, good), (None, bad), (1000, good), (1000, bad), (None, good)]
    left = rows_left(spark, folder, "quality classifier", rows)
    assert left.count((None, good)) == 2 and left.count((1000, good)) == 1
    assert (None, bad) not in left and (1000, bad) not in left
