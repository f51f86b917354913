"""BPE and unigram counts against the tokenizers library."""

import random

import public_tokenizers
import pytest
from tokenizers import Tokenizer, models, pre_tokenizers

from veilrank.llm import bpe, token_counts

BPE = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")
LETTERS = "abcdethéñÑ中日😀 \n\t'sßΣİ12½!?&\xa0\x1c<|endoftext|>"


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BPE)


def texts(seed, n, letters=LETTERS):
    draw = random.Random(seed)
    for _ in range(n):
        s = "".join(draw.choice(letters) for _ in range(draw.randint(0, 60)))
        yield s.replace("a", "<|endoftext|>") if draw.random() < 0.2 else s


def test_merges_equal_the_library(library):
    own = bpe.Vocabulary(BPE)
    for text in [*texts(1, 1500), "x" * 500, "they're we'll I'd 1999 don't", "aé" * 300]:
        ids = [i for w in own.words(text) for i in own.merge(w)]
        want = library.encode(text, add_special_tokens=False).ids
        assert ids == want, text
        assert own.decode(ids) == library.decode(want, skip_special_tokens=False)


def test_short_and_long_merges_agree():
    own = bpe.Vocabulary(BPE)
    draw = random.Random(2)
    for _ in range(300):
        word = "".join(draw.choice("etaoinsrh") for _ in range(draw.randint(17, 40)))
        parts = [own.letters[b] for b in word.encode()]
        parts[-1] += own.end
        assert own.merge(word) == [own.ids[p] for p in own.merge_short(parts)]


def test_automaton_is_minimal_and_exact():
    words = ["tap", "taps", "top", "tops", "é", "😀b"]
    lexicon = bpe.Lexicon(bpe.compile_words({w: [i, i + 1] for i, w in enumerate(words)}))
    order = sorted(words)
    found = lexicon.find([*order, "", "ta", "tapss", "zz", "x" * 100])
    assert found.tolist() == [*range(len(words)), -1, -1, -1, -1, -1]
    # t -> {a, o} -> p -> s shares the whole ending: 5 arcs, and 3 for the other words
    assert len(lexicon.key) == 8
    for i, w in enumerate(order):
        ids = lexicon.ids[lexicon.start[i] : lexicon.start[i + 1]].tolist()
        assert ids == [words.index(w), words.index(w) + 1]


def test_empty_lexicon():
    lexicon = bpe.Lexicon(bpe.compile_words({}))
    assert lexicon.find(["a", ""]).tolist() == [-1, -1]


@pytest.mark.parametrize("size", [0, 7, 100_000])
def test_encode_whatever_the_lexicon(odd_docs, library, size):
    docs = odd_docs.select("doc_id", "text", "ids")
    kept = docs.selectExpr("doc_id", "text", "text AS copy")
    rows = bpe.encode(kept, BPE, size).collect()
    assert len(rows) == docs.count() and "text" not in rows[0].asDict()
    for r in rows:
        want = library.encode(r.copy or "", add_special_tokens=False).ids
        assert r.ids == want and r.decoded == library.decode(want, skip_special_tokens=False)


def test_encode_no_rows(no_docs):
    assert bpe.encode(no_docs, BPE).count() == 0


def unigram(pieces, unknown=0, fallback=True):
    t = Tokenizer(models.Unigram(pieces, unknown, fallback))
    t.pre_tokenizer = pre_tokenizers.Metaspace(replacement="▁", prepend_scheme="always", split=True)
    return t


def test_counts_equal_the_library():
    pieces = token_counts.read_pieces(PIECES)
    library, own = unigram(pieces), token_counts.Counter(pieces)
    letters = "abcdethéñ中日😀 \n\t<unk>s0x41▁.,"
    for text in [*texts(3, 800, letters), "<unk>é<unk>", "  two  spaces ", "▁a", ""]:
        assert own.text(text)[0] == len(library.encode(text, add_special_tokens=False).ids), text


def test_ties_and_vocabularies_without_bytes():
    draw = random.Random(4)
    for _ in range(150):
        made = {"".join(draw.choice("ab▁") for _ in range(draw.randint(1, 4))) for _ in range(12)}
        pieces = [("<unk>", 0.0), *((p, float(-draw.randint(0, 3))) for p in sorted(made))]
        library, own = unigram(pieces, 0, False), token_counts.Counter(pieces)
        for _ in range(10):
            text = "".join(draw.choice("abc ") for _ in range(draw.randint(0, 14)))
            assert own.text(text)[0] == len(library.encode(text).ids), (text, pieces)


def test_count_tokens_of_odd_rows(odd_docs, no_docs):
    pieces = token_counts.read_pieces(PIECES)
    library = unigram(pieces)
    rows = token_counts.count_tokens(odd_docs.selectExpr("doc_id", "text", "text AS copy", "n_tokens"), pieces).collect()
    assert len(rows) == odd_docs.count()
    for r in rows:
        assert r.n_tokens == len(library.encode(r.copy or "", add_special_tokens=False).ids)
    assert token_counts.count_tokens(no_docs, pieces).count() == 0
