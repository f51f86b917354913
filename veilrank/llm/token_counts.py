"""Exact token counts of a unigram vocabulary without building tokens.

An Aho-Corasick automaton names every piece that ends at a character.  The best score of each prefix
is carried with the number of tokens that reach it, so neither a lattice nor a token list is kept.
The rules are those of the unigram model in the ``tokenizers`` library: a space opens a piece-wise
word, scores are added in double precision, of equal scores the piece that starts first stays, a
character without a piece of its own costs ten less than the lowest score, and a run of such
characters becomes its bytes where the vocabulary has byte pieces and one token else.

No vocabulary on hand is a trained unigram model, and none is trained here: the pieces and scores
are taken as the vocabulary file states them.
"""

from __future__ import annotations

from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame

from veilrank.llm.arrow import replaced, replaced_schema, text_chunks

MARK = "▁"
_PENALTY = 10.0
_HELD = 200_000
_LONGEST = 48


def read_pieces(path: str) -> list[tuple[str, float]]:
    """Pieces and scores of a sentencepiece file, in the order of their ids."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    return [(model.id_to_piece(i), model.get_score(i)) for i in range(model.get_piece_size())]


class Counter:
    """Counts the tokens of words; ``unknown`` is the id of the unknown piece."""

    def __init__(self, pieces: list[tuple[str, float]], unknown: int = 0):
        self.automaton = ahocorasick.Automaton()
        names = {}
        for i, (piece, score) in enumerate(pieces):
            names[piece] = (score, i)
        for piece, (score, i) in names.items():
            if piece:
                self.automaton.add_word(piece, (len(piece), score, i == unknown))
        self.automaton.make_automaton()
        self.bytes = all(f"<0x{b:02X}>" in names for b in range(256))
        self.low = min((s for _, s in pieces), default=0.0) - _PENALTY
        self.held: dict[str, tuple[int, float]] = {}

    def run(self, length: int, literal: bool) -> int:
        """Tokens of a run of unknown characters of so many bytes."""
        return length if self.bytes and length and not literal else int(length > 0)

    def count(self, word: str) -> tuple[int, float]:
        """Tokens and score of the best path through a word."""
        n = len(word)
        score: list = [0.0] + [None] * n
        tokens = [0] * (n + 1)  # before the run of unknowns that ends here
        unknown = [0] * (n + 1)  # bytes of that run
        literal = [False] * (n + 1)  # the run is the unknown piece itself, once
        single = [False] * (n + 1)

        def offer(end: int, start: int, value: float, is_unknown: bool, written: bool) -> None:
            total = value + score[start]
            if score[end] is not None and not total > score[end]:
                return
            score[end] = total
            if is_unknown:
                tokens[end] = tokens[start]
                unknown[end] = unknown[start] + len(word[start:end].encode("utf-8", "replace"))
                literal[end] = written and not unknown[start]
            else:
                tokens[end] = tokens[start] + self.run(unknown[start], literal[start]) + 1
                unknown[end], literal[end] = 0, False

        done = 0

        def close(upto: int) -> None:
            """Characters without a piece of their own get the unknown piece as the last offer."""
            nonlocal done
            while done < upto:
                done += 1
                if not single[done]:
                    offer(done, done - 1, self.low, True, False)

        for last, (length, value, is_unknown) in self.automaton.iter(word):
            close(last)
            if length == 1:
                single[last + 1] = True
            offer(last + 1, last + 1 - length, value, is_unknown, is_unknown)
        close(n)
        return tokens[n] + self.run(unknown[n], literal[n]), score[n]

    def text(self, text: str) -> tuple[int, float]:
        """Tokens and score of a whole text: the sum over its words."""
        words = text.replace(MARK, " ").split(" ")
        if not words[0] and len(words) > 1:
            words = words[1:]  # the text opens with a space itself
        tokens, score, held = 0, 0.0, self.held
        for word in words if text else ():
            known = held.get(word)
            if known is None:
                known = self.count(MARK + word)
                if len(word) <= _LONGEST:
                    if len(held) >= _HELD:
                        held.clear()
                    held[word] = known
            tokens += known[0]
            score += known[1]
        return tokens, score


def count_tokens(docs: DataFrame, pieces: list[tuple[str, float]], unknown: int = 0) -> DataFrame:
    """``docs`` with ``n_tokens`` and ``token_score`` instead of the text; a null or empty text has no tokens and score 0.

    Columns of these names are replaced, all other columns and repeated rows stay.  A text is one
    pass in linear time; only a text without any space keeps as many numbers as it has characters.
    """
    docs = docs.drop("n_tokens", "token_score")
    sent = docs.sparkSession.sparkContext.broadcast(pieces)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(sent.value, unknown)
        for batch in batches:
            for part, texts in text_chunks(batch):
                found = [counter.text(t) for t in texts]
                yield replaced(part, ["n_tokens", "token_score"], [
                    pa.array([n for n, _ in found], pa.int64()),
                    pa.array([s for _, s in found], pa.float64()),
                ])

    new = "n_tokens long, token_score double"
    return docs.mapInArrow(run, replaced_schema(docs.schema, new))
