"""Byte-pair encoding and decoding with a minimal acyclic transducer for the frequent words.

The word counts of all texts give the frequent words.  They are encoded once and compiled into a
minimal acyclic automaton: words share their prefixes and their suffixes, and the number of words
that lie before an arc gives each word its own index, which points at its ids.  The automaton is
a block of sorted arrays that every Python worker maps from a file.  Batches of words walk it
together, one character a step; a word that falls off is merged exactly, pair by pair in the order
of the merge table.  Every word is encoded by the vocabulary's rules alone, so which words are
frequent changes the time and never the result.

Text is cut as the vocabulary file's own settings say: special tokens first, then NFC, white space,
lower case, then words.  Files with other settings are refused.  Characters that Python's Unicode
tables do not know yet may be classed otherwise than by newer ones.
"""

from __future__ import annotations

import heapq
import json
import mmap
import re
import tempfile
import unicodedata
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilrank.llm.arrow import replaced, replaced_schema, text_chunks
from veilrank.session import materialize

#: Words longer than this are never in the automaton; they are merged.
LONGEST = 32
_HELD = 200_000  # merged words that a worker remembers, and words that it counts before it tells


def _byte_letters() -> list[str]:
    """The visible character that stands for each byte in byte-level vocabularies."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    letters, rest = [""] * 256, 256
    for byte in range(256):
        if byte in shown:
            letters[byte] = chr(byte)
        else:
            letters[byte] = chr(rest)
            rest += 1
    return letters


def _latin_pattern(pattern: str) -> re.Pattern:
    """The pattern with its classes spelt out for texts of Latin-1 alone, letters first."""
    letters, numbers, space = "A-Za-zªµºÀ-ÖØ-öø-ÿ", "0-9²³¹¼-¾", r"\t-\r \x85\xa0"
    kinds = {r"[\p{L}]+": f"[{letters}]+", r"[\p{N}]": f"[{numbers}]",
             r"[^\s\p{L}\p{N}]+": f"[^{space}{letters}{numbers}]+"}
    parts = pattern.split("|")
    if parts[-3:] != list(kinds) or not all(re.fullmatch("'[a-z]+", x) for x in parts[:-3]):
        raise ValueError(f"words are cut by other rules: {pattern}")
    # An ending and a letter never begin alike, so their order is free.
    return re.compile("|".join([kinds[parts[-3]], *parts[:-3], *map(kinds.get, parts[-2:])]))


class _Codes(dict):
    """A number for each word, in order of its first use."""

    def __missing__(self, word: str) -> int:
        self[word] = code = len(self)
        return code


class Vocabulary:
    """Ids, merges and cutting rules of a tokenizer file of the word-end kind."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model, cut = spec["model"], spec["pre_tokenizer"]["pretokenizers"][0]
        kinds = [n["type"] for n in spec["normalizer"]["normalizers"]]
        if model["type"] != "BPE" or kinds != ["NFC", "Replace", "Lowercase"] or not cut["invert"]:
            raise ValueError(f"{path} has other rules than the word-end kind")
        self.ids = {**model["vocab"], **{t["content"]: t["id"] for t in spec["added_tokens"]}}
        self.end = model["end_of_word_suffix"]
        self.special = [t["content"] for t in spec["added_tokens"]]
        self.ranks = {tuple(pair): i for i, pair in enumerate(model["merges"])}
        self.pattern = cut["pattern"]["Regex"]
        self.letters = _byte_letters()
        self.names = [""] * (max(self.ids.values()) + 1)
        for name, i in self.ids.items():
            self.names[i] = name
        self.ready()

    def ready(self) -> None:
        self._words = regex.compile(self.pattern)
        self._latin = _latin_pattern(self.pattern)
        special = sorted(self.special, key=len, reverse=True)
        self._special = regex.compile("(" + "|".join(map(regex.escape, special)) + ")")

    def __getstate__(self):
        return {k: v for k, v in self.__dict__.items() if k[0] != "_"}

    def __setstate__(self, state):
        self.__dict__.update(state)
        self.ready()

    def words(self, text: str) -> list[str]:
        """The words of a text; a special token is a word of its own."""
        if any(s in text for s in self.special):
            out = []
            for i, part in enumerate(self._special.split(text)):
                out += [part] if i % 2 else self.words_of_part(part)
            return out
        return self.words_of_part(text)

    def words_of_part(self, text: str) -> list[str]:
        # Words hold no white space, so its folding to one space changes none of them.  Each
        # character is lowered by itself: no final sigma.
        text = unicodedata.normalize("NFC", text).replace("Σ", "σ").lower()
        try:
            text.encode("latin-1")
        except UnicodeEncodeError:
            return self._words.findall(text)
        return self._latin.findall(text)

    def merge(self, word: str) -> list[int]:
        """The ids of a word by exact merging: the lowest rank first, the leftmost of equal ones."""
        if word in self.special:
            return [self.ids[word]]
        parts: list = [self.letters[b] for b in word.encode("utf-8", "replace")]
        parts[-1] += self.end
        if len(parts) <= 16:
            return [self.ids[p] for p in self.merge_short(parts)]
        n = len(parts)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        ranks = self.ranks
        heap = [
            (r, i) for i in range(n - 1) if (r := ranks.get((parts[i], parts[i + 1]))) is not None
        ]
        heapq.heapify(heap)
        while heap:
            rank, i = heapq.heappop(heap)
            j = after[i]
            if parts[i] is None or j >= n or ranks.get((parts[i], parts[j])) != rank:
                continue
            parts[i] += parts[j]
            parts[j] = None
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
                if (r := ranks.get((parts[i], parts[after[i]]))) is not None:
                    heapq.heappush(heap, (r, i))
            if (k := before[i]) >= 0 and (r := ranks.get((parts[k], parts[i]))) is not None:
                heapq.heappush(heap, (r, k))
        return [self.ids[p] for p in parts if p is not None]

    def merge_short(self, parts: list[str]) -> list[str]:
        """The same order of merges by looking at all pairs each time."""
        find, none = self.ranks.get, len(self.ranks)
        pairs = [find(pair, none) for pair in zip(parts, parts[1:])]
        while pairs:
            rank = min(pairs)
            if rank == none:
                break
            i = pairs.index(rank)
            parts[i] += parts.pop(i + 1)
            pairs.pop(i)
            if i < len(pairs):
                pairs[i] = find((parts[i], parts[i + 1]), none)
            if i:
                pairs[i - 1] = find((parts[i - 1], parts[i]), none)
        return parts

    def decode(self, ids: list[int]) -> str:
        """Token names joined by a space: the file names no decoder, so that is its decoding."""
        return " ".join(self.names[i] for i in ids)


# Fields of the block, in this order: arcs sorted by (state, character), then the outputs.
_FIELDS = (("key", np.int64), ("target", np.int32), ("before", np.int32), ("final", np.int8),
           ("start", np.int64), ("ids", np.int32))


def compile_words(entries: dict[str, list[int]]) -> bytes:
    """The block of the minimal automaton of the words; an arc's key is state << 21 | character."""
    arcs: list[list[tuple[str, int]]] = []  # of finished states
    final: list[bool] = []
    count: list[int] = []  # words below a state, itself included
    same: dict[tuple, int] = {}  # finished states by what they accept
    path: list[list] = [[[], False]]  # of the word in hand: [finished arcs, is final]

    def close(down_to: int, letters: str) -> None:
        while len(path) > down_to + 1:
            done, is_final = path.pop()
            signature = (is_final, *done)
            state = same.get(signature)
            if state is None:
                state = same[signature] = len(arcs)
                arcs.append(done)
                final.append(is_final)
                count.append(is_final + sum(count[t] for _, t in done))
            path[-1][0].append((letters[len(path) - 1], state))

    last = ""
    words = sorted(entries)
    for word in words:
        shared = 0
        while shared < min(len(last), len(word)) and last[shared] == word[shared]:
            shared += 1
        close(shared, last)
        path.extend([[], False] for _ in word[shared:])
        path[-1][1] = True
        last = word
    close(0, last)
    root, root_final = path[0]
    arcs.append(root)
    final.append(root_final)

    key, target, before = [], [], []
    # The root becomes state 0, the others follow: state s is written as s + 1, the root as 0.
    for state, name in [(len(arcs) - 1, 0), *((s, s + 1) for s in range(len(arcs) - 1))]:
        seen = int(final[state])
        for letter, t in arcs[state]:
            key.append(name << 21 | ord(letter))
            target.append(t + 1)
            before.append(seen)
            seen += count[t]
    ends = [final[-1], *final[:-1]]
    lengths = [len(entries[w]) for w in words]
    flat = [i for w in words for i in entries[w]]
    fields = (key, target, before, ends, np.concatenate([[0], np.cumsum(lengths)]) if words else [0], flat)
    arrays = [np.asarray(v, dtype=t) for v, (_, t) in zip(fields, _FIELDS)]
    head = np.asarray([len(a) for a in arrays], np.int64).tobytes()
    return head + b"".join(a.tobytes() + b"\0" * (-a.nbytes % 8) for a in arrays)


class Lexicon:
    """The mapped block; its file has no name any more once it is mapped."""

    def __init__(self, block: bytes):
        with tempfile.TemporaryFile() as file:
            file.write(block)
            file.flush()
            self.map = mmap.mmap(file.fileno(), 0, access=mmap.ACCESS_READ)
        sizes = np.frombuffer(self.map, np.int64, len(_FIELDS))
        at = 8 * len(_FIELDS)
        for (name, kind), n in zip(_FIELDS, sizes):
            setattr(self, name, np.frombuffer(self.map, kind, int(n), at))
            at += int(n) * np.dtype(kind).itemsize
            at += -at % 8

    def find(self, words: list[str]) -> np.ndarray:
        """The index of each word, -1 where it is not in the lexicon."""
        index = np.full(len(words), -1, np.int64)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        if not len(words) or not len(self.key):
            return index
        letters = np.frombuffer("".join(words).encode("utf-32-le", "surrogatepass"), np.uint32)
        offset = np.cumsum(lengths) - lengths
        alive = np.flatnonzero((lengths > 0) & (lengths <= LONGEST))
        state = np.zeros(len(alive), np.int64)
        rank = np.zeros(len(alive), np.int64)
        step = 0
        while len(alive):
            wanted = state << 21 | letters[offset[alive] + step]
            arc = np.minimum(np.searchsorted(self.key, wanted), len(self.key) - 1)
            there = self.key[arc] == wanted
            alive, arc, rank = alive[there], arc[there], rank[there]
            rank = rank + self.before[arc]
            state = self.target[arc].astype(np.int64)
            step += 1
            ended = lengths[alive] == step
            hit = ended & (self.final[state] == 1)
            index[alive[hit]] = rank[hit]
            alive, state, rank = alive[~ended], state[~ended], rank[~ended]
        return index


def frequent_words(texts: DataFrame, vocabulary: Vocabulary, size: int) -> list[str]:
    """At most ``size`` of the most frequent words of all texts.

    The counts' orders of magnitude, in eighths, give the count from which all words fit.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter = Counter()

        def told() -> pa.RecordBatch:
            rows = pa.RecordBatch.from_arrays(
                [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())],
                names=["word", "n"],
            )
            held.clear()
            return rows

        for batch in batches:
            for _, chunk in text_chunks(batch):
                for text in chunk:
                    held.update(w for w in vocabulary.words(text) if len(w) <= LONGEST)
                    if len(held) > _HELD:
                        yield told()
        yield told()

    counts = texts.select("text").mapInArrow(count, "word string, n long")
    totals = counts.groupBy("word").agg(F.sum("n").alias("n")).where("n > 1")
    totals = materialize(totals.withColumn("level", F.floor(F.log2("n") * 8).cast("int")), "words")
    least, left = None, size
    for level, n in sorted(totals.groupBy("level").count().collect(), reverse=True):  # 504 rows at most
        left -= n
        if left < 0:
            break
        least = level
    if least is None:
        return []
    return [r.word for r in totals.where(F.col("level") >= least).select("word").collect()]


def encode(docs: DataFrame, path: str, lexicon_size: int = 65_536, decode: bool = True) -> DataFrame:
    """``docs`` with ``ids`` instead of the text and, if asked for, the text that they decode to.

    A null or empty text has no ids and decodes to an empty text.  Repeated rows stay.  Columns
    named ``ids`` or ``decoded`` are replaced.  The lexicon holds ``lexicon_size`` words
    at most, whatever the size of the corpus; it is sent to every worker.
    """
    vocabulary = Vocabulary(path)
    docs = docs.drop("ids", "decoded")
    common = frequent_words(docs, vocabulary, lexicon_size)
    block = compile_words({w: vocabulary.merge(w) for w in common})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, lexicon = vocabulary, Lexicon(block)
        lexicon_ids, lexicon_start = lexicon.ids, lexicon.start
        merged: dict[str, list[int]] = {}
        for batch in batches:
            for part, texts in text_chunks(batch):
                per_text, codes, seen = [], [], _Codes()
                for text in texts:
                    words = own.words(text)
                    per_text.append(len(words))
                    codes += map(seen.__getitem__, words)
                words = list(seen)
                found = lexicon.find(words)
                unique: list[list[int]] = []
                for word, k in zip(words, found.tolist()):
                    if k >= 0:
                        ids = lexicon_ids[lexicon_start[k] : lexicon_start[k + 1]].tolist()
                    else:
                        ids = merged.get(word)
                        if ids is None:
                            ids = own.merge(word)
                            if len(word) <= LONGEST:
                                if len(merged) >= _HELD:
                                    merged.clear()
                                merged[word] = ids
                    unique.append(ids)
                sizes = np.fromiter(map(len, unique), np.int64, len(unique))
                starts = np.cumsum(sizes) - sizes
                flat = np.fromiter((i for ids in unique for i in ids), np.int32, int(sizes.sum()))
                code = np.asarray(codes, np.int64)
                size = sizes[code]
                ends = np.cumsum(size)
                where = np.repeat(starts[code] - (ends - size), size) + np.arange(int(size.sum()))
                word_ends = np.concatenate([[0], np.cumsum(per_text)]).astype(np.int64)
                id_ends = np.concatenate([[0], ends])[word_ends].astype(np.int32)
                arrays = [pa.ListArray.from_arrays(pa.array(id_ends), pa.array(flat[where]))]
                if decode:
                    shown = [own.decode(ids) for ids in unique]
                    arrays.append(pa.array(
                        [" ".join([shown[c] for c in codes[a:b]])
                         for a, b in zip(word_ends[:-1].tolist(), word_ends[1:].tolist())],
                        pa.string(),
                    ))
                yield replaced(part, ["ids", "decoded"][: len(arrays)], arrays)

    new = "ids array<int>" + (", decoded string" if decode else "")
    return docs.mapInArrow(run, replaced_schema(docs.schema, new))
