"""Benchmark items found in documents by latent semantic retrieval, and checked word by word.

Texts become ids of the words that benchmark items use.  Passages of a fixed number of words make a
TF-IDF table over all documents; its strongest directions come from a randomised SVD whose two passes
are sums over all passages, so only tables of terms by directions leave the tasks.  Columns are
scaled to the length of their IDF for the SVD, so that a frequent word does not count for its frequency
alone, and the items' own passages are part of the table.  Passages and items are folded into the
latent space, and a passage that is near an item's passage by cosine is a candidate.  A candidate holds
if the longest common subsequence of the item's words and the words around the passage covers enough of
the item, and enough of its answer.

All items share one vocabulary, one coded copy of the documents and one latent space, whose tables grow with
the words of the benchmark and not with the documents.  Passages are searched for ``BLOCK`` at a time, which bounds the
table of cosines and changes no result.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilrank.llm.arrow import SUMS, collect_sums, replaced, replaced_schema, sum_rows, text_chunks
from veilrank.session import materialize

HALF = 12  # words in half a passage; passages overlap by that
DIRECTIONS, MORE = 256, 16  # of the latent space, and further ones while it is searched
RARE = 8  # words of every passage of an item that are kept however common they are
COMMON = 0.01  # share of passages from which a word is left out otherwise
ITEM_WEIGHT = 3.0
LEAST_WORDS = 3  # kept words in a passage that is looked at, or all those of the shortest item if fewer
COSINE = 0.5
OVERLAP = 0.6  # share of the item's words in the longest common subsequence
ANSWER = 0.5  # share of the answer's words
BLOCK = 2048  # item passages whose cosines are worked out at a time
SLICE = 16_384  # candidates checked at a time
_FIX = 1 << 24  # sums are carried in whole numbers of this fraction
_ROWS = 64


def words_of(text: str | None) -> list[str]:
    return (text or "").lower().split()


@dataclass
class Item:
    item_id: int
    ids: np.ndarray
    answer: np.ndarray


def _split(ids: np.ndarray) -> list[tuple[int, np.ndarray]]:
    """Passages of an item with their offsets."""
    ends = max(1, -(-len(ids) // HALF) - 1)
    return [(i * HALF, ids[i * HALF : (i + 2) * HALF]) for i in range(ends)]


def encode(docs: DataFrame, vocabulary: dict[str, int]) -> DataFrame:
    """``docs`` with ``ids`` instead of the text: 32-bit numbers, -1 for words no item has."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        find = vocabulary.get
        for batch in batches:
            for part, texts in text_chunks(batch):
                ids = [np.array([find(w, -1) for w in words_of(t)], np.int32).tobytes() for t in texts]
                yield replaced(part, ["ids"], [pa.array(ids, pa.binary())])

    return docs.mapInArrow(run, replaced_schema(docs.schema, "ids binary"))


def _texts(batch: pa.RecordBatch, most: int = 400_000) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows of a batch in parts: first row, all word ids, and the number of words of each row."""
    parts: list[np.ndarray] = []
    start, held = 0, 0
    for i, data in enumerate(batch.column("ids")):
        own = np.frombuffer(data.as_buffer(), np.int32)
        if parts and held + len(own) > most:
            yield start, np.concatenate(parts), np.array([len(p) for p in parts])
            start, held, parts = i, 0, []
        parts.append(own)
        held += len(own)
    if parts:
        yield start, np.concatenate(parts), np.array([len(p) for p in parts])


def _places(sizes: np.ndarray, width: int) -> np.ndarray:
    """A number for each word that is equal within runs of ``width`` words of one text, ascending."""
    runs = -(-sizes // width)
    first = np.cumsum(runs) - runs
    ends = np.cumsum(sizes)
    inside = np.arange(int(sizes.sum())) - np.repeat(ends - sizes, sizes)
    return np.repeat(first, sizes) + inside // width


def _starts(sorted_: np.ndarray) -> np.ndarray:
    return np.flatnonzero(np.append(True, sorted_[1:] != sorted_[:-1]))


def _lengths(starts: np.ndarray, n: int) -> np.ndarray:
    return np.diff(np.append(starts, n))


def _row_sums(table: np.ndarray, own: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the table's rows ``own`` over the short runs that begin at ``starts``.

    Runs are taken longest first, so the k-th rows of all runs that have one add to a leading slice.
    """
    if not len(starts):
        return np.zeros((0, table.shape[1]), table.dtype)
    n = _lengths(starts, len(own))
    order = np.argsort(-n, kind="stable")
    first, left = starts[order], -n[order]
    out = table[own[first]]
    for k in range(1, -int(left[0])):
        some = int(np.searchsorted(left, -k))
        out[:some] += table[own[first[:some] + k]]
    back = np.empty_like(order)
    back[order] = np.arange(len(order))
    return out[back]


def term_counts(coded: DataFrame, terms: int) -> np.ndarray:
    """For each term the passages that hold it and the sum of its squared counts; last: all passages."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros((terms + 1, 2), np.int64)
        for batch in batches:
            for _, ids, sizes in _texts(batch):
                place = _places(sizes, 2 * HALF)
                total[terms, 0] += place[-1] + 1 if len(place) else 0
                known = ids >= 0
                pair, n = np.unique(place[known] * terms + ids[known], return_counts=True)
                total[:terms, 0] += np.bincount(pair % terms, minlength=terms)
                total[:terms, 1] += np.rint(np.bincount(pair % terms, n * n, terms)).astype(np.int64)
        yield sum_rows(total, 4096)

    return collect_sums(coded.select("ids").mapInArrow(run, SUMS), (terms + 1, 2), 4096)


def gram_product(coded: DataFrame, column: np.ndarray, scale: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A'A b for the table A of all passages, its columns scaled; ``column`` maps a term to its own."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(b.shape)
        scaled = (b * scale[:, None]).astype(np.float32)
        for batch in batches:
            for _, ids, sizes in _texts(batch):
                own = np.where(ids >= 0, column[ids], -1)
                some = np.flatnonzero(own >= 0)
                if not len(some):
                    continue
                own, place = own[some], _places(sizes, 2 * HALF)[some]
                starts = _starts(place)
                sums = _row_sums(scaled, own, starts)
                passage = np.repeat(np.arange(len(starts)), _lengths(starts, len(own)))
                order = np.argsort(own, kind="stable")
                firsts = _starts(own[order])
                for i, at in zip(firsts, np.split(order, firsts[1:])):  # one round for each term
                    total[own[order[i]]] += sums[passage[at]].sum(0)
        yield sum_rows(np.rint(total * scale[:, None] * _FIX).astype(np.int64), _ROWS)

    return collect_sums(coded.select("ids").mapInArrow(run, SUMS), b.shape, _ROWS) / _FIX


def latent_basis(coded: DataFrame, items: list[Item], terms: int):
    """Columns of the kept terms (-1: left out), their weights, and the directions."""
    counts = term_counts(coded, terms)
    df, passages = counts[:terms, 0], max(1, int(counts[terms, 0]))
    keep = df <= COMMON * passages
    for item in items:
        for _, passage in _split(item.ids):
            own = np.unique(passage)
            keep[own[np.argsort(df[own], kind="stable")[:RARE]]] = True
    column = np.where(keep, np.cumsum(keep) - 1, -1)
    kept = np.flatnonzero(keep)
    idf = np.log((passages + 1) / (df[kept] + 1)) + 1
    scale = idf / np.sqrt(np.maximum(counts[kept, 1], 1))
    rows = [column[p][column[p] >= 0] for item in items for _, p in _split(item.ids)]

    def times(b: np.ndarray) -> np.ndarray:
        out = gram_product(coded, column, scale, b)
        for own in rows:  # the items' passages, rows of the same columns
            weight = idf[own, None]
            np.add.at(out, own, ITEM_WEIGHT**2 * weight * (weight * b[own]).sum(0) / max(1, len(own)))
        return out

    width = min(DIRECTIONS + MORE, len(kept))
    draw = np.random.Generator(np.random.PCG64(11))
    q = np.linalg.qr(times(draw.standard_normal((len(kept), width))))[0]
    small = q.T @ times(q)
    values, vectors = np.linalg.eigh((small + small.T) / 2)
    return column, idf, q @ vectors[:, np.argsort(-values)[: min(DIRECTIONS, width)]]


def common_length(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence; bits of one number stand for the places of a."""
    where: dict[int, int] = {}
    for i, x in enumerate(a.tolist()):
        where[x] = where.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    row = full
    for x in b.tolist():
        if hit := row & where.get(x, 0):
            row = ((row + hit) | (row - hit)) & full
    return len(a) - row.bit_count()


def may_hold(ids: np.ndarray, begin: np.ndarray, end: np.ndarray, which: np.ndarray, items: list[Item], terms: int) -> np.ndarray:
    """Whether the words of ``ids`` from ``begin`` to ``end`` share enough with item ``which``, order aside.

    No common subsequence is longer than the words that two texts share, counted as often as both have them,
    so a window refused here cannot hold its item.
    """
    may = np.zeros(len(which), bool)
    local = np.full(terms + 1, -1)  # the last for words that no item has
    order = np.argsort(which, kind="stable")
    firsts = _starts(which[order]) if len(which) else []
    for first, own in zip(firsts, np.split(order, firsts[1:]) if len(which) else []):
        item = items[which[order[first]]]
        words, times = np.unique(item.ids, return_counts=True)
        local[words] = np.arange(len(words))
        n = end[own] - begin[own]
        at = np.arange(int(n.sum())) + np.repeat(begin[own] - (np.cumsum(n) - n), n)
        word = local[ids[at]]
        cell = np.repeat(np.arange(len(own)), n) * len(words) + word
        held = np.bincount(cell[word >= 0], minlength=len(own) * len(words)).reshape(len(own), -1)
        may[own] = np.minimum(held, times).sum(1) / len(item.ids) >= OVERLAP
        local[words] = -1
    return may


def _search(coded: DataFrame, items: list[Item], column, idf, basis) -> DataFrame:
    passages = [(n, at, p) for n, item in enumerate(items) for at, p in _split(item.ids)]
    latent = (basis * idf[:, None]).astype(np.float32)

    def fold(ids: np.ndarray) -> np.ndarray:
        own = column[ids]
        return latent[own[own >= 0]].sum(0)

    known = np.array([fold(p) for _, _, p in passages], np.float32).reshape(len(passages), latent.shape[1])
    known /= np.maximum(np.linalg.norm(known, axis=1, keepdims=True), 1e-9)
    least = min(LEAST_WORDS, *(int((column[np.unique(p)] >= 0).sum()) for _, _, p in passages)) if passages else 1

    def near(ids: np.ndarray, sizes: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
        """Candidates, some at a time: texts, first words of their passages, items' passages, cosines."""
        own = np.where(ids >= 0, column[ids], -1)
        place = _places(sizes, HALF)
        halves = -(-sizes // HALF)
        total = int(halves.sum())
        text = np.repeat(np.arange(len(sizes)), halves)
        first = np.cumsum(halves) - halves
        count = np.bincount(place[own >= 0], minlength=total)
        double = np.append(text[1:] == text[:-1], False) if total else np.zeros(0, bool)
        both = count + np.where(double, np.append(count[1:], 0), 0)
        # A last half is a passage of its own only where a text has no other.
        alone = double | (np.arange(total) == first[text])
        windows = np.flatnonzero((both >= least) & alone)
        if not len(windows):
            return
        needed = np.zeros(total + 1, bool)
        needed[windows] = True
        needed[windows[double[windows]] + 1] = True
        some = np.flatnonzero((own >= 0) & needed[place])
        starts = _starts(place[some])
        half = np.full(total + 1, len(starts))
        half[place[some][starts]] = np.arange(len(starts))
        for at in range(0, len(windows), 4096):
            w = windows[at : at + 4096]
            use = np.unique(np.concatenate([half[w], half[np.where(double[w], w + 1, total)]]))
            use = use[use < len(starts)]
            lengths = _lengths(starts, len(some))[use]
            begin = np.cumsum(lengths) - lengths
            tokens = np.arange(int(lengths.sum())) + np.repeat(starts[use] - begin, lengths)
            sums = _row_sums(latent, own[some[tokens]], begin)
            back = np.full(len(starts) + 1, len(use))
            back[use] = np.arange(len(use))
            sums = np.vstack([sums, np.zeros((1, sums.shape[1]), np.float32)])
            z = sums[back[half[w]]] + sums[back[half[np.where(double[w], w + 1, total)]]]
            z /= np.maximum(np.linalg.norm(z, axis=1, keepdims=True), 1e-9)
            for low in range(0, len(known), BLOCK):
                cosine = z @ known[low : low + BLOCK].T
                rows, cols = np.nonzero(cosine >= COSINE)
                for low_row in range(0, len(rows), SLICE):
                    i, p = rows[low_row : low_row + SLICE], cols[low_row : low_row + SLICE]
                    own_text = text[w[i]]
                    yield own_text, (w[i] - first[own_text]) * HALF, low + p, cosine[i, p]

    item_of, offset_of = (np.array([p[i] for p in passages], np.int64) for i in (0, 1))
    sizes_of = np.array([len(item.ids) for item in items], np.int64)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[tuple] = []
            for start, ids, sizes in _texts(batch):
                ends = np.cumsum(sizes)
                found: dict[tuple[int, int], tuple[float, float]] = {}
                for text, at, p, cosine in near(ids, sizes):
                    which = item_of[p]
                    slack = HALF + sizes_of[which] // 4
                    begin = ends[text] - sizes[text] + np.maximum(0, at - offset_of[p] - slack)
                    end = np.minimum(ends[text], ends[text] - sizes[text] + at - offset_of[p] + sizes_of[which] + HALF + slack)
                    for i in np.flatnonzero(may_hold(ids, begin, end, which, items, len(column))):
                        pair = int(text[i]), int(which[i])
                        if pair in found:
                            continue
                        item, around = items[pair[1]], ids[begin[i] : end[i]]
                        share = common_length(item.ids, around) / len(item.ids)
                        if share >= OVERLAP and common_length(item.answer, around) >= ANSWER * len(item.answer):
                            found[pair] = (float(cosine[i]), share)
                out += [(start + t, items[n].item_id, *v) for (t, n), v in found.items()]
            rows = pa.array([r[0] for r in out], pa.int64())
            part = pa.RecordBatch.from_struct_array(
                pa.StructArray.from_arrays(batch.columns, names=batch.schema.names).take(rows)
            )
            yield replaced(part, ["item_id", "cosine", "overlap"], [
                pa.array([r[i] for r in out], t) for i, t in ((1, pa.int64()), (2, pa.float64()), (3, pa.float64()))
            ], "ids")

    new = "item_id long, cosine double, overlap double"
    return coded.mapInArrow(run, replaced_schema(coded.schema, new, "ids"))


def contaminated(docs: DataFrame, benchmark: DataFrame, carried: Sequence[str] = ()) -> DataFrame:
    """``(doc_id, carried, item_id, cosine, overlap)`` for every text of ``docs`` that holds an item.

    ``carried`` are columns that go along, such as one that tells rows of equal or null doc_id apart.

    ``benchmark`` has ``item_id``, ``text`` and, if known, ``answer``; else the answer is the last quarter
    of the item's words.  Words are cut at white space and lowered.  A null or empty text or item
    matches nothing, a null item_id is not searched for; of repeated items each id is told, repeated
    documents are told each.  No items, no rows.
    """
    spark = docs.sparkSession
    columns = ["item_id", "text"] + (["answer"] if "answer" in benchmark.columns else [])
    given = benchmark.select(*columns).where("item_id IS NOT NULL").distinct().orderBy("item_id", "text")
    vocabulary: dict[str, int] = {}

    def ids(words: list[str]) -> np.ndarray:
        return np.array([vocabulary.setdefault(w, len(vocabulary)) for w in words], np.int32)

    items = []
    for r in given.toLocalIterator():
        words = words_of(r.text)
        if words:
            answer = words_of(r.answer) if "answer" in columns else []
            items.append(Item(r.item_id, ids(words), ids(answer or words[-(-3 * len(words) // 4) :] or words)))
    if not items:
        types = "item_id long, cosine double, overlap double"
        return spark.createDataFrame([], replaced_schema(docs.select("doc_id", *carried).schema, types, ""))
    coded = materialize(encode(docs.select("doc_id", *carried, "text"), vocabulary), "words")
    return _search(coded, items, *latent_basis(coded, items, len(vocabulary)))
