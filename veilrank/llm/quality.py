"""Quality scores from random-indexing word vectors and a small calibrated network.

Every word falls into one of a fixed number of cells, and every cell has a sparse random index vector.
A cell's context vector is the sum of the index vectors of its neighbours over all texts of the
corpus, counted in whole numbers and so the same in any order of tasks.  The vector of a word is
its context's direction, less what all contexts share, plus its own index vector.  Means and
deviations of the word vectors of a text feed a network of two layers, trained with numpy on a bounded
number of labelled rows; a temperature fitted on rows left out of training calibrates its
probabilities.

Words in capitals, numbers, and a word that repeats the one before it are words of their own, as are
runs of marks and line ends.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilrank.llm.arrow import (
    SUMS, collect_sums, replaced, replaced_schema, sum_rows, text_chunks,
)

CELLS, WIDTH, ONES, WINDOW = 1 << 14, 64, 4, 2
TRAIN_ROWS = 20_000  # labelled rows that the network is fitted on, at most
_BLOCK = 64  # cells in a row of sums
_HELD = 300_000
_PIECE = 1 << 16  # words whose vectors are held at once
_TOKEN = re.compile(r"\w+|[^\w\s]+|\n")


def _cell(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "replace")) % CELLS


_UPPER, _NUMBER, _SAME = (_cell(f"\0{name}") for name in ("upper", "number", "same"))


class _Cells(dict):
    """Cells by word; forgets all once it holds too many."""

    def __missing__(self, word: str) -> int:
        if len(word) > 1 and word.isupper():
            cell = _UPPER
        elif word.isdigit():
            cell = _NUMBER
        else:
            cell = _cell(word.lower())
        if len(self) >= _HELD:
            self.clear()
        if len(word) <= 48:
            self[word] = cell
        return cell


def cells_of(text: str, memo: _Cells) -> np.ndarray:
    """The cells of a text's words in their order."""
    words = _TOKEN.findall(text)
    cells = np.fromiter(map(memo.__getitem__, words), np.int64, len(words))
    if len(cells) > 1:
        cells[1:][cells[1:] == cells[:-1]] = _SAME
    return cells


def index_vectors() -> tuple[np.ndarray, np.ndarray]:
    """Places and signs of the ones in each cell's index vector; the same on every machine."""
    draw = np.random.Generator(np.random.PCG64(42))
    places = np.argsort(draw.random((CELLS, WIDTH)), axis=1)[:, :ONES]
    return places.astype(np.int64), draw.integers(0, 2, (CELLS, ONES)) * 2 - 1


def context_sums(docs: DataFrame) -> np.ndarray:
    """Sums of the neighbours' index vectors for each cell, over all texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        places, signs = index_vectors()
        total = np.zeros(CELLS * WIDTH, np.int64)
        memo = _Cells()
        for batch in batches:
            for _, texts in text_chunks(batch):
                parts = [cells_of(t, memo) for t in texts]
                cells = np.concatenate(parts) if parts else np.zeros(0, np.int64)
                text = np.repeat(np.arange(len(parts)), [len(p) for p in parts])
                for step in range(1, WINDOW + 1):
                    same = text[step:] == text[:-step]
                    left, right = cells[:-step][same], cells[step:][same]
                    for word, near in ((left, right), (right, left)):
                        for j in range(ONES):
                            at = word * WIDTH + places[near, j]
                            total += np.rint(np.bincount(at, signs[near, j], len(total))).astype(np.int64)
        yield sum_rows(total.reshape(CELLS, WIDTH), _BLOCK)

    # 8 MB of sums in all, whatever the size of the corpus
    return collect_sums(docs.select("text").mapInArrow(run, SUMS), (CELLS, WIDTH), _BLOCK)


def word_vectors(docs: DataFrame) -> np.ndarray:
    """A vector for each cell of words."""
    sums = context_sums(docs).astype(np.float64)
    common = sums.sum(0)
    size = np.linalg.norm(sums, axis=1, keepdims=True)
    context = sums / np.maximum(size, 1) - common / max(1.0, np.linalg.norm(common))
    context[size[:, 0] == 0] = 0
    context /= np.maximum(np.linalg.norm(context, axis=1, keepdims=True), 1e-9)
    places, signs = index_vectors()
    own = np.zeros((CELLS, WIDTH))
    np.put_along_axis(own, places, signs / np.sqrt(ONES), 1)
    return (context + own).astype(np.float32)


def pooled(texts: list[str], vectors: np.ndarray, memo: _Cells) -> np.ndarray:
    """Mean and deviation of each text's word vectors; zeros without words."""
    out = np.zeros((len(texts), 2 * WIDTH), np.float32)
    for i, text in enumerate(texts):
        cells = cells_of(text, memo)
        n = len(cells)
        if not n:
            continue
        mean, square = np.zeros(WIDTH), np.zeros(WIDTH)
        for at in range(0, n, _PIECE):
            own = vectors[cells[at : at + _PIECE]]
            mean += own.sum(0, dtype=np.float64)
            square += np.einsum("ij,ij->j", own, own, dtype=np.float64)
        mean /= n
        out[i, :WIDTH] = mean
        out[i, WIDTH:] = np.sqrt(np.maximum(square / n - mean * mean, 0))
    return out


@dataclass
class Network:
    """Standardisation, two layers and the temperature; without layers, a constant."""

    constant: float
    layers: tuple | None = None
    center: np.ndarray | None = None
    scale: np.ndarray | None = None
    temperature: float = 1.0

    def logits(self, x: np.ndarray) -> np.ndarray:
        w1, b1, w2, b2 = self.layers
        return np.tanh((x - self.center) / self.scale @ w1 + b1) @ w2 + b2

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        if self.layers is None:
            return np.full(len(x), self.constant)
        return 1 / (1 + np.exp(-np.clip(self.logits(x) / self.temperature, -30, 30)))


def train(x: np.ndarray, y: np.ndarray, hidden: int = 32, epochs: int = 60, decay: float = 1e-3) -> Network:
    """Fit on four fifths of the rows, stop at the best loss on the others, calibrate on them.

    Rows of one label only, or none, give a constant: the smoothed share of label 1.
    """
    constant = float((y.sum() + 1) / (len(y) + 2))
    if len(np.unique(y)) < 2 or len(y) < 10:
        return Network(constant)
    draw = np.random.Generator(np.random.PCG64(7))
    order = draw.permutation(len(y))
    held, rest = order[: len(y) // 5], order[len(y) // 5 :]
    center, scale = x[rest].mean(0), x[rest].std(0) + 1e-3
    width = x.shape[1]
    params = [draw.normal(0, width**-0.5, (width, hidden)), np.zeros(hidden),
              draw.normal(0, hidden**-0.5, hidden), np.array(np.log(constant / (1 - constant)))]
    first, second = [np.zeros_like(p) for p in params], [np.zeros_like(p) for p in params]
    z = ((x - center) / scale).astype(np.float64)
    best, step = (np.inf, None), 0

    def loss(logit: np.ndarray, target: np.ndarray) -> float:
        return float(np.mean(np.logaddexp(0, logit) - target * logit))

    for _ in range(epochs):
        for batch in np.array_split(draw.permutation(rest), max(1, len(rest) // 128)):
            w1, b1, w2, b2 = params
            a = np.tanh(z[batch] @ w1 + b1)
            error = (1 / (1 + np.exp(-np.clip(a @ w2 + b2, -30, 30))) - y[batch]) / len(batch)
            back = np.outer(error, w2) * (1 - a * a)
            grads = [z[batch].T @ back + decay * w1, back.sum(0), a.T @ error + decay * w2, error.sum()]
            step += 1
            for i, g in enumerate(grads):
                first[i] = 0.9 * first[i] + 0.1 * g
                second[i] = 0.999 * second[i] + 0.001 * g * g
                params[i] = params[i] - 0.003 * (first[i] / (1 - 0.9**step)) / (
                    np.sqrt(second[i] / (1 - 0.999**step)) + 1e-8
                )
        w1, b1, w2, b2 = params
        now = loss(np.tanh(z[held] @ w1 + b1) @ w2 + b2, y[held])
        if now < best[0]:
            best = (now, [p.copy() for p in params])
    network = Network(constant, tuple(best[1]), center, scale)
    logit = network.logits(x[held])
    choices = np.exp(np.linspace(np.log(0.25), np.log(4), 81))
    network.temperature = float(min(choices, key=lambda t: loss(logit / t, y[held])))
    return network


def labelled_sample(labels: DataFrame, rows: int = TRAIN_ROWS) -> DataFrame:
    """At most ``rows`` rows ``(doc_id, quality)`` with a label 0 or 1, in order of a hash of the key."""
    return (
        labels.where("quality IN (0, 1) AND doc_id IS NOT NULL").select("doc_id", "quality")
        .orderBy(F.xxhash64("doc_id"), "doc_id", "quality").limit(rows)
    )


def learn(docs: DataFrame, labels: DataFrame, rows: int = TRAIN_ROWS) -> tuple[np.ndarray, Network]:
    """Word vectors from all of ``docs(doc_id, text)``, a network from rows with ``labels``."""
    vectors = word_vectors(docs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Cells()
        for batch in batches:
            for part, texts in text_chunks(batch):
                x = pooled(texts, vectors, memo)
                yield replaced(part, ["x"], [pa.array([r.tobytes() for r in x], pa.binary())])

    sample = F.broadcast(labelled_sample(labels, rows))  # bounded by ``rows``
    own = docs.select("doc_id", "text").join(sample, "doc_id")
    # One row for each sampled key and label, however many rows of the table repeat the key.
    found = own.mapInArrow(run, replaced_schema(own.schema, "x binary"))
    taught = found.groupBy("doc_id", "quality").agg(F.min("x").alias("x")).collect()
    taught.sort(key=lambda r: (r.doc_id, r.quality, r.x))
    x = np.array([np.frombuffer(r.x, np.float32) for r in taught]).reshape(len(taught), 2 * WIDTH)
    return vectors, train(x, np.array([r.quality for r in taught], np.float64))


def score(docs: DataFrame, vectors: np.ndarray, network: Network, keep_text: bool = False) -> DataFrame:
    """``docs`` with ``score`` and ``predicted`` (1 from 0.5 on); the text goes unless it is kept.

    A null text is scored as an empty one, which has the vector zero.  Columns of these names are
    replaced, others and repeated rows kept.
    """
    docs = docs.drop("score", "predicted")
    drop = "" if keep_text else "text"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memo = _Cells()
        for batch in batches:
            for part, texts in text_chunks(batch):
                p = network.probabilities(pooled(texts, vectors, memo)).astype(np.float64)
                yield replaced(part, ["score", "predicted"],
                               [pa.array(p), pa.array((p >= 0.5).astype(np.int32))], drop)

    return docs.mapInArrow(run, replaced_schema(docs.schema, "score double, predicted int", drop))
