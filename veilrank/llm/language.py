"""Language identification as inference of a mixture of languages.

Character trigrams, hashed into a fixed number of cells, are counted for every language over all
training texts.  A text is cut into runs of a few trigrams; expectation-maximisation finds the
proportions of languages under which its runs are likeliest.  Sets of one, two and more languages, taken in
order of their proportions, are compared by likelihood less a penalty for each language, and the
largest proportion within the chosen set names the text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veilrank.llm.arrow import replaced, replaced_schema, text_chunks

UNKNOWN = "und"
CELLS = 1 << 15
RUN = 12  # trigrams in a run
ROUNDS = 12
SMOOTH = 0.5
LEAST = 0.02  # proportion from which a language may join a set
PENALTY = 2.0  # of a further language, in units of half the logarithm of the number of runs
MAX_LANGUAGES = 1000  # bounds the model; more is an error


def trigrams(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Cells of the trigrams of all texts, one after another, and how many each text has.

    Every text is lowered and stands between two spaces, so one with a letter has a trigram.
    """
    padded = [f" {t.lower()} " for t in texts]
    n = np.fromiter((len(t) for t in padded), np.int64, len(padded))
    codes = np.frombuffer("".join(padded).encode("utf-32-le", "surrogatepass"), np.uint32)
    h = codes[:-2] * np.uint32(0x9E3779B1) if len(codes) > 2 else np.zeros(0, np.uint32)
    if len(h):
        h = (h ^ (h >> np.uint32(15))) + codes[1:-1]
        h = h * np.uint32(0x85EBCA6B)
        h = (h ^ (h >> np.uint32(13))) + codes[2:]
        h = h * np.uint32(0xC2B2AE35)
        h ^= h >> np.uint32(16)
    inside = np.ones(len(codes), bool)  # a trigram starts here and stays in its text
    ends = np.cumsum(n)
    inside[ends - 1] = inside[ends - 2] = False
    return (h & np.uint32(CELLS - 1))[inside[:-2]].astype(np.int64), np.maximum(n - 2, 0)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def learn(docs: DataFrame) -> dict[str, np.ndarray]:
    """Trigram counts by language over all rows of ``docs(text, lang)`` with a text and a language."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[str, np.ndarray] = {}
        for batch in batches:
            for part, texts in text_chunks(batch):
                langs = part.column("lang").to_pylist()
                for lang in sorted(set(langs)):
                    own = [t for t, x in zip(texts, langs) if x == lang]
                    cells, _ = trigrams(own)
                    counts = held.setdefault(lang, np.zeros(CELLS, np.int64))
                    counts += np.bincount(cells, minlength=CELLS)
        for lang, counts in held.items():
            some = np.flatnonzero(counts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(some)), pa.array(some), pa.array(counts[some])],
                names=["lang", "cell", "n"],
            )

    taught = docs.where("text IS NOT NULL AND lang IS NOT NULL")
    if taught.select("lang").distinct().limit(MAX_LANGUAGES + 1).count() > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    cells = taught.select("lang", "text").mapInArrow(run, "lang string, cell long, n long")
    table = cells.groupBy("lang", "cell").agg(F.sum("n").alias("n")).toPandas()  # languages x cells
    model = {}
    for lang, own in table.groupby("lang"):
        model[lang] = np.zeros(CELLS, np.int64)
        model[lang][own["cell"].to_numpy()] = own["n"].to_numpy()
    return dict(sorted(model.items()))


def log_likelihoods(model: dict[str, np.ndarray]) -> np.ndarray:
    """Smoothed log probabilities, one row for each language in order of its name."""
    counts = np.array(list(model.values()), np.float64).reshape(len(model), CELLS)
    return np.log((counts + SMOOTH) / (counts.sum(1, keepdims=True) + SMOOTH * CELLS)).astype(np.float32)


def _mixture(p: np.ndarray, text: np.ndarray, starts: np.ndarray, allowed: np.ndarray) -> np.ndarray:
    """Proportions by text after some rounds; ``p`` has the runs' likelihoods up to a factor each."""
    n = np.diff(np.append(starts, len(text)))[:, None]
    share = allowed / allowed.sum(1, keepdims=True)
    for _ in range(ROUNDS):
        r = p * share[text]
        r /= np.maximum(r.sum(1, keepdims=True), 1e-300)
        share = np.add.reduceat(r, starts, axis=0) / n
    return share


def infer(texts: list[str], table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of each text's language and a score; the texts have letters."""
    cells, n = trigrams(texts)
    runs = -(-n // RUN)
    text = np.repeat(np.arange(len(texts)), runs)
    starts = np.cumsum(runs) - runs
    first = np.cumsum(n) - n
    run_starts = first[text] + RUN * (np.arange(len(text)) - starts[text])
    logs = np.stack([np.add.reduceat(row[cells], run_starts, dtype=np.float64) for row in table], 1)
    top = logs.max(1, keepdims=True)
    p = np.exp(logs - top)
    base = np.add.reduceat(top[:, 0], starts)
    singles = np.add.reduceat(logs, starts, axis=0)
    posterior = np.exp(singles - singles.max(1, keepdims=True))
    posterior /= posterior.sum(1, keepdims=True)
    full = _mixture(p, text, starts, np.ones_like(singles))
    order = np.argsort(-full, axis=1, kind="stable")
    best = singles.max(1)
    choice = singles.argmax(1)
    score = posterior[np.arange(len(texts)), choice]
    for k in range(2, table.shape[0] + 1):
        some = np.flatnonzero(np.take_along_axis(full, order[:, k - 1 : k], 1)[:, 0] >= LEAST)
        if not len(some):
            break
        allowed = np.zeros((len(some), table.shape[0]))
        np.put_along_axis(allowed, order[some, :k], 1.0, 1)
        pick = np.isin(text, some)
        own_runs = runs[some]
        own_text = np.repeat(np.arange(len(some)), own_runs)
        own_starts = np.cumsum(own_runs) - own_runs
        share = _mixture(p[pick], own_text, own_starts, allowed)
        mixed = np.log(np.maximum((p[pick] * share[own_text]).sum(1), 1e-300))
        value = base[some] + np.add.reduceat(mixed, own_starts)
        value -= (k - 1) * PENALTY * 0.5 * np.log(np.maximum(own_runs, 2))
        better = value > best[some]
        best[some[better]] = value[better]
        choice[some[better]] = share[better].argmax(1)
        score[some[better]] = share[better].max(1)
    return choice, score


def identify(docs: DataFrame, model: dict[str, np.ndarray]) -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score`` instead of the text.

    A null text, one without a letter, and every text where no language was learned is ``und`` with
    score 0.  Of equal proportions the first language by name stays.  Columns of these names are
    replaced, other columns and repeated rows stay.  The score is the language's proportion in the
    chosen set; for a set of one it is its posterior among single languages.
    """
    docs = docs.drop("lang_pred", "score")
    names = list(model)
    sent = docs.sparkSession.sparkContext.broadcast(log_likelihoods(model))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = sent.value
        for batch in batches:
            for part, texts in text_chunks(batch):
                langs, scores = [UNKNOWN] * len(texts), np.zeros(len(texts))
                some = [i for i, t in enumerate(texts) if names and has_letter(t)]
                if some:
                    choice, score = infer([texts[i] for i in some], table)
                    for i, c in zip(some, choice.tolist()):
                        langs[i] = names[c]
                    scores[some] = np.clip(score, 0, 1)
                yield replaced(part, ["lang_pred", "score"], [pa.array(langs, pa.string()), pa.array(scores)])

    return docs.mapInArrow(run, replaced_schema(docs.schema, "lang_pred string, score double"))
