"""The whole matching job: clean, pair, split, fit, evaluate."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame

from veilrank.operators.content import derive_clean_columns
from veilrank.operators.matching import fit_match_model, score_pairs
from veilrank.operators.metrics import evaluate
from veilrank.operators.pairs import SEED, build_pairs, pair_keys, stratified_split
from veilrank.session import materialize


@dataclass(frozen=True)
class MatchingReport:
    model: PipelineModel
    pairs: DataFrame
    scored: DataFrame
    metrics: DataFrame


def split_pairs(
    resumes: DataFrame,
    key: str = "doc_id",
    category: str = "category",
    resume: str = "text",
    seed: int = SEED,
    avoid_self: bool = False,
) -> DataFrame:
    """Labelled, split pairs ``(pair_id, key, jd_clean, resume_clean, label, split)``."""
    clean = derive_clean_columns(resumes, category, resume).select(
        key, "jd_clean", "resume_clean"
    )
    pairs = build_pairs(clean, key, seed, avoid_self)
    return stratified_split(pairs, keys=pair_keys(resumes, key), seed=seed)


def run_matching(
    resumes: DataFrame,
    key: str = "doc_id",
    category: str = "category",
    resume: str = "text",
    seed: int = SEED,
    avoid_self: bool = False,
) -> MatchingReport:
    """Build the pairs once in the shared folder, fit on train, evaluate on val and test."""
    pairs = materialize(split_pairs(resumes, key, category, resume, seed, avoid_self), "pairs")
    model = fit_match_model(pairs.where("split = 'train'"))
    scored = score_pairs(model, pairs.where("split <> 'train'"))
    return MatchingReport(model, pairs, scored, evaluate(scored, "split"))
