"""Learned match probability for (job description, résumé) pairs, on Spark ML."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pandas as pd
from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import IDF, HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from veilrank.functions.text import argmax_label, distinct_words, scrub, words

HASH_SIZE = 1 << 16
MIN_FREQUENCY = 2
_STEPS = 10  # of the share, which is at most one


def with_terms(pairs: DataFrame) -> DataFrame:
    """Terms to learn from: words of either side and of both, and how far they overlap.

    The overlap goes in as a term per step, so that every feature has the same hashed form and
    no column of a fixed position is needed; the number of shared words in steps of its logarithm.
    """
    wanted, held = distinct_words(F.col("jd_clean")), words(F.col("resume_clean"))
    staged = pairs.withColumns({"_jd": wanted, "_resume": held})
    staged = staged.withColumn("_shared", F.array_intersect("_jd", "_resume"))
    share = F.coalesce(F.try_divide(F.size("_shared").cast("double"), F.size("_jd")), F.lit(0.0))
    steps = F.array(
        F.concat(F.lit("overlap "), F.floor(share * _STEPS).cast("string")),
        F.concat(F.lit("shared "), F.floor(F.log2(F.size("_shared") + 1) * 2).cast("string")),
    )

    def tagged(tag: str, column: str) -> Column:
        return F.transform(column, lambda w: F.concat(F.lit(tag), w))

    terms = F.concat(
        tagged("jd ", "_jd"), tagged("both ", "_shared"), F.col("_resume"), steps
    )
    return staged.withColumn("terms", terms).drop("_jd", "_resume", "_shared")


def fit_match_model(
    train: DataFrame,
    label: str = "label",
    max_iter: int = 30,
    reg: float = 0.01,
    features: int = HASH_SIZE,
    min_frequency: int = MIN_FREQUENCY,
) -> PipelineModel:
    """Fit P(match) on training pairs.  Runs at once.

    Terms are hashed into ``features`` places; those in fewer than ``min_frequency`` pairs have no
    weight.
    """
    stages = [
        HashingTF(inputCol="terms", outputCol="tf", numFeatures=features, binary=True),
        IDF(inputCol="tf", outputCol="features", minDocFreq=min_frequency),
        LogisticRegression(labelCol=label, maxIter=max_iter, regParam=reg),
    ]
    return Pipeline(stages=stages).fit(with_terms(train).select("terms", label))


def score_pairs(model: PipelineModel, pairs: DataFrame) -> DataFrame:
    """Add ``p_mismatch``, ``p_match`` and ``prediction`` to every pair."""
    scored = model.transform(with_terms(pairs))
    p = vector_to_array("probability")
    made = scored.withColumns(
        {
            "p_mismatch": F.get(p, 0),
            "p_match": F.get(p, 1),
            "prediction": argmax_label(p),
        }
    )
    return made.select(*pairs.columns, "p_mismatch", "p_match", "prediction")


def score_pairs_with(
    pairs: DataFrame, scorer: Callable[[pd.Series, pd.Series], np.ndarray]
) -> DataFrame:
    """Score with a caller's own batch function ``(jd, resume) -> P(match)``, such as a neural model."""
    schema = StructType(pairs.schema.fields + [StructField("p_match", DoubleType())])

    def run(batches):
        for batch in batches:
            p_match = scorer(batch["jd_clean"], batch["resume_clean"])
            yield batch.assign(p_match=np.asarray(p_match, dtype="float64"))

    return pairs.mapInPandas(run, schema)


def rank_by_model(
    model: PipelineModel,
    resumes: DataFrame,
    jd_text: str,
    k: int = 5,
    key: str = "doc_id",
    text: str = "text",
) -> DataFrame:
    """Top k résumés for one job description by P(match), not by the predicted class's score."""
    if k < 1:
        raise ValueError("k must be at least 1")
    pairs = resumes.select(
        key,
        F.col(text).alias("text"),
        scrub(F.lit(jd_text)).alias("jd_clean"),
        scrub(F.col(text)).alias("resume_clean"),
    )
    scored = score_pairs(model, pairs).select(key, F.col("p_match").alias("score"), "text")
    return scored.orderBy(F.desc("score"), F.desc("text"), key).limit(k)
