"""Evaluation metrics as aggregate columns over (label, prediction, probability)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

_CLIP = 1e-7


def _cells(label: Column, prediction: Column) -> dict[str, Column]:
    return {
        "tp": F.count_if((label == 1) & (prediction == 1)),
        "fp": F.count_if((label == 0) & (prediction == 1)),
        "fn": F.count_if((label == 1) & (prediction == 0)),
        "tn": F.count_if((label == 0) & (prediction == 0)),
    }


def accuracy(label: Column, prediction: Column) -> Column:
    return F.avg((label == prediction).cast("double"))


def f1(label: Column, prediction: Column) -> Column:
    """F1 of class 1; null if the class is neither present nor predicted."""
    c = _cells(label, prediction)
    twice = (2 * c["tp"]).cast("double")
    return F.try_divide(twice, 2 * c["tp"] + c["fp"] + c["fn"])


def log_loss(label: Column, p_match: Column) -> Column:
    p = F.when(label == 1, p_match).otherwise(1 - p_match)
    return F.avg(-F.ln(F.greatest(F.least(p, F.lit(1 - _CLIP)), F.lit(_CLIP))))


def confusion(df: DataFrame, label: str = "label", prediction: str = "prediction") -> DataFrame:
    cells = _cells(F.col(label), F.col(prediction))
    return df.agg(*[c.alias(name) for name, c in cells.items()])


def evaluate(
    df: DataFrame,
    *by: str,
    label: str = "label",
    prediction: str = "prediction",
    p_match: str = "p_match",
) -> DataFrame:
    """All metrics in one pass, optionally per group."""
    y, yhat = F.col(label), F.col(prediction)
    return df.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.round(accuracy(y, yhat), 6).alias("accuracy"),
        F.round(f1(y, yhat), 6).alias("f1"),
        F.round(log_loss(y, F.col(p_match)), 6).alias("log_loss"),
    )
