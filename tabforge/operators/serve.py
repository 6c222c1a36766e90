"""Scoring tables and streams with a stored model."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, functions as F

from tabforge.functions.scalar import risk_band, sigmoid
from tabforge.operators.experiments import with_score


def check_columns(df: DataFrame, required: Sequence[str]) -> None:
    """Refuse a table that lacks a trained column instead of guessing a default."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing for this model: {missing}")


def score_table(model: PipelineModel, df: DataFrame, required: Sequence[str], keep: Sequence[str]) -> DataFrame:
    """Prediction, risk in percent, confidence and band for every row.

    A model without probabilities is scored by the sigmoid of its margin. Works on a
    streaming table as well, because all stages are row by row.
    """
    check_columns(df, required)
    scored = with_score(model.transform(df))
    has_probability = "probability" in scored.columns
    p = F.col("score") if has_probability else sigmoid("score")
    out = scored.withColumn("_p", p)
    return out.select(
        *keep,
        "prediction",
        (F.col("_p") * 100.0).alias("risk"),
        F.greatest(F.col("_p"), 1.0 - F.col("_p")).alias("confidence"),
        risk_band(F.col("_p") * 100.0).alias("band"),
    )


def score_targets(model: PipelineModel, df: DataFrame, required: Sequence[str], outputs: dict[str, str], keep: Sequence[str]) -> DataFrame:
    """Several targets from one model; ``outputs`` maps a prediction column to its public name."""
    check_columns(df, required)
    return model.transform(df).select(*keep, *[F.col(c).alias(name) for c, name in outputs.items()])
