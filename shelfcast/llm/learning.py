"""Labelled samples, and a small logistic regression fitted on the driver from bounded samples."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfcast.llm.common import fold_of, id_and_text


def labelled_sample(docs: DataFrame, labels: DataFrame, label: str, folds: int, held: int, rows: int) -> DataFrame:
    """``doc_id, text, label, half`` of at most ``rows`` labelled documents outside the held-out fold.

    The sample is the rows with the smallest hash of their id, so it is the same in every run. Labels other than
    0 and 1, labels without an id and ids with both labels are left out. The sampled ids are a table of proven
    size and are broadcast. ``half`` (0 or 1) splits the sample in two.
    """
    doc_id = F.col("doc_id").cast("long")
    chosen = (
        labels.select(doc_id.alias("doc_id"), F.col(label).cast("int").alias("label"))
        .where("doc_id is not null and label in (0, 1)")
        .where(fold_of(F.col("doc_id"), folds) != held)
        .groupBy("doc_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(rows)
        .select("doc_id", "label", F.pmod(F.xxhash64("doc_id", F.lit(1)), F.lit(2)).cast("int").alias("half"))
    )
    return id_and_text(docs).join(F.broadcast(chosen), "doc_id")


def with_fold(scored: DataFrame, folds: int, held: int, threshold: float) -> DataFrame:
    """``doc_id, held_out, score, predicted``."""
    return scored.select(
        "doc_id",
        (fold_of(F.col("doc_id"), folds) == held).alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )


def fit_logistic(
    features: np.ndarray, labels: np.ndarray, ridge: float, weights: np.ndarray | None = None
) -> np.ndarray:
    """Coefficients, the intercept last, by Newton steps; for few dense features."""
    x = np.column_stack([features, np.ones(len(features))])
    w = np.ones(len(x)) if weights is None else weights
    beta = np.zeros(x.shape[1])
    penalty = np.full(x.shape[1], ridge)
    penalty[-1] = 1e-6
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        slope = x.T @ (w * (labels - p)) - penalty * beta
        curve = (x * (w * np.maximum(p * (1 - p), 1e-6))[:, None]).T @ x + np.diag(penalty)
        step = np.linalg.solve(curve, slope)
        beta += step
        if np.abs(step).max() < 1e-8:
            break
    return beta


