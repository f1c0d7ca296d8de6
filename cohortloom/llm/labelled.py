"""Bounded samples of labelled documents, and a one-dimensional logistic fit."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import col, remainder


def training_rows(
    docs: DataFrame, labels: DataFrame, label: str, divisor: int, held_out: int, max_rows: int, id_col: str, text_col: str
) -> DataFrame:
    """Rows ``label, text`` of labelled documents that may be learned from, of at most ``max_rows`` ids.

    Ids with ``crc32(id as text) % divisor == held_out`` are never taken. An id
    that has both labels, no label or is null is left out. If there are more ids
    than ``max_rows``, those with the least hashes are taken; so many ids are
    broadcast at most.
    """
    chosen = (
        labels.select(col(id_col).alias("l_id"), col(label).cast("int").alias("label"))
        .where(F.col("l_id").isNotNull() & F.col("label").isin(0, 1) & (remainder(F.col("l_id"), divisor) != held_out))
        .groupBy("l_id")
        .agg(F.min("label").alias("label"), F.max("label").alias("other"))
        .where("label = other")
        .orderBy(F.xxhash64("l_id"), "l_id")
        .limit(max_rows)
        .select("l_id", "label")
    )
    read = docs.select(col(id_col).alias("id"), col(text_col).alias("text"))
    return read.join(F.broadcast(chosen), F.col("id") == F.col("l_id")).select("label", "text")


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2, steps: int = 50) -> tuple[float, float]:
    """(offset, slope) of the logistic regression of 0/1 labels on one value, by Newton steps.

    Labels are drawn in from 0 and 1 by the class sizes, as Platt does, so that
    separated classes keep a finite slope. Without any row the result is (0, 0).
    """
    if not len(x):
        return 0.0, 0.0
    up, down = float(y.sum()), float(len(y) - y.sum())
    target = np.where(y > 0, (up + 1) / (up + 2), 1 / (down + 2))
    beta = np.zeros(2)
    design = np.stack([np.ones(len(x)), x], axis=1)
    for _ in range(steps):
        p = 1 / (1 + np.exp(-np.clip(design @ beta, -35, 35)))
        gradient = design.T @ (target - p) - ridge * beta
        hessian = (design * (p * (1 - p))[:, None]).T @ design + (ridge + 1e-9) * np.eye(2)
        step = np.linalg.solve(hessian, gradient)
        size = np.abs(step).max()
        beta += step * min(1.0, 5.0 / max(size, 1e-12))
        if size < 1e-9:
            break
    return float(beta[0]), float(beta[1])


def sigmoid(z: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(z, -35, 35)))
