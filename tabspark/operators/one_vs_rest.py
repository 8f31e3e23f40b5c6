"""One-vs-rest logistic regression with one scan per step for all classes.

Each class has a binary logistic fit with a ridge. A Newton step of all of
them needs the same rows: one scan sums, for every class, the gradient and
the curvature over a task's batches, Spark adds the tasks' sums, and the
driver solves one small system per class. The number of scans is that of
Newton steps (about eight), not classes times iterations. The driver holds
``classes * columns**2`` numbers.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.functions.columns import linear_scores

#: Numbers that the driver holds at most (classes * columns**2).
MAX_NUMBERS = 20_000_000


@dataclass
class OneVsRest:
    """``weights`` is (classes, features + 1), the bias last; ``steps`` the scans that were taken."""

    weights: np.ndarray
    steps: int
    gradient: float

    def scores(self, vector: str) -> Column:
        """Each class's logit, in generated code: one sum per class."""
        return linear_scores(vector, self.weights[:, :-1].tolist(), self.weights[:, -1].tolist())


def _sums(weights: np.ndarray):
    k, d = weights.shape
    schema = pa.schema([("cell", pa.int64()), ("s", pa.float64())])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        gradient, curve, n = np.zeros((k, d)), np.zeros((k, d, d)), 0
        for batch in batches:
            x = batch.column(0).flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(batch.num_rows, d - 1)
            x = np.concatenate([x, np.ones((len(x), 1))], axis=1)
            y = batch.column(1).to_numpy(zero_copy_only=False)
            p = 1 / (1 + np.exp(-np.clip(x @ weights.T, -500, 500)))
            n += len(x)
            for c in range(k):
                gradient[c] += x.T @ (p[:, c] - (y == c))
                curve[c] += (x * (p[:, c] * (1 - p[:, c]))[:, None]).T @ x
        if n:
            values = np.concatenate([[n], gradient.ravel(), curve.ravel()])
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(values))), pa.array(values)], schema=schema)

    return run


def fit(df: DataFrame, vector: str, label: str, classes: int, ridge: float = 1e-3, steps: int = 30,
        tol: float = 1e-9) -> OneVsRest:
    """Fits label == c against the rest for c = 0 .. classes - 1: mean log loss plus ``ridge / 2 * |w|**2``, the bias free.

    ``vector`` is an array column of one length; rows with a null vector or
    label are left out. The input is read once a step: give a stored table.
    """
    own = df.select(F.col(vector).cast("array<double>").alias("_v"), F.col(label).cast("long").alias("_y")).dropna()
    width = own.agg(F.max(F.size("_v")).alias("m"), F.min(F.size("_v")).alias("l")).first()
    if width["m"] is None:
        return OneVsRest(np.zeros((classes, 1)), 0, 0.0)
    if width["m"] != width["l"]:
        raise ValueError("vectors have different lengths")
    d = width["m"] + 1
    if classes * d * d > MAX_NUMBERS:
        raise ValueError(f"{classes} classes of {d} columns don't fit the driver; use a gradient method")
    w = np.zeros((classes, d))
    free = np.append(np.ones(d - 1), 0.0)
    size = np.inf
    for step in range(1, steps + 1):
        rows = own.mapInArrow(_sums(w), "cell long, s double").groupBy("cell").agg(F.sum("s").alias("s")).toArrow()
        sums = np.zeros(1 + classes * d + classes * d * d)
        sums[rows.column("cell").to_numpy()] = rows.column("s").to_numpy()
        n = sums[0]
        gradient = sums[1:1 + classes * d].reshape(classes, d) / n + ridge * free * w
        curve = sums[1 + classes * d:].reshape(classes, d, d) / n + np.diag(ridge * free + 1e-12)
        size = float(np.abs(gradient).max())
        if size <= tol:
            return OneVsRest(w, step, size)
        move = np.stack([np.linalg.solve(h, g) for h, g in zip(curve, gradient, strict=True)])
        # Newton steps of a logistic loss may overshoot far from the optimum: long ones are shortened.
        w = w - move / np.maximum(1.0, np.sqrt((move * move).sum(axis=1, keepdims=True)) / 10.0)
    return OneVsRest(w, steps, size)
