"""L1 logistic fits on one-hot codes, several at once from the same scans.

The steps are those of Spark ML's fit: mean log loss over standardised columns
with an L1 penalty and a free intercept, by orthant-wise quasi-Newton steps
(OWL-QN of Breeze, its line search and its tests of convergence), so sizes and
losses are the same. What differs is where the rows are. Spark ML keeps every
fit's own copy of them in memory as sparse matrices; here a row is its codes,
two bytes each, written once in blocks. The optimisers run on the driver, with
``m`` pairs of vectors of the number of categories, and each says at which
coefficients it wants the loss next; one scan answers all of them.
"""

from __future__ import annotations

from collections.abc import Generator, Iterable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.ml.common import _py2java
from pyspark.ml.linalg import DenseVector
from pyspark.sql import DataFrame, SparkSession

from tabspark.session import materialize

#: Rows of a block; a scan looks at a block at a time.
BLOCK_ROWS = 1 << 16
#: Tasks whose sums (of some thousand numbers) the driver adds itself; those of more tasks are added in tasks first.
DRIVER_PARTS = 64


class StepFailed(Exception):
    """A line search found no step, or the history is unusable."""


def two_loop(history: list[tuple[np.ndarray, np.ndarray]], grad: np.ndarray) -> np.ndarray:
    """The direction of descent from the last steps and differences of gradients, newest first."""
    if not history:
        return -grad
    step, delta = history[0]
    sy, yy = step @ delta, delta @ delta
    if not sy >= 0:
        raise StepFailed
    out, kept = grad.copy(), []
    for s, y in history:
        rho = s @ y
        a = (s @ out) / rho
        if np.isnan(a):
            raise StepFailed
        kept.append((rho, a))
        out -= a * y
    out *= sy / yy
    for (s, y), (rho, a) in zip(history[::-1], kept[::-1]):
        out += (a - (y @ out) / rho) * s
    return -out


def owlqn(x: np.ndarray, l1: np.ndarray, max_iter: int, tol: float, memory: int = 10) -> Generator:
    """Yields points and is sent ``(value, gradient)`` of the smooth part there; returns the minimiser."""

    def adjusted(x, value, grad):
        shrunk = np.where(grad - l1 > 0, grad - l1, np.where(grad + l1 < 0, grad + l1, 0.0))
        return value + (l1 * np.abs(x)).sum(), np.where(l1 == 0, grad, np.where(x == 0, shrunk, grad + np.sign(x) * l1))

    value, grad = yield x
    full, slope = adjusted(x, value, grad)
    first, history, seen, failed = full, [], [np.inf], False
    for it in range(max_iter):
        if len(seen) > 1 and abs(full - max(seen)) <= tol * first or np.linalg.norm(slope) <= max(tol * full, 1e-8):
            break
        try:
            d = two_loop(history, slope)
            d = np.where(d * slope < 0, d, 0.0)
            orthant = np.where(x != 0, np.sign(x), np.sign(-slope))

            def at(alpha):
                to = x + d * alpha
                to = to * (np.sign(to) == orthant)
                v, g = yield to
                total, s = adjusted(to, v, g)
                return to, v, g, total, s

            alpha, shrink, df0 = (0.5 / np.linalg.norm(grad), 0.1, slope @ d) if it < 1 else (1.0, 0.5, slope @ d)
            point = yield from at(alpha)
            reached = value  # as in Breeze, the first trial is judged by the value before the step
            for trial in range(1, 21):
                deriv = point[4] @ d
                by = shrink if reached > full + alpha * df0 * 1e-4 else 2.1 if deriv < 0.9 * df0 else shrink if deriv > -0.9 * df0 else 1.0
                if by == 1.0 or trial == 20:
                    break
                alpha *= by
                if not 1e-10 <= alpha <= 1e10:
                    raise StepFailed
                point = yield from at(alpha)
                reached = point[3]
        except StepFailed:
            if failed:
                break
            failed, history = True, []
            continue
        history = [(point[0] - x, point[2] - grad), *history][:memory]
        x, value, grad, full, slope = point
        seen, failed = [*seen, full][-20:], False
    return x


@dataclass
class L1Fit:
    """A fit that is asked for; ``solve`` gives its ``coefficients`` and ``intercept``."""

    rows: DataFrame
    strength: float
    coefficients: np.ndarray | None = None
    intercept: float = 0.0

    def model(self, spark: SparkSession) -> LogisticRegressionModel:
        """Spark ML's model of these coefficients."""
        own = spark._jvm.org.apache.spark.ml.classification.LogisticRegressionModel(
            "l1_codes", _py2java(spark.sparkContext, DenseVector(self.coefficients)), float(self.intercept))
        return LogisticRegressionModel(own)


def _packed(firsts: np.ndarray, sizes: np.ndarray):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            if any(c.null_count for c in batch.columns):
                raise ValueError("a code or a label is null")
            codes = np.stack([c.to_numpy(zero_copy_only=False) for c in batch.columns[:-1]]).astype(np.int64)
            # A code beyond the known ones is the category that stands for all of these.
            columns = np.where((codes < 0) | (codes > sizes[:, None]), sizes[:, None], codes) + firsts[:, None]
            held.append(np.concatenate([columns, batch.columns[-1].to_numpy(zero_copy_only=False).astype(np.int64)[None]]).astype(np.uint16))
            n += batch.num_rows
            if n >= BLOCK_ROWS:
                yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held, 1).tobytes()])], ["block"])
                held, n = [], 0
        if n:
            yield pa.RecordBatch.from_arrays([pa.array([np.concatenate(held, 1).tobytes()])], ["block"])

    return run


def _counted(width: int, k: int):
    def run(rows: Iterator) -> Iterator[np.ndarray]:
        out = np.zeros(width + 2)
        for (block,) in rows:
            own = np.frombuffer(block, np.uint16).reshape(k + 1, -1)
            out[:width] += np.bincount(own[:-1].ravel(), minlength=width)
            out[width:] += own.shape[1], own[-1].sum()
        yield out

    return run


def _losses(points: np.ndarray, width: int, k: int):
    """Of every point (a row of weights per column, and the intercept last): the sums of residuals by column, of all, and of losses."""
    weights, intercepts = np.ascontiguousarray(points[:, :-1].T), points[:, -1]

    def run(rows: Iterator) -> Iterator[np.ndarray]:
        out = np.zeros((len(intercepts), width + 2))
        for (block,) in rows:
            own = np.frombuffer(block, np.uint16).reshape(k + 1, -1)
            z = np.tile(intercepts, (own.shape[1], 1))
            for c in own[:-1]:
                z += weights[c]
            y = own[-1].astype(np.float64)
            for i in range(len(intercepts)):
                margin = np.where(y > 0, z[:, i], -z[:, i])
                out[i, width + 1] += np.logaddexp(0, -margin).sum()
                r = np.where(y > 0, -1.0, 1.0) / (1 + np.exp(np.minimum(margin, 700)))
                out[i, width] += r.sum()
                for c in own[:-1]:
                    out[i, :width] += np.bincount(c, r, width)
        yield out

    return run


def _total(parts: RDD) -> np.ndarray:
    """The tasks' sums, added on the driver where they are few."""
    if parts.getNumPartitions() > DRIVER_PARTS:
        return parts.treeReduce(np.add)
    return np.sum(parts.collect() or [np.zeros(2)], axis=0)


def solve(fits: Sequence[L1Fit], sizes: dict[str, int], label: str, max_iter: int = 100, tol: float = 1e-6) -> Sequence[L1Fit]:
    """Runs all fits of the same rows to their ends. ``sizes``: the code columns and their numbers of codes, 0 and up; each
    has one more category for other codes. Rows with a null code are an error, as in Spark ML."""
    rows, k = fits[0].rows, len(sizes)
    if any(f.rows is not rows for f in fits):
        raise ValueError("fits that run together need the same rows")
    spread = np.array([n + 1 for n in sizes.values()])
    width, firsts = int(spread.sum()), np.cumsum(spread) - spread
    if width > np.iinfo(np.uint16).max:
        raise ValueError(f"{width} categories are too many for a block's numbers")
    blocks = materialize(rows.select(*sizes, label).mapInArrow(_packed(firsts, spread - 1), "block binary")).rdd
    few = blocks.coalesce(4 * rows.sparkSession.sparkContext.defaultParallelism)
    *counts, n, positive = _total(few.mapPartitions(_counted(width, k)))
    if not n:
        raise ValueError("no rows to fit on")
    mean = np.array(counts) / n
    std = np.sqrt(np.maximum(np.array(counts) - n * mean * mean, 0) / max(n - 1, 1))
    scale = np.divide(1.0, std, out=np.zeros(width), where=std > 0)
    shift = mean * scale
    if positive in (0, n):  # one class: no coefficient, and an intercept that is certain
        for f in fits:
            f.coefficients, f.intercept = np.zeros(width), np.inf if positive else -np.inf
        return fits
    start = np.append(np.zeros(width), np.log(positive / (n - positive)))
    runs = {i: owlqn(start, np.append(np.full(width, f.strength), 0.0), max_iter, tol) for i, f in enumerate(fits)}
    wanted = {i: next(run) for i, run in runs.items()}
    while wanted:
        points = np.array([np.append(x[:-1] * scale, x[-1] - x[:-1] @ shift) for x in wanted.values()])
        sums = _total(few.mapPartitions(_losses(points, width, k))) / n
        for i, s in zip(list(wanted), sums, strict=True):
            try:
                wanted[i] = runs[i].send((s[-1], np.append(s[:width] * scale - s[width] * shift, s[width])))
            except StopIteration as end:
                fits[i].coefficients = end.value[:-1] * scale
                fits[i].intercept = float(end.value[-1] - end.value[:-1] @ shift)
                del wanted[i]
    return fits
