"""Model fitting as Spark jobs.

* Closed forms (I1, I2, I4) are single aggregates: ``regr_*`` or the
  covariance sums, solved inside the same one-row result.
* Gradient descent (I13-I15) runs one aggregate per step over the
  training rows: the driver receives only ``p + 1`` numbers per step and
  sends them back as literals. The input is checkpointed once into the
  cluster's shared checkpoint folder, so a lost executor re-reads it
  instead of replaying the join lineage.
* MLlib estimators (I2, I3, I5-I8, I10-I12) fit distributed
  (``treeAggregate``); their weights come back as a long table
  ``(layer, row, col, weight)`` (I17).
"""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.functions.columns import attach_row, sigmoid
from tabspark.session import ensure_checkpoint_dir

# Fixed value: gradient L2-norm clip used throughout the reference.
CLIP_NORM = 5.0


def linreg_1d(df: DataFrame, x: str, y: str) -> DataFrame:
    """Least squares ``y = slope * x + intercept`` in one aggregate."""
    return df.agg(F.regr_slope(y, x).alias("slope"), F.regr_intercept(y, x).alias("intercept"),
                  F.regr_r2(y, x).alias("r2"), F.regr_count(y, x).alias("n"))


def linreg_2d(df: DataFrame, x1: str, x2: str, y: str) -> DataFrame:
    """I2 (2 features): normal equations on sample covariances, Cramer's rule."""
    s = df.agg(F.var_samp(x1).alias("s11"), F.var_samp(x2).alias("s22"), F.covar_samp(x1, x2).alias("s12"),
               F.covar_samp(x1, y).alias("s1y"), F.covar_samp(x2, y).alias("s2y"),
               F.avg(x1).alias("m1"), F.avg(x2).alias("m2"), F.avg(y).alias("my"), F.count(F.lit(1)).alias("n"))
    det = F.col("s11") * F.col("s22") - F.col("s12") * F.col("s12")
    b1 = F.try_divide(F.col("s22") * F.col("s1y") - F.col("s12") * F.col("s2y"), det)
    b2 = F.try_divide(F.col("s11") * F.col("s2y") - F.col("s12") * F.col("s1y"), det)
    return (s.select(b1.alias("b1"), b2.alias("b2"), "m1", "m2", "my", "n")
            .select("b1", "b2", (F.col("my") - F.col("b1") * F.col("m1") - F.col("b2") * F.col("m2")).alias("intercept"),
                    "n"))


def predict_line(fit: DataFrame, df: DataFrame, x: str, out: str = "prediction") -> DataFrame:
    """Score with a one-row 1-D fit (I16)."""
    j = attach_row(df, fit, ["slope", "intercept"])
    return j.withColumn(out, F.col("slope") * F.col(x) + F.col("intercept")).drop("slope", "intercept")


def linear_form(weights: Sequence[float], bias: float, features: Sequence[str]) -> Column:
    z = F.lit(float(bias))
    for w, c in zip(weights, features):
        z = z + F.lit(float(w)) * F.col(c)
    return z


@dataclass
class GDResult:
    weights: list[float]
    bias: float
    curve: DataFrame                      # (step, split, loss)
    history: list[tuple[list[float], float]] = field(default_factory=list)


def _checkpointed(df: DataFrame) -> DataFrame:
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def fit_input(df: DataFrame) -> DataFrame:
    """Prepare the input of an iterative fit: at least one partition per
    core of the cluster (a small table coalesced by AQE would otherwise run
    every iteration in one task; large inputs keep their partitioning),
    written to the shared checkpoint folder so every pass and every
    iteration reads it instead of replaying the upstream joins."""
    par = df.sparkSession.sparkContext.defaultParallelism
    # Written before it is asked for its partitions, which would run the upstream shuffles a second time.
    own = _checkpointed(df)
    return _checkpointed(own.repartition(par)) if own.rdd.getNumPartitions() < par else own


def gradient_descent(df: DataFrame, features: Sequence[str], label: str, lr: float, steps: int,
                     loss: str = "squared", clip_norm: float | None = CLIP_NORM,
                     split_col: str | None = "split", train_value: str = "train",
                     init: tuple[Sequence[float], float] | None = None,
                     checkpoint: bool = True) -> GDResult:
    """Full-batch gradient descent with gradient-norm clipping.

    ``loss='squared'``: gradient of ``avg((z - y)^2)``; curve metric RMSE.
    ``loss='logistic'``: gradient of the log loss of ``sigmoid(z)``;
    curve metric log loss. Each step is one aggregate of ``p + 1`` sums
    over the training rows; the curve has one row per (step, split),
    step 0 being the initial weights (warm start via ``init``).
    """
    p = len(features)
    data = df.select(*features, label, *( [split_col] if split_col else []))
    if checkpoint:
        data = _checkpointed(data)
    train = data.where(F.col(split_col) == train_value) if split_col else data
    w, b = (list(init[0]), float(init[1])) if init else ([0.0] * p, 0.0)
    history = [(list(w), b)]
    for _ in range(steps):
        z = linear_form(w, b, features)
        err = (F.lit(2.0) * (z - F.col(label))) if loss == "squared" else (sigmoid(z) - F.col(label))
        g = train.agg(*[F.avg(err * F.col(c)).alias(f"g{i}") for i, c in enumerate(features)],
                      F.avg(err).alias("gb")).first()
        grad = [float(g[f"g{i}"]) for i in range(p)] + [float(g["gb"])]
        scale = 1.0
        if clip_norm is not None:
            norm = math.sqrt(sum(v * v for v in grad))
            scale = min(1.0, clip_norm / norm) if norm > 0 else 1.0
        w = [wi - lr * gi * scale for wi, gi in zip(w, grad[:p])]
        b = b - lr * grad[p] * scale
        history.append((list(w), b))
    # Every step's loss in ONE grouped pass (a column per step), then long.
    metrics = []
    for step, (ws, bs) in enumerate(history):
        z = linear_form(ws, bs, features)
        if loss == "squared":
            metric = F.sqrt(F.avg(F.pow(z - F.col(label), 2)))
        else:
            pz = F.greatest(F.least(sigmoid(z), F.lit(1 - 1e-15)), F.lit(1e-15))
            metric = -F.avg(F.col(label) * F.ln(pz) + (F.lit(1.0) - F.col(label)) * F.ln(F.lit(1.0) - pz))
        metrics.append(metric.alias(f"_s{step}"))
    if split_col:
        wide = data.groupBy(split_col).agg(*metrics).withColumnRenamed(split_col, "split")
    else:
        wide = data.agg(*metrics).withColumn("split", F.lit("all"))
    steps_long = F.explode(F.array(*[F.struct(F.lit(k).cast("bigint").alias("step"), F.col(f"_s{k}").alias("loss"))
                                     for k in range(len(history))]))
    curve = wide.select("split", steps_long.alias("_c")).select("_c.step", "split", "_c.loss")
    return GDResult(w, b, curve, history)


# ------------------------------------------------------------------- MLlib

def linear_weights(spark, model, names: Sequence[str]) -> DataFrame:
    """``(layer, row, col, name, weight)`` from a linear model."""
    coef = model.coefficients.toArray().tolist()
    rows = [("weights", i, 0, n, float(v)) for i, (n, v) in enumerate(zip(names, coef))]
    rows.append(("bias", 0, 0, "bias", float(model.intercept)))
    return spark.createDataFrame(rows, "layer string, row long, col long, name string, weight double")


def mlp_weights(spark, model) -> DataFrame:
    """The flat MLP weight vector split into per-layer matrices.

    MLlib packs, per layer, a column-major ``out x in`` weight matrix
    (entry ``(o, i)`` at ``i * out + o``) followed by ``out`` biases.
    Exported as ``row = input unit, col = output unit``.
    """
    layers = list(model.getLayers())
    flat = model.weights.toArray()
    rows, off = [], 0
    for li in range(len(layers) - 1):
        n_in, n_out = layers[li], layers[li + 1]
        for c in range(n_out):
            for r in range(n_in):
                rows.append((f"hidden{li}" if li < len(layers) - 2 else "logits", r, c,
                             f"w{li}", float(flat[off + r * n_out + c])))
        off += n_in * n_out
        for c in range(n_out):
            rows.append((f"bias{li}", 0, c, f"b{li}", float(flat[off + c])))
        off += n_out
    return spark.createDataFrame(rows, "layer string, row long, col long, name string, weight double")
