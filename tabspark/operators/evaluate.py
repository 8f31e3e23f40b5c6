"""Evaluation metrics on scored tables.

Metrics are aggregates over a scored DataFrame (any size): one pass with
map-side partial aggregation, a one-row result. ROC and exact AUC group
by distinct score first (one shuffle), then take running counts with the
blocked prefix sum of ``ordering`` instead of a single-partition window,
so they stay exact at any number of distinct scores.

Rows with a null label or score are skipped by every metric.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tabspark.functions.columns import LOG_LOSS_EPS, argmax, attach_row, bucket_of
from tabspark.operators.ordering import running_sum_by_value
from tabspark.session import materialize


def _valid(df: DataFrame, *cols: str) -> DataFrame:
    cond = None
    for c in cols:
        cond = F.col(c).isNotNull() if cond is None else cond & F.col(c).isNotNull()
    return df.where(cond)


def mse_expr(pred: str, label: str) -> Column:
    return F.avg(F.pow(F.col(pred) - F.col(label), 2))


def rmse(df: DataFrame, pred: str = "prediction", label: str = "label",
         groups: Sequence[str] = ()) -> DataFrame:
    """``sqrt(avg((p - y)^2))`` (per group if given)."""
    d = _valid(df, pred, label)
    agg = [F.sqrt(mse_expr(pred, label)).alias("rmse"), F.count(F.lit(1)).alias("n")]
    return d.groupBy(*groups).agg(*agg) if groups else d.agg(*agg)


def rmse_vs_range(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """RMSE beside the label's min, max and range, plus rmse/range."""
    d = _valid(df, pred, label)
    row = d.agg(F.min(label).alias("min"), F.max(label).alias("max"),
                F.sqrt(mse_expr(pred, label)).alias("rmse"))
    rng = F.col("max") - F.col("min")
    return row.select("min", "max", rng.alias("range"), "rmse",
                      F.try_divide(F.col("rmse"), rng).alias("rmse_over_range"))


def clipped(p: str | Column, eps: float = LOG_LOSS_EPS) -> Column:
    p = F.col(p) if isinstance(p, str) else p
    return F.greatest(F.least(p, F.lit(1.0 - eps)), F.lit(eps))


def log_loss(df: DataFrame, prob: str = "probability", label: str = "label",
             eps: float = LOG_LOSS_EPS) -> DataFrame:
    """F8: binary log loss, probabilities clipped to ``[eps, 1 - eps]``."""
    d = _valid(df, prob, label)
    p = clipped(prob, eps)
    y = F.col(label)
    return d.agg((-F.avg(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))).alias("log_loss"),
                 F.count(F.lit(1)).alias("n"))


def log_loss_multi(df: DataFrame, probs: str, label: str = "label", mode: str = "soft",
                   eps: float = LOG_LOSS_EPS) -> DataFrame:
    """multi-class log loss ``-avg(ln(p[y]))``.

    ``mode='soft'`` uses the probability vector; ``mode='hard'`` uses a
    one-hot of its arg-max, as the reference did (each miss costs
    ``-ln(eps)``).
    """
    d = _valid(df, probs, label)
    y = F.col(label).cast("int")
    if mode == "hard":
        p_y = F.when(argmax(probs) == y, F.lit(1.0)).otherwise(F.lit(0.0))
    else:
        p_y = F.element_at(F.col(probs), y + 1).cast("double")
    return d.agg((-F.avg(F.ln(clipped(p_y, eps)))).alias("log_loss"), F.count(F.lit(1)).alias("n"))


def accuracy(df: DataFrame, pred: str = "prediction", label: str = "label") -> DataFrame:
    """share of rows whose predicted class equals the label."""
    d = _valid(df, pred, label)
    return d.agg(F.avg((F.col(pred) == F.col(label)).cast("double")).alias("accuracy"),
                 F.count(F.lit(1)).alias("n"))


def threshold(prob: str | Column, t: float = 0.5) -> Column:
    """Class id from a positive-class probability (F10 threshold)."""
    p = F.col(prob) if isinstance(prob, str) else prob
    return (p >= F.lit(t)).cast("double")


def score_counts(df: DataFrame, score: str, label: str, groups: Sequence[str] = ()) -> DataFrame:
    """Distinct scores with positive and negative counts (one shuffle,
    map-side combined), materialized: the ROC/AUC plans read it from
    several branches."""
    d = _valid(df, score, label)
    c = d.groupBy(*groups, F.col(score).cast("double").alias("score")).agg(
        F.sum(F.when(F.col(label) > 0, 1).otherwise(0)).cast("bigint").alias("pos"),
        F.sum(F.when(F.col(label) > 0, 0).otherwise(1)).cast("bigint").alias("neg"))
    return materialize(c)


def auc(df: DataFrame, score: str = "probability", label: str = "label",
        groups: Sequence[str] = (), groups_bounded: bool = False) -> DataFrame:
    """exact area under ROC with mid-ranks for tied scores.

    ``AUC = sum_s pos_s * (negatives below s + neg_s / 2) / (P * N)``, in
    doubles throughout: exact while the sums stay below 2^53, and without
    overflow beyond. With ``groups`` (e.g. the split) all AUCs come from one
    pass; ``groups_bounded`` says that their number is a parameter.
    """
    groups = list(groups)
    c = score_counts(df, score, label, groups)
    cum = running_sum_by_value(c, "score", ["neg"], groups=groups, groups_bounded=groups_bounded)
    return area(cum, groups)


def area(cum: DataFrame, groups: Sequence[str] = ()) -> DataFrame:
    """F11 from distinct scores with ``pos``, ``neg`` and the running ``cum_neg``."""
    aggs = [F.sum(F.col("pos").cast("double") * (F.col("cum_neg").cast("double") - F.col("neg") / 2.0)).alias("_u"),
            F.sum("pos").alias("_p"), F.sum("neg").alias("_n")]
    part = cum.groupBy(*groups).agg(*aggs) if groups else cum.agg(*aggs)
    return part.select(*groups, F.try_divide(F.col("_u"), F.col("_p").cast("double") * F.col("_n").cast("double")).alias("auc"),
                       F.col("_p").alias("positives"), F.col("_n").alias("negatives"))


def roc_curve(df: DataFrame, score: str = "probability", label: str = "label") -> DataFrame:
    """one ROC point per distinct score ``(threshold, fpr, tpr)``,
    plus the start point at threshold +inf (0, 0)."""
    c = score_counts(df, score, label)
    cum = running_sum_by_value(c, "score", ["pos", "neg"], descending=True)
    totals = c.agg(F.sum("pos").alias("_P"), F.sum("neg").alias("_N"))
    pts = attach_row(cum, totals).select(
        F.col("score").alias("threshold"),
        F.try_divide(F.col("cum_neg").cast("double"), F.col("_N")).alias("fpr"),
        F.try_divide(F.col("cum_pos").cast("double"), F.col("_P")).alias("tpr"))
    start = df.sparkSession.createDataFrame([(float("inf"), 0.0, 0.0)],
                                            "threshold double, fpr double, tpr double")
    return start.unionByName(pts)


def confusion_matrix(df: DataFrame, label: str, pred: str, k: int) -> DataFrame:
    """counts on the full ``k x k`` grid ``(label, predicted, n)``."""
    spark = df.sparkSession
    d = _valid(df, label, pred)
    counts = d.groupBy(F.col(label).cast("bigint").alias("label"),
                       F.col(pred).cast("bigint").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    grid = (spark.range(k).select(F.col("id").alias("label"))
            .select("label", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(k - 1).cast("bigint")))
                    .alias("predicted")))
    return (grid.join(counts, ["label", "predicted"], "left")
            .select("label", "predicted", F.coalesce("n", F.lit(0).cast("bigint")).alias("n")))


def confusion_normalised(cm: DataFrame) -> DataFrame:
    """each row divided by its class total; null for an empty class.

    The window runs over the ``k x k`` matrix, never over the scored rows.
    """
    w = Window.partitionBy("label")
    return cm.select("label", "predicted", "n",
                     F.try_divide(F.col("n").cast("double"), F.sum("n").over(w).cast("double")).alias("share"))


def confused_pairs(cm: DataFrame, top: int = 5) -> DataFrame:
    """the most frequent off-diagonal cells."""
    return (cm.where((F.col("label") != F.col("predicted")) & (F.col("n") > 0))
            .orderBy(F.col("n").desc(), "label", "predicted").limit(top))


def evaluate_binary(df: DataFrame, prob: str = "probability", label: str = "label",
                    t: float = 0.5, eps: float = LOG_LOSS_EPS, groups: Sequence[str] = ()) -> DataFrame:
    """F16: the full binary evaluation row in one pass (one row per group,
    e.g. per split, when ``groups`` is given)."""
    d = _valid(df, prob, label)
    y = F.col(label)
    yhat = threshold(prob, t)
    p = clipped(prob, eps)
    tp = F.sum(F.when((yhat == 1) & (y == 1), 1).otherwise(0))
    fp = F.sum(F.when((yhat == 1) & (y == 0), 1).otherwise(0))
    fn = F.sum(F.when((yhat == 0) & (y == 1), 1).otherwise(0))
    aggs = [
        F.count(F.lit(1)).alias("n"),
        F.avg((yhat == y).cast("double")).alias("accuracy"),
        F.avg(y).alias("label_mean"),
        F.avg(F.col(prob)).alias("prediction_mean"),
        tp.alias("_tp"), fp.alias("_fp"), fn.alias("_fn"),
        (-F.avg(y * F.ln(p) + (F.lit(1.0) - y) * F.ln(F.lit(1.0) - p))).alias("log_loss")]
    row = d.groupBy(*groups).agg(*aggs) if groups else d.agg(*aggs)
    return row.select(
        *groups, "n", "accuracy",
        F.greatest(F.col("label_mean"), F.lit(1.0) - F.col("label_mean")).alias("baseline_accuracy"),
        F.try_divide(F.col("_tp").cast("double"), (F.col("_tp") + F.col("_fp")).cast("double")).alias("precision"),
        F.try_divide(F.col("_tp").cast("double"), (F.col("_tp") + F.col("_fn")).cast("double")).alias("recall"),
        "label_mean", "prediction_mean", "log_loss")


def calibration_bins(df: DataFrame, prob: str, label: str, bounds: Sequence[float]) -> DataFrame:
    """bucket the score by ``bounds`` -> ``(bin, n, mean_score, mean_label)``."""
    d = _valid(df, prob, label)
    return (d.select(bucket_of(prob, list(bounds)).alias("bin"), F.col(prob).alias("_p"), F.col(label).alias("_y"))
            .groupBy("bin").agg(F.count(F.lit(1)).alias("n"), F.avg("_p").alias("mean_score"),
                                F.avg("_y").alias("mean_label")))


def generalisation_gap(metrics: DataFrame, metric: str = "rmse", split: str = "split",
                       train: str = "train", valid: str = "valid") -> DataFrame:
    """train vs validation value of a metric table and their gap."""
    m = metrics.groupBy().pivot(split, [train, valid]).agg(F.first(metric))
    return m.select(F.col(train).alias(f"{metric}_train"), F.col(valid).alias(f"{metric}_valid"),
                    (F.col(valid) - F.col(train)).alias("gap"))


def argmax_class(df: DataFrame, vec: str, out: str = "class_id", keep: Sequence[str] = ("id",)) -> DataFrame:
    """H3: arg-max position of a score vector (first wins on ties)."""
    return df.select(*keep, argmax(vec).alias(out))


def metrics_long(row: DataFrame, names: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """A wide metrics row -> ``(keep..., metric, value)`` long form."""
    items = F.array(*[F.struct(F.lit(n).alias("metric"), F.col(n).cast("double").alias("value"))
                      for n in names])
    return row.select(*keep, F.explode(items).alias("_m")).select(*keep, "_m.metric", "_m.value")
