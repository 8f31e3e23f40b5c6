"""Flagship: split -> train-only scaling -> closed-form fit -> RMSE per split."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tabspark.functions.columns import attach_row, round6
from tabspark.operators import split, transform
from tabspark.operators.evaluate import rmse
from tabspark.sources import views


def flagship(spark: SparkSession, sf_dir: str, feature: str = "gross") -> DataFrame:
    e = split.fraction_split(views.ex(spark, sf_dir).select("id", feature, "net_k"), split.TRAIN_VALID)
    train = e.where(F.col("split") == "train")
    stats = transform.fit_min_max(train, [feature])
    scaled = transform.apply_linear_scale(e, stats, [feature], keep=("id", "split", "net_k"))
    fit = scaled.where(F.col("split") == "train").agg(
        F.regr_slope("net_k", feature).alias("slope"), F.regr_intercept("net_k", feature).alias("intercept"))
    scored = attach_row(scaled, fit).withColumn(
        "prediction", F.col("slope") * F.col(feature) + F.col("intercept"))
    return (rmse(scored, "prediction", "net_k", groups=["split"])
            .select("split", round6("rmse").alias("rmse"), "n"))
