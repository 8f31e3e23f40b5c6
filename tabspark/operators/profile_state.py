"""Profiles that grow with the table.

A state row holds, for a pair of columns in a part of the table (a file, a
day), the count, means and co-moments of the rows that have both, and the
first column's range. States of parts add up: means are weighted, squared
deviations move by the square of what their mean moves. So a profile of the
whole table is the merged table of its parts' states, new files are read
once when they arrive, and old ones never again.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations_with_replacement

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_SUMS = ("n", "mean_a", "mean_b", "m2_a", "m2_b", "c_ab")


def states(df: DataFrame, cols: Sequence[str], part: str | Column) -> DataFrame:
    """``(part, col_a, col_b, n, mean_a, mean_b, m2_a, m2_b, c_ab, min_a, max_a)`` for each part and pair of columns, one pass.

    Each row gives a cell per pair; the sums are partly made before the shuffle of one row per part, pair and task.
    """
    pairs = list(combinations_with_replacement(cols, 2))
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
                      for i, (a, b) in enumerate(pairs)])
    own = df.select((F.col(part) if isinstance(part, str) else part).cast("string").alias("part"), F.explode(cells).alias("_c"))
    x, y = F.col("_c.x"), F.col("_c.y")
    values = (F.regr_count(y, x), F.regr_avgx(y, x), F.regr_avgy(y, x), F.regr_sxx(y, x), F.regr_syy(y, x), F.regr_sxy(y, x))
    sums = own.groupBy("part", F.col("_c.i").alias("i")).agg(*[v.alias(n) for n, v in zip(_SUMS, values, strict=True)],
                                                             F.min(x).alias("min_a"), F.max(x).alias("max_a"))
    names = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in pairs])
    return sums.select("part", names[F.col("i")][0].alias("col_a"), names[F.col("i")][1].alias("col_b"), *_SUMS, "min_a", "max_a")


def merge(parts: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """States of all parts together (of each value of ``by``): rows like those of ``states``, without ``part``."""
    key = [*by, "col_a", "col_b"]
    seen = parts.where("n > 0")
    n = F.sum("n")
    means = seen.groupBy(*key).agg((F.sum(F.col("n") * F.col("mean_a")) / n).alias("_a"),
                                   (F.sum(F.col("n") * F.col("mean_b")) / n).alias("_b"))
    da, db = F.col("mean_a") - F.col("_a"), F.col("mean_b") - F.col("_b")
    sums = seen.join(means, key).groupBy(*key).agg(
        F.first("_a").alias("mean_a"), F.first("_b").alias("mean_b"),
        F.sum(F.col("m2_a") + F.col("n") * da * da).alias("m2_a"), F.sum(F.col("m2_b") + F.col("n") * db * db).alias("m2_b"),
        F.sum(F.col("c_ab") + F.col("n") * da * db).alias("c_ab"))
    whole = parts.groupBy(*key).agg(F.sum("n").alias("n"), F.min("min_a").alias("min_a"), F.max("max_a").alias("max_a"))
    return whole.join(sums, key, "left").select(*key, *_SUMS, "min_a", "max_a")


def extend(spark: SparkSession, path: str, files: Sequence[str], cols: Sequence[str], read=None) -> list[str]:
    """Adds the states of those ``files`` that the state table at ``path`` hasn't got; returns them. Others aren't read.

    ``read`` makes a DataFrame of one file (Parquet by default).
    """
    known: set[str] = set()
    if _exists(spark, path):
        known = {r["part"] for r in spark.read.parquet(path).select("part").distinct().collect()}  # a row per file
    new = [f for f in dict.fromkeys(files) if f not in known]
    out = None
    for f in new:
        own = states((read or spark.read.parquet)(f), cols, F.lit(f))
        out = own if out is None else out.unionByName(own)
    if out is not None:
        out.write.mode("append").parquet(path)
    return new


def _exists(spark: SparkSession, path: str) -> bool:
    where = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(where)


def describe(merged: DataFrame) -> DataFrame:
    """``(feature, count, mean, std, min, max, range)``."""
    own = merged.where("col_a = col_b")
    return own.select(F.col("col_a").alias("feature"), F.col("n").alias("count"), F.col("mean_a").alias("mean"),
                      F.sqrt(F.try_divide("m2_a", F.col("n") - 1)).alias("std"), F.col("min_a").alias("min"),
                      F.col("max_a").alias("max"), (F.col("max_a") - F.col("min_a")).alias("range"))


def corr(merged: DataFrame) -> DataFrame:
    """``(col_a, col_b, r)`` of all ordered pairs; null where a column is constant."""
    r = F.try_divide("c_ab", F.sqrt(F.col("m2_a") * F.col("m2_b")))
    half = merged.select("col_a", "col_b", F.when(F.col("col_a") == F.col("col_b"), 1.0).otherwise(r).alias("r"))
    return half.unionByName(half.where("col_a <> col_b").select(
        F.col("col_b").alias("col_a"), F.col("col_a").alias("col_b"), "r"))


def least_squares(merged: DataFrame, features: Sequence[str], label: str) -> tuple[np.ndarray, float]:
    """(coefficients, intercept) from the co-moments; the columns are taken to have no nulls. The driver gets p**2 / 2 rows."""
    rows = {}
    for r in merged.where(F.col("col_a").isin([*features, label]) & F.col("col_b").isin([*features, label])).collect():
        rows[r["col_a"], r["col_b"]] = rows[r["col_b"], r["col_a"]] = r["c_ab"]
        rows[r["col_a"]] = r["mean_a"]
        rows[r["col_b"]] = r["mean_b"]
    w = np.linalg.lstsq(np.array([[rows[a, b] for b in features] for a in features]),
                        np.array([rows[a, label] for a in features]), rcond=None)[0]
    return w, float(rows[label] - w @ np.array([rows[a] for a in features]))
