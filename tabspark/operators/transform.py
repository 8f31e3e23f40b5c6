"""Projections and normalisers.

Stateful normalisers come as a pair: ``fit_*`` returns a one-row
statistics DataFrame (a single ``agg`` over all columns: one pass, partial
aggregation map-side), and ``apply_*`` reads that row's values as scalar
subqueries (``functions.attach_row``): computed once, shipped to every task
as constants; no join is planned and the big side is not shuffled.

Statistics are taken from whatever DataFrame is passed to ``fit_*``;
pass the training split to avoid leakage (the reference used all rows).
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.functions.columns import (
    attach_row, binary_threshold, clip, linear_scale_expr, log_normalize, z_score_expr,
)


def select_features(df: DataFrame, names: Sequence[str], key: str = "id") -> DataFrame:
    """Key + named columns (Catalyst prunes the scan to them)."""
    return df.select(key, *names)


def with_stats(df: DataFrame, stats: DataFrame) -> DataFrame:
    """Attach a one-row statistics table to every row (scalar subqueries)."""
    return attach_row(df, stats)


def fit_min_max(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """One pass: ``min`` and ``max`` of every column."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).alias(f"{c}__min"), F.max(c).alias(f"{c}__max")]
    return df.agg(*aggs)


def apply_linear_scale(df: DataFrame, stats: DataFrame, cols: Sequence[str],
                       keep: Sequence[str] = ("id",)) -> DataFrame:
    """``(x - min) / ((max - min) / 2) - 1`` per column."""
    j = with_stats(df, stats)
    return j.select(*keep, *[linear_scale_expr(c, f"{c}__min", f"{c}__max").alias(c) for c in cols])


def fit_rows(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | Column | None) -> DataFrame:
    """What statistics are taken of: another table, the rows of ``df`` that meet a condition, or all of ``df``.

    A condition nulls the other rows' values instead of filtering them, so
    the statistics read ``df`` just as the transformation does and Spark runs
    what lies below both once.
    """
    if fit_on is None:
        return df
    if isinstance(fit_on, Column):
        return df.select(*[F.when(fit_on, F.col(c)).alias(c) for c in cols])
    return fit_on


def linear_scale(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | Column | None = None,
                 keep: Sequence[str] = ("id",)) -> DataFrame:
    """Fit on ``fit_on`` (see ``fit_rows``) and scale ``df``."""
    return apply_linear_scale(df, fit_min_max(fit_rows(df, cols, fit_on), cols), cols, keep)


def fit_mean_std(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    aggs = []
    for c in cols:
        aggs += [F.avg(c).alias(f"{c}__mean"), F.stddev_samp(c).alias(f"{c}__std")]
    return df.agg(*aggs)


def z_score(df: DataFrame, cols: Sequence[str], fit_on: DataFrame | Column | None = None,
            keep: Sequence[str] = ("id",)) -> DataFrame:
    """``(x - mean) / stddev_samp``."""
    stats = fit_mean_std(fit_rows(df, cols, fit_on), cols)
    j = with_stats(df, stats)
    return j.select(*keep, *[z_score_expr(c, f"{c}__mean", f"{c}__std").alias(c) for c in cols])


def fit_max(df: DataFrame, col: str) -> DataFrame:
    return df.agg(F.max(col).alias(f"{col}__max"))


def max_ratio(df: DataFrame, col: str, keep: Sequence[str] = ("id",), out: str | None = None) -> DataFrame:
    """``x / max(x)`` (null when the max is 0)."""
    j = with_stats(df, fit_max(df, col))
    return j.select(*keep, F.try_divide(F.col(col), F.col(f"{col}__max")).alias(out or col))


@dataclass(frozen=True)
class Step:
    """One normalisation recipe entry for a column (C14).

    kind: ``linear`` | ``log`` | ``clip_linear`` | ``zscore`` | ``clip`` |
    ``binary`` | ``identity``; ``lo``/``hi`` for clips, ``t`` for binary.
    """

    kind: str
    lo: float | None = None
    hi: float | None = None
    t: float | None = None


def _pre(c: str, s: Step) -> Column:
    """The row-wise part applied before statistics are taken."""
    if s.kind in ("clip_linear", "clip"):
        return clip(c, s.lo, s.hi)
    return F.col(c)


def fit_recipe(df: DataFrame, recipe: Mapping[str, Step]) -> DataFrame:
    """All statistics any step needs, in one ``agg``."""
    aggs = []
    for c, s in recipe.items():
        x = _pre(c, s)
        if s.kind in ("linear", "clip_linear"):
            aggs += [F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
        elif s.kind == "zscore":
            aggs += [F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std")]
    if not aggs:
        return df.sparkSession.range(1).select(F.lit(1).alias("__none"))
    return df.agg(*aggs)


def apply_recipe(df: DataFrame, stats: DataFrame, recipe: Mapping[str, Step],
                 keep: Sequence[str] = ("id",)) -> DataFrame:
    """One ``select`` evaluating every step."""
    j = with_stats(df, stats)
    out = []
    for c, s in recipe.items():
        x = _pre(c, s)
        if s.kind in ("linear", "clip_linear"):
            e = linear_scale_expr(x, f"{c}__min", f"{c}__max")
        elif s.kind == "zscore":
            e = z_score_expr(x, f"{c}__mean", f"{c}__std")
        elif s.kind == "log":
            e = log_normalize(x)
        elif s.kind == "binary":
            e = binary_threshold(x, s.t)
        elif s.kind == "clip":
            e = x
        elif s.kind == "identity":
            e = F.col(c)
        else:
            raise ValueError(f"unknown step {s.kind!r} for {c}")
        out.append(e.alias(c))
    return j.select(*keep, *out)


def normalize(df: DataFrame, recipe: Mapping[str, Step], fit_on: DataFrame | Column | None = None,
              keep: Sequence[str] = ("id",)) -> DataFrame:
    """C14: fit a per-column recipe and apply it: two stages, one pass each."""
    stats = fit_recipe(fit_rows(df, list(recipe), fit_on), recipe)
    return apply_recipe(df, stats, recipe, keep)


def vector_long(df: DataFrame, vec: str, keep: Sequence[str] = ("id",), pos: str = "pos",
                value: str = "x") -> DataFrame:
    """Array column -> one row per entry ``(keep..., pos, value)``, 0-based."""
    return df.select(*keep, F.posexplode(vec).alias(pos, value)).withColumn(pos, F.col(pos).cast("bigint"))


def vector_grid(df: DataFrame, vec: str, width: int, keep: Sequence[str] = ("id",)) -> DataFrame:
    """Reshape a flat vector to ``(row, col, value)`` cells of a grid."""
    long = df.select(*keep, F.posexplode(vec).alias("_p", "value"))
    return long.select(*keep, (F.col("_p") / width).cast("bigint").alias("row"),
                       (F.col("_p") % width).cast("bigint").alias("col"),
                       F.col("value").cast("double").alias("value"))
