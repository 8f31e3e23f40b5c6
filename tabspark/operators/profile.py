"""Column profiles.

Each profile is one ``agg`` over all requested columns (partial
aggregation per task, a one-row final), reshaped to a long table by a
``stack``-style explode. Quartiles are exact (``encode.quantiles``), not
``df.summary()``'s sketch.
"""

from __future__ import annotations

from collections.abc import Sequence
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tabspark.functions.columns import attach_row
from tabspark.operators.encode import quantiles
from tabspark.session import materialize


def _long(row: DataFrame, cols: Sequence[str], fields: Sequence[str]) -> DataFrame:
    """One-row wide stats ``<col>__<field>`` -> one row per column."""
    items = F.array(*[F.struct(F.lit(c).alias("feature"),
                               *[F.col(f"{c}__{f}").alias(f) for f in fields]) for c in cols])
    return row.select(F.explode(items).alias("_s")).select("_s.*")


def min_max_range(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """``(feature, min, max, range)``."""
    aggs = []
    for c in cols:
        aggs += [F.min(c).cast("double").alias(f"{c}__min"), F.max(c).cast("double").alias(f"{c}__max")]
    long = _long(df.agg(*aggs), cols, ["min", "max"])
    return long.withColumn("range", F.col("max") - F.col("min"))


def describe(df: DataFrame, cols: Sequence[str], approx: bool = False, stored: bool = False) -> DataFrame:
    """count, mean, std (sample), min, 25 %, 50 %, 75 %, max per column.

    Exact quartiles read the columns again; they are written once unless ``df`` is ``stored``.
    """
    if not approx and not stored:
        df = materialize(df.select(*cols))
    aggs = []
    for c in cols:
        x = F.col(c).cast("double")
        aggs += [F.count(x).alias(f"{c}__count"), F.avg(x).alias(f"{c}__mean"), F.stddev_samp(x).alias(f"{c}__std"),
                 F.min(x).alias(f"{c}__min"), F.max(x).alias(f"{c}__max")]
    base = _long(df.agg(*aggs), cols, ["count", "mean", "std", "min", "max"])
    q = quantiles(df, cols, [0.25, 0.5, 0.75], approx=approx, stored=True)
    qw = q.groupBy("feature").agg(
        *[F.max(F.when(F.col("idx") == i, F.col("value"))).alias(n)
          for i, n in enumerate(["p25", "p50", "p75"])])
    return base.join(qw, "feature", "left").select(
        "feature", "count", "mean", "std", "min", "p25", "p50", "p75", "max")


def corr_matrix(df: DataFrame, cols: Sequence[str]) -> DataFrame:
    """Pearson r of every column pair, long ``(col_a, col_b, r)``.

    One pass: each row gives a cell per pair, and co-moments of the cells
    where both values are present are summed before the shuffle of one row
    per pair and task. null where a column is constant there. The diagonal is
    1 and the lower triangle mirrors the upper, so only the upper is computed.
    """
    pairs = list(combinations(cols, 2))
    if not pairs:
        return df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, r double")
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(a).cast("double").alias("x"), F.col(b).cast("double").alias("y"))
                      for i, (a, b) in enumerate(pairs)])
    sums = df.select(F.explode(cells).alias("_c")).groupBy(F.col("_c.i").alias("i")).agg(
        F.regr_sxy("_c.y", "_c.x").alias("xy"), F.regr_sxx("_c.y", "_c.x").alias("xx"), F.regr_syy("_c.y", "_c.x").alias("yy"))
    names = F.array(*[F.array(F.lit(a), F.lit(b)) for a, b in pairs])
    half = sums.select(names[F.col("i")].alias("_n"), F.try_divide("xy", F.sqrt(F.col("xx") * F.col("yy"))).alias("r"))
    both = F.explode(F.array(F.struct(F.col("_n")[0].alias("col_a"), F.col("_n")[1].alias("col_b"), "r"),
                             F.struct(F.col("_n")[1].alias("col_a"), F.col("_n")[0].alias("col_b"), "r")))
    ones = df.sparkSession.createDataFrame([(c, c, 1.0) for c in cols], "col_a string, col_b string, r double")
    return half.select(both.alias("_s")).select("_s.*").unionByName(ones)


def histogram(df: DataFrame, col: str, bins: int = 10) -> DataFrame:
    """equal-width histogram ``(bin, lo, hi, n)`` over ``[min, max]``.

    Bin = ``least(floor((x - min) / w), bins - 1)``; the maximum falls in
    the last bin. Empty bins appear with ``n = 0`` (left join from the
    ``bins``-row grid, which is a parameter).
    """
    spark = df.sparkSession
    stats = df.agg(F.min(col).alias("_lo"), F.max(col).alias("_hi"))
    w = (F.col("_hi") - F.col("_lo")) / F.lit(float(bins))
    x = F.col(col)
    b = F.least(F.floor(F.try_divide(x - F.col("_lo"), w)), F.lit(bins - 1)).cast("bigint")
    counted = (attach_row(df.where(x.isNotNull()), stats)
               .select(F.coalesce(b, F.lit(0).cast("bigint")).alias("bin"))
               .groupBy("bin").agg(F.count(F.lit(1)).alias("n")))
    grid = attach_row(spark.range(bins).select(F.col("id").alias("bin")), stats)
    return (grid.join(counted, "bin", "left")
            .select("bin", (F.col("_lo") + F.col("bin") * w).alias("lo"),
                    (F.col("_lo") + (F.col("bin") + 1) * w).alias("hi"),
                    F.coalesce("n", F.lit(0).cast("bigint")).alias("n")))


def nonzero_by_position(df: DataFrame, vec: str) -> DataFrame:
    """per vector position, how many rows hold a non-zero value.

    ``posexplode`` -> ``groupBy(pos)``: partial counts per task, one row
    per position after the shuffle.
    """
    return (df.select(F.posexplode(vec).alias("pos", "x"))
            .groupBy(F.col("pos").cast("bigint").alias("pos"))
            .agg(F.sum(F.when(F.col("x") != 0, 1).otherwise(0)).cast("bigint").alias("nonzero"),
                 F.count(F.lit(1)).alias("n")))


def nonzero_count(coef: DataFrame, value: str = "weight") -> DataFrame:
    """F5 for a model: number of non-zero coefficients in a weight table."""
    return coef.agg(F.sum(F.when(F.col(value) != 0, 1).otherwise(0)).cast("bigint").alias("size"))
