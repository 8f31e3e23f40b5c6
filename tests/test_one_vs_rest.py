"""One-vs-rest fits against one binary MLlib fit per class."""

import numpy as np
import pytest

from tabspark.functions.columns import argmax
from tabspark.operators import one_vs_rest


def frame(spark, n=600, seed=1):
    rng = np.random.default_rng(seed)
    y = rng.integers(0, 3, n)
    x = rng.normal(size=(n, 4)) + np.eye(3, 4)[y] * 2
    return spark.createDataFrame([(i, [float(v) for v in a], int(c)) for i, (a, c) in enumerate(zip(x, y, strict=True))],
                                 "id long, v array<double>, y long").repartition(4), x, y


def test_equals_binary_fits(spark):
    from pyspark.ml.classification import LogisticRegression
    from pyspark.ml.functions import array_to_vector
    from pyspark.sql import functions as F

    df, _, _ = frame(spark)
    got = one_vs_rest.fit(df, "v", "y", 3, ridge=0.01)
    assert got.gradient <= 1e-9 and got.steps < 15
    for c in range(3):
        data = df.select(array_to_vector("v").alias("features"), (F.col("y") == c).cast("double").alias("label"))
        m = LogisticRegression(regParam=0.01, standardization=False, maxIter=200, tol=1e-12).fit(data)
        assert np.allclose(got.weights[c], [*m.coefficients.toArray(), m.intercept], atol=1e-4)


def test_scores_and_a_class_without_rows(spark):
    df, x, _ = frame(spark)
    got = one_vs_rest.fit(df, "v", "y", 4, ridge=0.01)
    z = np.c_[x, np.ones(len(x))] @ got.weights.T
    rows = df.select("id", got.scores("v").alias("s")).withColumn("k", argmax("s")).collect()
    for r in rows:
        assert r.s == pytest.approx(z[r.id].tolist(), rel=1e-9) and r.k == z[r.id].argmax()
    assert not any(r.k == 3 for r in rows)


def test_nulls_lengths_and_empty_tables(spark):
    df, _, _ = frame(spark, 60)
    more = df.unionByName(spark.createDataFrame([(100, None, 1), (101, [1.0, 2.0, 3.0, 4.0], None)], df.schema))
    assert np.allclose(one_vs_rest.fit(more, "v", "y", 3).weights, one_vs_rest.fit(df, "v", "y", 3).weights)
    with pytest.raises(ValueError, match="lengths"):
        one_vs_rest.fit(df.unionByName(spark.createDataFrame([(102, [1.0], 1)], df.schema)), "v", "y", 3)
    with pytest.raises(ValueError, match="fit the driver"):
        one_vs_rest.fit(df, "v", "y", 10_000_000)
    assert one_vs_rest.fit(df.limit(0), "v", "y", 3).steps == 0
