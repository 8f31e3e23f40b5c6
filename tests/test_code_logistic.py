"""L1 fits on codes against Spark ML's on the one-hot vectors of the same rows."""

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.linalg import Vectors

from tabspark.operators import code_logistic

SIZES = {"a": 3, "b": 4}


def frame(spark, n=400):
    rng = np.random.default_rng(5)
    a, b = rng.integers(0, 3, n), rng.integers(0, 4, n)
    y = (rng.random(n) < 1 / (1 + np.exp(2.0 - a - (b == 1) * 2.0))).astype(int)
    return spark.createDataFrame([(int(i), int(j), int(k)) for i, j, k in zip(a, b, y)], "a smallint, b smallint, y smallint").repartition(3)


def test_fits_that_share_scans_equal_spark_ml(spark, monkeypatch):
    """The same coefficients for every strength; no fit keeps its own copy of the rows in memory."""
    monkeypatch.setattr(code_logistic, "BLOCK_ROWS", 50)
    df = frame(spark)
    held = len(spark.sparkContext._jsc.getPersistentRDDs())
    strengths = [0.0005, 0.005, 0.05]
    got = code_logistic.solve([code_logistic.L1Fit(df, s) for s in strengths], SIZES, "y")
    assert len(spark.sparkContext._jsc.getPersistentRDDs()) == held
    vectors = spark.createDataFrame([(Vectors.sparse(9, {r.a: 1.0, 4 + r.b: 1.0}), float(r.y)) for r in df.collect()], ["features", "label"])
    for f, s in zip(got, strengths):
        want = LogisticRegression(elasticNetParam=1.0, regParam=s, maxIter=100).fit(vectors)
        assert np.allclose(f.coefficients, want.coefficients.toArray(), atol=1e-7) and f.intercept == pytest.approx(want.intercept, abs=1e-7)
        assert ((f.coefficients != 0) == (want.coefficients.toArray() != 0)).all()
    model = got[1].model(spark)
    assert model.transform(vectors).select("probability").count() == 400 and model.intercept == got[1].intercept


def test_nulls_one_class_and_empty_tables(spark):
    df = frame(spark, 40)
    one = code_logistic.solve([code_logistic.L1Fit(df.where("y = 1"), 0.01)], SIZES, "y")[0]
    assert not one.coefficients.any() and one.intercept == np.inf
    with pytest.raises(ValueError, match="no rows"):
        code_logistic.solve([code_logistic.L1Fit(df.limit(0), 0.01)], SIZES, "y")
    with pytest.raises(Exception, match="is null"):
        code_logistic.solve([code_logistic.L1Fit(df.selectExpr("if(a = 1, null, a) a", "b", "y"), 0.01)], SIZES, "y")
