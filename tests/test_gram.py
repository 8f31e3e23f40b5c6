"""Fits from sums: against numpy and MLlib, folds as total minus fold, contingency against one-hot matrices."""

import numpy as np
import pytest

from tabspark.operators import gram


def table(spark, n=400, seed=0):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, 3))
    y = x @ [2.0, -1.0, 0.0] + 3 + rng.normal(scale=0.5, size=n)
    fold = rng.integers(0, 4, n)
    rows = [(*map(float, a), float(b), int(f)) for a, b, f in zip(x, y, fold, strict=True)]
    return spark.createDataFrame(rows, "a double, b double, c double, y double, fold int").repartition(3), x, y, fold


def solve(x, y, strength):
    design = np.c_[np.ones(len(x)), x]
    penalty = strength * len(x) * np.diag([0.0, 1, 1, 1])
    return np.linalg.solve(design.T @ design + penalty, design.T @ y), design


def test_folds_are_total_minus_fold(spark):
    df, x, y, fold = table(spark)
    parts = {f: m for (f,), m in gram.moments(df, ["a", "b", "c"], "y", ["fold"]).items()}
    assert sum(m.n for m in parts.values()) == 400
    for strength, got in gram.ridge_path(parts, [0.0, 0.1, 10.0]):
        error = 0.0
        for f in range(4):
            w, _ = solve(x[fold != f], y[fold != f], strength)
            error += ((y[fold == f] - np.c_[np.ones((fold == f).sum()), x[fold == f]] @ w) ** 2).sum()
        assert got == pytest.approx((error / 400) ** 0.5, rel=1e-9)


def test_error_of_other_rows_needs_their_sums_only(spark):
    df, x, y, fold = table(spark)
    parts = gram.moments(df, ["a", "b", "c"], "y", ["fold"])
    w = gram.ridge(gram.total([m for (f,), m in parts.items() if f]), 0.05)
    want, design = solve(x[fold > 0], y[fold > 0], 0.05)
    assert np.allclose(w, want)
    own = fold == 0
    assert parts[(0,)].rmse(w) == pytest.approx(np.sqrt(np.mean((y[own] - np.c_[np.ones(own.sum()), x[own]] @ w) ** 2)))
    assert gram.Moments.zero(3).rmse(w) is None


def test_elastic_net_equals_mllib(spark):
    from pyspark.ml.feature import VectorAssembler
    from pyspark.ml.regression import LinearRegression

    df, _, y, _ = table(spark)
    own = gram.moments(df, ["a", "b", "c"], "y")[()]
    data = VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df)
    std = np.std(y, ddof=1)
    for strength, share in ((0.05, 0.5), (0.3, 1.0), (0.2, 0.0)):
        # MLlib divides the quadratic part of the penalty by the label's deviation.
        l1, l2 = strength * share, strength * (1 - share) / std
        w = gram.elastic_net(own, l1 + l2, l1 / (l1 + l2))
        m = LinearRegression(labelCol="y", regParam=strength, elasticNetParam=share, standardization=False, maxIter=500, tol=1e-12).fit(data)
        assert np.allclose(w[1:], m.coefficients.toArray(), atol=5e-4) and w[0] == pytest.approx(m.intercept, abs=5e-4)
    assert (gram.elastic_net(own, 100.0, 1.0)[1:] == 0).all()


def test_nulls_and_empty_groups(spark):
    df = spark.createDataFrame([(1.0, 2.0), (2.0, 4.0), (None, 1.0), (3.0, None)], "a double, y double")
    m = gram.moments(df, ["a"], "y")[()]
    assert m.n == 2 and np.allclose(gram.ridge(m, 0.0), [0.0, 2.0])
    assert gram.moments(df.limit(0), ["a"], "y", ["a"]) == {}


def test_contingency_equals_one_hot(spark):
    rng = np.random.default_rng(3)
    codes = {"p": 4, "q": 3, "r": 6}
    c = np.stack([rng.integers(0, k, 500) for k in codes.values()], 1)
    y = rng.normal(size=500) + c[:, 0]
    half = rng.integers(0, 2, 500)
    rows = [(*map(int, a), float(b), int(h)) for a, b, h in zip(c, y, half, strict=True)]
    df = spark.createDataFrame(rows, "p int, q int, r int, y double, half int")
    one_hot = np.concatenate([np.ones((500, 1)), *[np.eye(k)[c[:, i]] for i, k in enumerate(codes.values())]], 1)
    parts = gram.contingency(df, codes, "y", ["half"])
    for h in (0, 1):
        own = half == h
        m = parts[(h,)]
        assert m.n == own.sum() and np.array_equal(m.xx, one_hot[own].T @ one_hot[own])
        assert np.allclose(m.xy, one_hot[own].T @ y[own]) and m.yy == pytest.approx((y[own] ** 2).sum())
    w = gram.ridge(parts[(0,)], 0.01)
    fit = np.linalg.solve(one_hot[half == 0].T @ one_hot[half == 0] + 0.01 * (half == 0).sum() * np.diag([0.0] + [1.0] * 13),
                          one_hot[half == 0].T @ y[half == 0])
    assert np.allclose(w, fit)


def test_contingency_checks_codes_and_width(spark):
    df = spark.createDataFrame([(5, 1.0), (None, 2.0)], "p int, y double")
    with pytest.raises(ValueError, match="beyond"):
        gram.contingency(df, {"p": 5}, "y")
    m = gram.contingency(df, {"p": 6}, "y")[()]
    assert m.n == 2 and m.xx[0, 6] == 1 and m.xx[1:, 1:].sum() == 1  # a null code is in no one-hot column
    with pytest.raises(ValueError, match="at most"):
        gram.contingency(df, {"p": 10_000}, "y")


def test_one_scan_whatever_the_grid(spark):
    """The numbers of jobs for 2 and for 200 strengths are equal: strengths are solved on the driver."""
    df, *_ = table(spark)
    parts = {f: m for (f,), m in gram.moments(df, ["a", "b", "c"], "y", ["fold"]).items()}
    before = spark.sparkContext.statusTracker().getJobIdsForGroup(None)
    assert len(gram.ridge_path(parts, [0.1 * i for i in range(1, 201)])) == 200
    assert spark.sparkContext.statusTracker().getJobIdsForGroup(None) == before
