"""Fits: closed forms against numpy, model-size monotonicity, learning curves."""

import numpy as np
import pytest

from tabspark.operators import fit

from fixture_paths import SF_SMALL


def test_linreg_2d_matches_numpy(spark):
    rng = np.random.default_rng(0)
    x = rng.normal(size=(300, 2))
    y = 3 * x[:, 0] - 2 * x[:, 1] + 1 + rng.normal(scale=0.1, size=300)
    df = spark.createDataFrame([(float(a), float(b), float(c)) for (a, b), c in zip(x, y)], "x1 double, x2 double, y double")
    r = fit.linreg_2d(df, "x1", "x2", "y").first()
    A = np.c_[x, np.ones(300)]
    want = np.linalg.lstsq(A, y, rcond=None)[0]
    assert np.allclose([r["b1"], r["b2"], r["intercept"]], want, atol=1e-9)


def test_gradient_descent_loss_falls(spark):
    df = spark.createDataFrame([(float(i) / 100, 2.0 * i / 100 + 1.0, "train") for i in range(100)],
                               "x double, y double, split string")
    r = fit.gradient_descent(df, ["x"], "y", lr=0.5, steps=20, checkpoint=False)
    curve = sorted((row["step"], row["loss"]) for row in r.curve.collect())
    assert curve[-1][1] < curve[0][1] / 5


def test_boosted_trees_beat_the_constant(spark):
    from pyspark.sql import functions as F

    from tabspark.plans import catalog, q_models

    std = q_models._split_ex(spark, SF_SMALL).where("split = 'train'").agg(F.stddev_pop("net_k")).first()[0]
    curve = {(r["period"], r["split"]): r["rmse"] for r in catalog.get("gbt_regress").fn(spark, SF_SMALL).collect()}
    assert len(curve) == 20 and curve[(10, "train")] < curve[(1, "train")] and curve[(10, "train")] < std / 2


def test_l1_size_non_increasing(spark):
    from tabspark.plans import catalog

    rows = sorted((r["lambda"], r["size"]) for r in catalog.get("l1_constrained_pick").fn(spark, SF_SMALL).collect())
    sizes = [s for _, s in rows]
    assert all(a >= b for a, b in zip(sizes, sizes[1:]))


@pytest.mark.parametrize("name, fits", [("logreg_l1", 1), ("l1_constrained_pick", 4)])
def test_l1_fits_share_cached_training_rows(spark, monkeypatch, name, fits):
    """A fit on rows that aren't cached would keep its own copy of them; all rows of the training split take part."""
    from tabspark.plans import catalog, q_models

    seen, fit_one = [], q_models._l1_fit
    monkeypatch.setattr(q_models, "_l1_fit", lambda rows, lam: seen.append(
        (rows.storageLevel.useMemory, rows.count())) or fit_one(rows, lam))
    catalog.get(name).fn(spark, SF_SMALL).collect()
    n = q_models._split_ex(spark, SF_SMALL).where("split = 'train'").count()
    assert seen == [(True, n)] * fits


def test_mlp_weight_layout_rescoring(spark):
    from pyspark.ml.classification import MultilayerPerceptronClassifier
    from pyspark.ml.linalg import Vectors

    rng = np.random.default_rng(1)
    rows = [(Vectors.dense(rng.normal(size=3).tolist()), float(i % 2)) for i in range(60)]
    df = spark.createDataFrame(rows, ["features", "label"])
    m = MultilayerPerceptronClassifier(layers=[3, 4, 2], maxIter=30, seed=1).fit(df)
    w = {(r["layer"], r["row"], r["col"]): r["weight"] for r in fit.mlp_weights(spark, m).collect()}
    x = np.array(rows[0][0].toArray())
    W0 = np.array([[w[("hidden0", i, j)] for j in range(4)] for i in range(3)])
    b0 = np.array([w[("bias0", 0, j)] for j in range(4)])
    W1 = np.array([[w[("logits", i, j)] for j in range(2)] for i in range(4)])
    b1 = np.array([w[("bias1", 0, j)] for j in range(2)])
    h = 1 / (1 + np.exp(-(x @ W0 + b0)))
    z = h @ W1 + b1
    p = np.exp(z - z.max()) / np.exp(z - z.max()).sum()
    got = m.transform(df.limit(1)).select("probability").first()[0].toArray()
    assert np.allclose(p, got, atol=1e-9)


def test_mllib_normal_equations_match_numpy(spark):
    from pyspark.ml.linalg import Vectors
    from pyspark.ml.regression import LinearRegression

    rng = np.random.default_rng(3)
    x = rng.normal(size=(400, 5))
    y = x @ np.array([1.5, -2.0, 0.3, 0.0, 4.0]) + 7.0 + rng.normal(scale=0.05, size=400)
    df = spark.createDataFrame([(Vectors.dense(r.tolist()), float(v)) for r, v in zip(x, y)], ["features", "label"])
    m = LinearRegression(solver="normal", regParam=0.0).fit(df)
    w = np.linalg.lstsq(np.c_[x, np.ones(400)], y, rcond=None)[0]
    assert np.allclose(m.coefficients.toArray(), w[:5], atol=1e-8) and abs(m.intercept - w[5]) < 1e-8
    weights = {r["name"]: r["weight"] for r in fit.linear_weights(spark, m, list("abcde")).collect()}
    assert abs(weights["bias"] - w[5]) < 1e-8 and abs(weights["e"] - w[4]) < 1e-8


def test_full_text_fit_has_every_training_term(spark):
    from tabspark.plans import catalog, q_models

    data, terms = q_models._text_full(spark, SF_SMALL)
    want = {t for r in data.where("split = 'train'").select("terms").collect() for t in r.terms or ()}
    assert len(terms) == len(want) > 54 and set(terms) == want
    hits = data.select("terms", "features").collect()
    assert all(r.features.numNonzeros() == len(set(r.terms or ()) & want) for r in hits)
    got = {(r.split, r.metric): r.value for r in catalog.get("text_logreg_full").fn(spark, SF_SMALL).collect()}
    assert got["train", "accuracy"] > 0.95 and set(m for _, m in got) == {"log_loss", "accuracy", "auc"}


def test_hashed_text_fits(spark):
    from tabspark.plans import catalog

    net = {(r.split, r.metric): r.value for r in catalog.get("text_mlp_hashed").fn(spark, SF_SMALL).collect()}
    assert net["train", "accuracy"] > 0.9 and set(m for _, m in net) == {"log_loss", "accuracy", "auc"}
    rows = {r.split: r for r in catalog.get("evaluate_text_hashed").fn(spark, SF_SMALL).collect()}
    assert rows["train"].accuracy > 0.95 and rows["valid"].n + rows["train"].n > 50


def test_recipes_share_one_table_and_need_few_jobs(spark, monkeypatch):
    """The examples are built once, and no fit scans them once per iteration."""
    from tabspark.plans import catalog, q_models

    built, build = [], q_models._split_ex
    monkeypatch.setattr(q_models, "_split_ex", lambda *a: built.append(1) or build(*a))
    solvers, linear = [], q_models.LinearRegression
    monkeypatch.setattr(q_models, "LinearRegression", lambda **k: solvers.append(k["solver"]) or linear(**k))
    got = {(r.recipe, r.split): r.rmse for r in catalog.get("recipe_compare").fn(spark, SF_SMALL).collect()}
    assert len(built) == 1 and solvers == ["normal"] * 3
    assert len(got) == 6 and got["all_scaled", "train"] < got["minimal", "train"]


def test_fit_input_runs_its_plan_once(spark):
    """The joins before a fit run once, however many partitions they leave."""
    from pyspark.sql import functions as F

    seen = spark.sparkContext.accumulator(0)

    def watched(batches):
        for b in batches:
            seen.add(len(b))
            yield b

    df = spark.range(200).repartition(4).mapInPandas(watched, "id long").groupBy("id").agg(F.count("*").alias("n"))
    got = fit.fit_input(df)
    assert got.count() == 200 and seen.value == 200
    assert got.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
